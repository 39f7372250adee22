"""Registered queries over the given tables, and their SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsewatch.llm import centroids, chat, decontaminate, langid, minhash, mixing, pages, pii, quality, spelling, toxicity, vectors, warc
from pulsewatch.llm.common import crc_mod, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


@query
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_overlap(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


# the window starts of a document meet the windows of items on (length, text); hit words are counted once
ORACLES["op1_decontaminate"] = r"""
WITH word_lists AS (
    SELECT 'd' AS side, doc_id AS id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
    UNION ALL
    SELECT 'b', item_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark
), item_starts AS (
    SELECT id AS item_id, w, least(13, len(w)) AS n, unnest(range(1, greatest(2, len(w) - 11))) AS i
    FROM word_lists WHERE side = 'b' AND len(w) > 0
), windows AS (
    SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS line FROM item_starts
), lengths AS (SELECT DISTINCT n FROM windows),
starts AS (
    SELECT id AS doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM word_lists WHERE side = 'd'
), met AS (
    SELECT s.doc_id, s.i, x.n, x.item_id
    FROM starts s JOIN lengths l ON s.i + l.n - 1 <= len(s.w)
    JOIN windows x ON x.n = l.n AND x.line = array_to_string(s.w[s.i:s.i + l.n - 1], ' ')
), hits AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM met) GROUP BY doc_id
), found AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM met) GROUP BY doc_id
)
SELECT d.id AS doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit,
    coalesce(f.n_items, 0) AS n_items, sha256(coalesce(f.items, '')) AS items_sha256,
    coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.w) AS contaminated
FROM word_lists d LEFT JOIN hits h ON h.doc_id = d.id LEFT JOIN found f ON f.doc_id = d.id
WHERE d.side = 'd'
"""


@query
def op9_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


ORACLES["op9_minmax_dedup"] = r"""
WITH RECURSIVE word_lists AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(2, len(w) - 1)),
        lambda i: md5(concat_ws(' ', len(w[i:i + 2]), array_to_string(w[i:i + 2], ' '))))) AS s
    FROM word_lists WHERE len(w) > 0
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
ordered AS (
    SELECT doc_id, s, n, row_number() OVER (PARTITION BY doc_id ORDER BY f, s) AS p
    FROM (SELECT doc_id, s, count(*) OVER (PARTITION BY s) AS f FROM shingles) JOIN sizes USING (doc_id)
), prefixes AS (SELECT doc_id, s, n FROM ordered WHERE p <= n - CAST(ceil(0.85 * n) AS BIGINT) + 1),
candidates AS (
    SELECT DISTINCT x.doc_id AS a, y.doc_id AS b, x.n AS na, y.n AS nb
    FROM prefixes x JOIN prefixes y ON x.s = y.s AND x.doc_id < y.doc_id
    WHERE 100 * least(x.n, y.n) >= 85 * greatest(x.n, y.n)
), links AS (
    SELECT a, b FROM candidates JOIN shingles x ON x.doc_id = a JOIN shingles y ON y.doc_id = b AND y.s = x.s
    GROUP BY a, b, na, nb HAVING 100 * count(*) >= 85 * (na + nb - count(*))
), both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
    SELECT doc_id AS node, doc_id AS other FROM documents
    UNION
    SELECT reach.node, both_ways.b FROM reach JOIN both_ways ON both_ways.a = reach.other
), least_one AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(z.n, 0) AS n_shingles, l.component_id, d.doc_id = l.component_id AS kept
FROM documents d JOIN least_one l ON l.node = d.doc_id LEFT JOIN sizes z ON z.doc_id = d.doc_id
"""


@query
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_spans(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in pii.BASE],
        F.sha2(pii.listed(pii.BASE), 256).alias("base_sha256"),
        pii.listed(tuple(pii.KINDS)).alias("spans"),
        pii.listed_scores(tuple(pii.KINDS)).alias("scores"),
    )


_LUHN = """list_sum(list_transform(range(1, len(d) + 1), lambda i:
    CASE WHEN i % 2 = 1 THEN CAST(reverse(d)[i] AS INT)
         WHEN CAST(reverse(d)[i] AS INT) > 4 THEN 2 * CAST(reverse(d)[i] AS INT) - 9
         ELSE 2 * CAST(reverse(d)[i] AS INT) END)) % 10 = 0"""
_MOD97 = """list_reduce(list_concat([0], list_transform(range(1, len(d) + 1), lambda i: CASE
    WHEN ((d[5:] || d[1:4])[i]) BETWEEN '0' AND '9' THEN ascii((d[5:] || d[1:4])[i]) - 48
    ELSE ascii((d[5:] || d[1:4])[i]) - 55 END)), lambda a, v: (a * CASE WHEN v > 9 THEN 100 ELSE 10 END + v) % 97) = 1"""
ORACLES["op5_pii"] = rf"""
WITH kinds(k, kind) AS (VALUES (1, 'email'), (2, 'ip'), (3, 'card'), (4, 'phone'), (5, 'iban'), (6, 'secret'), (7, 'national'), (8, 'account')
), each AS (
    SELECT doc_id, 1 AS k, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+') AS h,
        regexp_split_to_array(coalesce(text, ''), '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+') AS g FROM documents
    UNION ALL
    SELECT doc_id, 2, coalesce(text, ''), regexp_extract_all(coalesce(text, ''), '[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)'),
        regexp_split_to_array(coalesce(text, ''), '[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)') FROM documents
    UNION ALL
    SELECT doc_id, 3, coalesce(text, ''), regexp_extract_all(coalesce(text, ''), '[0-9](?:[\x20-]?[0-9])+'),
        regexp_split_to_array(coalesce(text, ''), '[0-9](?:[\x20-]?[0-9])+') FROM documents
    UNION ALL
    SELECT doc_id, 4, coalesce(text, ''), regexp_extract_all(coalesce(text, ''), '\+[0-9][\x20().0-9-]+[0-9]'),
        regexp_split_to_array(coalesce(text, ''), '\+[0-9][\x20().0-9-]+[0-9]') FROM documents
    UNION ALL
    SELECT doc_id, 5, coalesce(text, ''), regexp_extract_all(coalesce(text, ''), '[A-Z]{{2}}[0-9]{{2}}(?:[A-Z0-9]{{11,30}}|(?:\x20[A-Z0-9]{{4}}){{2,7}}(?:\x20[A-Z0-9]{{1,3}})?)'),
        regexp_split_to_array(coalesce(text, ''), '[A-Z]{{2}}[0-9]{{2}}(?:[A-Z0-9]{{11,30}}|(?:\x20[A-Z0-9]{{4}}){{2,7}}(?:\x20[A-Z0-9]{{1,3}})?)') FROM documents
    UNION ALL
    SELECT doc_id, 6, coalesce(text, ''), regexp_extract_all(coalesce(text, ''), '[A-Za-z0-9_-]{{20,}}'),
        regexp_split_to_array(coalesce(text, ''), '[A-Za-z0-9_-]{{20,}}') FROM documents
    UNION ALL
    SELECT doc_id, 7, coalesce(text, ''), regexp_extract_all(coalesce(text, ''), '[0-9]+(?:-[0-9]+)+'),
        regexp_split_to_array(coalesce(text, ''), '[0-9]+(?:-[0-9]+)+') FROM documents
    UNION ALL
    SELECT doc_id, 8, coalesce(text, ''), regexp_extract_all(coalesce(text, ''), '[0-9]{{8,}}'),
        regexp_split_to_array(coalesce(text, ''), '[0-9]{{8,}}') FROM documents
), placed AS (
    SELECT doc_id, k, unnest(h) AS m, unnest(g[1:len(h)]) AS gap, unnest(g[2:len(h) + 1]) AS after, unnest(range(1, len(h) + 1)) AS i FROM each WHERE len(h) > 0
), spans AS (
    SELECT doc_id, k, m, lower(right(gap, 48) || ' ' || left(after, 48)) AS beside, CAST(sum(length(gap) + length(m)) OVER (PARTITION BY doc_id, k ORDER BY i) AS BIGINT) AS e FROM placed
), tested AS (
    SELECT doc_id, k, m, e - length(m) AS s, e, CASE k WHEN 1 THEN 90 WHEN 2 THEN 60 WHEN 3 THEN 90 WHEN 4 THEN 60 WHEN 5 THEN 90 ELSE 75 END
        + CASE WHEN regexp_matches(beside, CASE k
            WHEN 1 THEN 'mail|contact|write to|schreib|correo|courriel'
            WHEN 2 THEN 'address|host|server|login|client|adresse|servidor'
            WHEN 3 THEN 'card|visa|credit|debit|payment|karte|carte|tarjeta'
            WHEN 4 THEN 'phone|call|tel|fax|mobile|anruf|appel|llam'
            WHEN 5 THEN 'iban|bank|account|konto|compte|cuenta|transfer'
            WHEN 6 THEN 'token|secret|api.?key|passw|passphrase|credential|mot de passe|clave'
            WHEN 7 THEN 'ssn|social security|national|insurance|passport|ausweis|versicherung|seguro social'
            ELSE 'bank|account|konto|compte|cuenta|transfer' END) THEN 10 ELSE 0 END AS score, CASE k WHEN 3 THEN regexp_replace(m, '[ -]', '', 'g') WHEN 5 THEN replace(m, ' ', '') ELSE regexp_replace(m, '[^0-9]', '', 'g') END AS d FROM spans
), good AS (
    SELECT doc_id, k, kind, kind || ':' || s || ':' || e AS line, s, score FROM tested JOIN kinds USING (k) WHERE CASE k
        WHEN 1 THEN true
        WHEN 2 THEN len(list_filter(string_split(m, '.'), lambda p: len(ltrim(p, '0')) > 3 OR (len(ltrim(p, '0')) = 3 AND ltrim(p, '0') > '255'))) = 0
        WHEN 3 THEN CASE WHEN length(d) BETWEEN 16 AND 19 THEN {_LUHN} ELSE false END
        WHEN 4 THEN length(d) BETWEEN 8 AND 15
        WHEN 5 THEN list_contains(string_split('{pii.IBAN_LENGTHS}', ' '), d[1:2] || length(d)) AND {_MOD97}
        WHEN 6 THEN regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Za-z]')
        WHEN 7 THEN regexp_matches(m, '^[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}$') AND NOT regexp_matches(m, '^(000|666|9)')
        ELSE length(m) <= 12 END AND (k < 5 OR score >= 80)
)
SELECT d.doc_id, count(*) FILTER (k = 1) AS n_email, count(*) FILTER (k = 2) AS n_ip, count(*) FILTER (k = 3) AS n_card,
    count(*) FILTER (k = 4) AS n_phone, sha256(coalesce(string_agg(line, ',' ORDER BY k, s) FILTER (k < 5), '')) AS base_sha256,
    coalesce(string_agg(line, ',' ORDER BY k, s), '') AS spans, coalesce(string_agg(CAST(score AS VARCHAR), ',' ORDER BY k, s), '') AS scores
FROM documents d LEFT JOIN good g ON g.doc_id = d.doc_id GROUP BY d.doc_id
"""


@query
def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False)))
    model = langid.fit(docs.where("not held_out"))
    found = langid.identified(docs.select("doc_id", "text", "held_out"), model)
    return found.select("row.doc_id", "row.held_out", "lang_pred", "score")


@query
def op10_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mixed(table(spark, sf_dir, "documents"))
    return out.select("row.doc_id", "row.source", "row.lang", "row.text", "copy", "mix_key")


ORACLES["op10_poisson_mix"] = """
WITH RECURSIVE sizes AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
rates AS (
    SELECT source, pow(CAST(n AS DOUBLE), 0.7) * ((SELECT sum(n) FROM sizes)
        / (SELECT CAST(sum(CAST(pow(CAST(n AS DOUBLE), 0.7) AS DECIMAL(28,10))) AS DOUBLE) FROM sizes)) / n AS rate FROM sizes
), steps AS (
    SELECT source, greatest(1, CAST(ceil(rate / 16) AS INT)) AS parts, rate / greatest(1, ceil(rate / 16)) AS r,
        0 AS k, exp(-rate / greatest(1, ceil(rate / 16))) AS p, exp(-rate / greatest(1, ceil(rate / 16))) AS c FROM rates
    UNION ALL
    SELECT source, parts, r, k + 1, p * r / (k + 1), c + p * r / (k + 1) FROM steps WHERE k < ceil(r + 10 * sqrt(r) + 10)
), draws AS (
    SELECT d.doc_id, d.source, t.part, (CAST('0x' || md5(concat('mix count', chr(1), d.doc_id, chr(1), t.part))[1:12] AS BIGINT) + 0.5::DOUBLE) / pow(16, 12) AS u
    FROM documents d JOIN (SELECT DISTINCT source, parts FROM steps) s ON s.source IS NOT DISTINCT FROM d.source
    JOIN (SELECT unnest(range(1, 1000)) AS part) t ON t.part <= s.parts
), counted AS (
    SELECT w.doc_id, count(*) FILTER (s.c < w.u) AS copies
    FROM draws w JOIN steps s ON s.source IS NOT DISTINCT FROM w.source GROUP BY w.doc_id
), copied AS (SELECT doc_id, CAST(unnest(range(1, copies + 1)) AS INT) AS copy FROM counted)
SELECT d.doc_id, d.source, d.lang, d.text, c.copy,
    (CAST('0x' || md5(concat('mix order', chr(1), d.doc_id, chr(1), c.copy))[1:12] AS BIGINT) + 0.5::DOUBLE) / pow(16, 12) AS mix_key
FROM documents d JOIN copied c USING (doc_id)
"""


@query
def op6_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans_listed(chat.rotated(table(spark, sf_dir, "conversations")))


def spans_listed(rendered: DataFrame) -> DataFrame:
    spans = F.transform("mask", lambda m: F.concat_ws(":", m["start"].cast("string"), m["end"].cast("string")))
    return rendered.withColumn("mask", F.array_join(spans, ","))


ORACLES["op6_perspectives"] = r"""
WITH cleaned AS (
    SELECT row_number() OVER () AS row, conv_id, turn, CASE WHEN coalesce(role, '') = '' THEN 'unknown' ELSE replace(role, '<|', '< |') END AS role,
        replace(coalesce(text, ''), '<|', '< |') AS text FROM conversations
), turns AS (
    SELECT DISTINCT coalesce('c' || conv_id, 'r' || row) AS dialogue, conv_id, CASE WHEN turn IS NULL THEN row END AS row, turn, role, text FROM cleaned
), speakers AS (SELECT DISTINCT dialogue, role AS speaker FROM turns WHERE role <> 'system'),
pieces AS (
    SELECT t.*, speaker, role = speaker AS own,
        CASE WHEN role = 'system' THEN '<|system|>' WHEN role = speaker THEN '<|assistant|>'
             ELSE '<|user name=' || role || '|>' END || chr(10) AS head, text || '<|end|>' || chr(10) AS body
    FROM turns t JOIN speakers s USING (dialogue)
), placed AS (
    SELECT *, CAST(sum(length(head) + length(body)) OVER (
        PARTITION BY dialogue, speaker ORDER BY turn NULLS FIRST, role, text, row) AS BIGINT) AS e FROM pieces
)
SELECT conv_id, speaker, string_agg(head || body, '' ORDER BY turn NULLS FIRST, role, text) AS text,
    coalesce(string_agg((e - length(body)) || ':' || e, ',' ORDER BY e) FILTER (own), '') AS mask,
    count(*) AS n_turns, count(*) FILTER (own) AS n_trained
FROM placed GROUP BY dialogue, conv_id, speaker
"""


@query
def op7_host_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pages.extracted(table(spark, sf_dir, "pages"))
    return found.select("row.page_id", "row.url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op8_small_world(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


# the checksum's table comes from its rule; words are near if they share a rest at the same place, or one is the other's rest
ORACLES["op11_spelling_variants"] = r"""
WITH RECURSIVE steps AS (
    SELECT i, 0 AS k, CAST(i AS BIGINT) AS v FROM range(0, 256) t(i)
    UNION ALL
    SELECT i, k + 1, CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM steps WHERE k < 8
), crc AS (SELECT list(v ORDER BY i) AS tab FROM steps WHERE k = 8),
runs AS (
    SELECT doc_id, run, count(*) AS n FROM (
        SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run
        FROM documents) GROUP BY doc_id, run
), hexed AS (
    SELECT run, n, hex(encode(concat(doc_id, ':', run))) AS x FROM runs
), hashed AS (
    SELECT run, n, xor(list_reduce(list_transform(range(1, len(x) // 2 + 1), lambda i: CAST('0x' || x[2 * i - 1:2 * i] AS BIGINT)),
        lambda c, b: xor(c >> 8, tab[1 + (xor(c, b) & 255)]), CAST(4294967295 AS BIGINT)), 4294967295) AS h
    FROM hexed, crc
), vocabulary AS (
    SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
        SELECT CASE WHEN h % 97 = 0 THEN run[1:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, n FROM hashed)
    WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), rests AS (
    SELECT word, n, i, word[1:i - 1] || word[i + 1:] AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocabulary)
), shorter AS (SELECT DISTINCT r.word AS a, r.n AS na, v.word AS b, v.n AS nb FROM rests r JOIN vocabulary v ON v.word = r.rest
), near AS (
    SELECT x.word, x.n, y.word AS other, y.n AS m FROM rests x JOIN rests y ON x.i = y.i AND x.rest = y.rest AND x.word <> y.word
    UNION ALL SELECT a, na, b, nb FROM shorter UNION ALL SELECT b, nb, a, na FROM shorter
), best AS (
    SELECT word, any_value(n) AS n, count(*) AS n_near, min(struct_pack(less := -m, other := encode(other))) AS top FROM near GROUP BY word
), forms AS (SELECT word, n_near, CASE WHEN -top.less >= 2 * n THEN decode(top.other) END AS form, CASE WHEN -top.less >= 2 * n THEN -top.less END AS form_n FROM best
), walks AS (
    SELECT word, form AS at FROM forms WHERE form IS NOT NULL
    UNION ALL SELECT w.word, f.form FROM walks w JOIN forms f ON f.word = w.at WHERE f.form IS NOT NULL
), ends AS (SELECT w.word, w.at FROM walks w JOIN forms f ON f.word = w.at WHERE f.form IS NULL)
SELECT v.word, f.form, coalesce(e.at, v.word) AS root, v.n, coalesce(f.n_near, 0) AS n_near, f.form_n
FROM vocabulary v LEFT JOIN forms f ON f.word = v.word LEFT JOIN ends e ON e.word = v.word
"""


@query
def op12_threshold_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clustered(table(spark, sf_dir, "embeddings")).drop("centroid")


def _rounds(rounds: int) -> str:
    """Assignment and means, round by round: the nearest of all centroids, ties to the smaller number."""
    parts = []
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
    SELECT row, vec_id, x, pick.c AS c, pick.d AS d FROM (
        SELECT row, vec_id, x, min(struct_pack(d := list_sum(list_transform(list_zip(x, m), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), c := c)) AS pick
        FROM kept, c{i} GROUP BY row, vec_id, x)
)""")
        if i < rounds:
            parts.append(f"""c{i + 1} AS MATERIALIZED (
    SELECT c, coalesce(any_value(v.m), any_value(o.m)) AS m FROM c{i} o LEFT JOIN (
        SELECT c, list(CAST(CASE WHEN s % n < 0 THEN (s - s % n) / n - 1 ELSE (s - s % n) / n END AS BIGINT) ORDER BY j) AS m
        FROM (SELECT c, j, CAST(sum(v) AS BIGINT) AS s, count(*) AS n
              FROM (SELECT c, unnest(x) AS v, unnest(range(1, 65)) AS j FROM a{i}) GROUP BY c, j) GROUP BY c
    ) v USING (c) GROUP BY c
)""")
    return ", ".join(parts)


ORACLES["op12_threshold_clusters"] = f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
    FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS c, x AS m FROM kept ORDER BY sha256('3:' || vec_id) LIMIT 8
), {_rounds(10)}
SELECT vec_id, CAST(c AS INT) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
    CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
FROM a10 JOIN c10 USING (c)
"""


@query
def op13_warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).drop("status")


ORACLES["op13_warc_segments"] = """
WITH digests AS (
    SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(encode(coalesce(html, ''))) AS h FROM pages
), origins AS (SELECT payload, max(page_id) AS origin FROM digests GROUP BY payload)
SELECT page_id, octet_length(d.payload) AS payload_bytes,
    array_to_string(list_transform(range(0, 8), lambda i: array_to_string(list_transform([15, 10, 5, 0], lambda s:
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[CAST((CAST('0x' || h[5 * i + 1:5 * i + 5] AS BIGINT) >> s) % 32 + 1 AS INT)]), '')), '') AS payload_digest,
    CASE WHEN page_id IS DISTINCT FROM origin AND origin IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN page_id IS DISTINCT FROM origin THEN origin END AS refers_to
FROM digests d JOIN origins o ON o.payload = d.payload
"""


@query
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.described(table(spark, sf_dir, "documents"))
    rows = quality.labelled_rows(found, table(spark, sf_dir, "labels"), "quality")
    model = quality.fit(rows.where(F.coalesce(crc_mod("doc_id", 3), F.lit(0)) != 1))
    return scores_of(quality.scored(found, model), crc_mod("doc_id", 3) == 1)


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = table(spark, sf_dir, "labels").where("toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("y"))
    model = toxicity.fit(docs.join(marked.where(F.coalesce(crc_mod("doc_id", 5), F.lit(1)) != 0), "doc_id"))
    return scores_of(toxicity.scored(docs, model), crc_mod("doc_id", 5) == 0)


def scores_of(scored: DataFrame, held_out: Column) -> DataFrame:
    return scored.select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
