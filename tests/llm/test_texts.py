"""Decontamination, personal data and mixing against brute force, and their edge cases."""

import hashlib
import math
import re

import pytest

from pulsewatch.llm import decontaminate, mixing, pii

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


# ---- decontamination


def lowered(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def overlap(text, items):
    words = WORD.findall(lowered(text))
    hit, found = set(), set()
    for item_id, item in items:
        own = WORD.findall(lowered(item))
        n = min(13, len(own))
        windows = {tuple(own[i : i + n]) for i in range(max(1, len(own) - 12))} if own else set()
        for i in range(len(words) - n + 1 if n else 0):
            if tuple(words[i : i + n]) in windows:
                hit |= set(range(i, i + n))
                found.add(str(item_id))
    return len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()


ITEMS = [(1, "One two, three four five six SEVEN eight nine ten eleven twelve thirteen fourteen"), (2, "über Straße 7"), (3, None), (4, "... !"), (10, "Über straße 7"), (5, "a a")]
TEXTS = [
    "x one two three four five six seven eight nine ten eleven twelve thirteen y",
    "Two three-four. five six seven eight nine ten eleven twelve thirteen\nfourteen fifteen",
    "die über STRASSE 7 und über straße 7.",
    "a a a b aa a",
    None,
    "",
    "!!! ---",
    "one two three " * 400 + "a a",
    "x one two three four five six seven eight nine ten eleven twelve thirteen y",
]


@pytest.mark.parametrize("automaton_bytes", [decontaminate.AUTOMATON_BYTES, 20])
def test_overlap_equals_brute_force(spark, automaton_bytes):
    docs = frame(spark, [(i if i < 8 else 0, t, None, None, None) for i, t in enumerate(TEXTS)])
    got = decontaminate.find_overlap(docs, spark.createDataFrame(ITEMS, "item_id long, text string"), automaton_bytes=automaton_bytes).collect()
    assert len(got) == len(TEXTS)
    for r in got:
        want = overlap(r["text"], ITEMS)
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"]) == want
        assert r["contaminated"] == (want[1] > 0 and 20 * want[1] >= want[0])
        assert sum(len(WORD.findall(lowered(r["text"][s["start"] : s["end"]]))) for s in r["spans"]) == want[1]


def test_overlap_of_empty_tables_and_clashing_names(spark):
    docs = frame(spark, [(1, "a a", "x", None, 3)]).selectExpr("*", "1 as items", "2 as ranges", "3 as contaminated", "'q' as `odd name`")
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_overlap(docs, none).head()["n_hit"] == 0
    assert decontaminate.decontaminated(docs, none).collect() == docs.collect()
    assert decontaminate.decontaminated(docs, spark.createDataFrame(ITEMS, "item_id long, text string")).count() == 0
    assert decontaminate.find_overlap(docs.limit(0), none).count() == 0


# ---- personal data

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def checks(kind, match):
    digits = [int(c) for c in match if c.isdigit()]
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        total = sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(reversed(digits)))
        return 16 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def base_spans(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in BASE.items() for m in re.finditer(p, text or "") if checks(k, m.group())]


PERSONAL = [
    "Mail à a.b+c@x-y.example.com_d@e.fr, or 𝔘nicode z@z.z!",
    "ip 1.2.3.4.5.6.7.8 and 256.1.1.1 and 001.002.003.0255 9.9.9.9",
    "cards 4111 1111 1111 1111, 4111-1111-1111-1112, 4111111111111111, 41111111111111111234567",
    "call +1 (275) 555-7228 or +49 30 1234 or +123; +1 4111111111111111",
    "@ + . 1.2 no@no +",
    None,
    "",
    "ab@cd.ef " * 700,
    "1" * 20000 + " +" + "2" * 20000 + " a@" + "b." * 20000 + "c",
    "x" * 50000 + "@",
]


def test_base_spans_equal_brute_force(spark):
    docs = frame(spark, [(i, t, None, None, None) for i, t in enumerate(PERSONAL)])
    got = pii.find_spans(docs).select("doc_id", pii.listed(pii.BASE).alias("spans")).collect()
    assert len(got) == len(PERSONAL)
    for r in got:
        assert r["spans"] == ",".join(base_spans(PERSONAL[r["doc_id"]]))


def test_iban_and_context(spark):
    docs = frame(
        spark,
        [
            (1, "IBAN: DE89 3704 0044 0532 0130 00.", None, None, None),
            (2, "GB82WEST12345698765432 XX82WEST12345698765432 GB83WEST12345698765432", None, None, None),
            (3, "phone +12755557228 versus " + "-" * 60 + " +12755557229", None, None, None),
        ],
    )
    got = {r["doc_id"]: r for r in pii.find_spans(docs).collect()}
    assert [(s["start"], s["end"]) for s in got[1]["iban"]] == [(6, 33)]
    assert [(s["start"], s["end"]) for s in got[2]["iban"]] == [(0, 22)]
    assert [s["score"] for s in got[3]["phone"]] == [0.7, 0.6]


def test_context_decides_where_no_checksum_does(spark):
    token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
    texts = [
        f'token = "{token}" and later',
        f'revision "{token}" and later',
        "social security 123-45-6789, 000-12-3456, 123-45-67890",
        "score 123-45-6789",
        "Konto 12345678 and 1234567 and 1234567890123",
        "page 12345678",
        "token = " + "a" * 40,  # no digit
        "the token " + "-" * 60 + f" {token}",  # beyond reach
    ]
    docs = frame(spark, [(i, t, None, None, None) for i, t in enumerate(texts)])
    new = ("secret", "national", "account")
    got = pii.find_spans(docs).select("doc_id", pii.listed(new).alias("spans"), pii.listed_scores(new).alias("scores"))
    rows = {r["doc_id"]: (r["spans"], r["scores"]) for r in got.collect()}
    assert rows[0] == ("secret:9:49", "85") and rows[2] == ("national:16:27", "85") and rows[4] == ("account:6:14", "85")
    assert [rows[i] for i in (1, 3, 5, 6, 7)] == [("", "")] * 5
    clean = {r["doc_id"]: r["text"] for r in pii.redacted(docs).collect()}
    assert clean[0] == 'token = "<SECRET>" and later' and clean[1] == texts[1]
    assert clean[2].startswith("social security <NATIONAL>,") and clean[5] == texts[5]


def test_redaction_leaves_no_base_span(spark):
    docs = frame(spark, [(i, t, "x", None, 1) for i, t in enumerate(PERSONAL)]).selectExpr("*", "7 as _text", "8 as _hits")
    got = pii.redacted(docs).collect()
    assert pii.redacted(docs).columns == docs.columns
    for r in got:
        text = PERSONAL[r["doc_id"]]
        if not text:
            assert r["text"] == text
            continue
        assert base_spans(r["text"]) == []
        if not base_spans(text):
            assert r["text"] == text
    assert got[0]["text"].startswith("Mail à <EMAIL><EMAIL>, or 𝔘nicode <EMAIL>!")
    assert pii.redacted(docs.limit(0)).count() == 0


# ---- mixing


def uniform(*key):
    high = int(hashlib.md5("\x01".join(map(str, key)).encode()).hexdigest()[:12], 16)
    return (high + 0.5) / 16**12


def poisson(rate, key):
    parts = max(1, math.ceil(rate / 16))
    total = 0
    for part in range(1, parts + 1):
        u, r = uniform("mix count", key, part), rate / parts
        k, p = 0, math.exp(-r)
        c = p
        while c < u and k < 400:
            k += 1
            p *= r / k
            c += p
            total += 1
    return total


def test_copies_equal_brute_force(spark):
    rows = [(i, f"t{i}", None, ["a", "b", None][0 if i < 300 else 1 if i < 320 else 2], i) for i in range(330)]
    docs = frame(spark, rows)
    weights = {"a": 1.0, "b": 2.0, None: 1.0}
    got = {}
    out = mixing.mixed(docs, weights, total=1200).select("row.*", "copy", "mix_key").collect()
    for r in out:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + 1
        assert r["mix_key"] == uniform("mix order", r["doc_id"], r["copy"])
    for i, _, _, source, _ in rows:
        rate = {"a": 300 / 300, "b": 600 / 20, None: 300 / 10}[source]
        assert got.get(i, 0) == poisson(rate, i)
    assert 1000 < len(out) < 1400


def test_mixing_edges(spark):
    docs = frame(spark, [(None, "a", None, "s", 1), (None, "b", None, "s", 1), (1, None, None, None, None), (1, None, None, None, None)])
    out = mixing.mixed(docs.selectExpr("*", "5 as copy", "6 as mix_key", "7 as rate"), total=400)
    assert out.count() > 200
    twins = [r["copy"] for r in out.where("row.doc_id = 1").collect()]
    assert sorted(twins) == sorted(2 * list(range(1, len(twins) // 2 + 1)))
    assert mixing.mixed(docs.limit(0)).count() == 0
    assert mixing.mixed(docs, {"s": 0.0}).count() == 0
    assert mixing.mixed(docs, {}).count() == 0
