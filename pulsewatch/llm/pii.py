"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

Built from DataFrame functions only. Matches of a pattern and the pieces between them come from
one pattern each; running sums of their lengths give positions in code points. Patterns are in a
form that Java reads in linear time and without deep recursion: possessive repeats, and no start
inside a run whose start has failed (which changes no match).

Addresses, cards and phone numbers that pass their checks are always spans, and their scores say how
sure they are. Kinds without a checksum (secrets, national numbers, accounts) are spans only where a
context word lies within REACH code points: without one their score stays below THRESHOLD.

Edge cases: null and empty texts have no spans; repeated rows each give a row; a text of many
matches is summed in blocks; columns of the documents other than doc_id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: kind: (pattern, cheap test on the text, score of a confirmed match)
KINDS: dict[str, tuple[str, str, float]] = {
    "email": (
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "contains(text, '@')",
        0.9,
    ),
    "ip": (r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", r"text rlike '[0-9][.][0-9]'", 0.6),
    "card": (r"[0-9](?:[\x20-]?[0-9])++", r"text rlike '[0-9]'", 0.9),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "contains(text, '+')", 0.6),
    "iban": (
        r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)",
        r"text rlike '[A-Z]{2}[0-9]{2}[A-Z0-9 ]'",
        0.9,
    ),
    # no checksum confirms these, so only a context word lifts them to the threshold
    "secret": (r"[A-Za-z0-9_-]{20,}+", r"text rlike '[A-Za-z0-9_-]{20}'", 0.75),
    "national": (r"[0-9]++(?:-[0-9]++)++", r"text rlike '[0-9]-[0-9]'", 0.75),
    "account": (r"[0-9]{8,}+", r"text rlike '[0-9]{8}'", 0.75),
}
#: These are always reported once confirmed; others need the threshold.
BASE = ("email", "ip", "card", "phone")
THRESHOLD = 0.8
REACH = 48  # code points on either side in which a context word counts
BOOST = 0.1
CONTEXT = {
    "email": "mail|contact|write to|schreib|correo|courriel",
    "ip": "address|host|server|login|client|adresse|servidor",
    "card": "card|visa|credit|debit|payment|karte|carte|tarjeta",
    "phone": "phone|call|tel|fax|mobile|anruf|appel|llam",
    "iban": "iban|bank|account|konto|compte|cuenta|transfer",
    "secret": "token|secret|api.?key|passw|passphrase|credential|mot de passe|clave",
    "national": "ssn|social security|national|insurance|passport|ausweis|versicherung|seguro social",
    "account": "bank|account|konto|compte|cuenta|transfer",
}
# Length of an IBAN by country.
IBAN_LENGTHS = (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 EG29 ES24 "
    "FI18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 "
    "LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MR27 MT31 MU30 NL18 NO15 PK24 PL28 PS29 PT25 QA29 RO24 RS22 "
    "SA24 SC31 SD18 SE24 SI19 SK24 SM27 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20"
)
BLOCK = 256


def running(values: Column) -> Column:
    """Sums of all earlier values; block by block, as appending to an array copies it."""

    def sums(items: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("out"))
        return F.aggregate(
            items,
            start,
            lambda a, x: F.struct((a["at"] + x).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")),
        )

    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(values) - 1) / BLOCK).cast("int")),
        lambda b: sums(F.slice(values, b * BLOCK + 1, F.lit(BLOCK))),
    )
    bases = sums(F.transform(blocks, lambda b: b["at"]))["out"]
    return F.flatten(F.zip_with(blocks, bases, lambda b, base: F.transform(b["out"], lambda x: x + base)))


def luhn(digits: Column) -> Column:
    """Whether the check digit of a digit string is right."""
    each = F.split(F.reverse(digits), "(?!$)")
    values = F.transform(each, lambda d, i: d.cast("int") * F.when(i % 2 == 1, 2).otherwise(1))
    return F.aggregate(values, F.lit(0), lambda a, v: a + F.when(v > 9, v - 9).otherwise(v)) % 10 == 0


def mod_97(number: Column) -> Column:
    """Whether an IBAN without blanks has the length of its country and the remainder 1."""
    turned = F.concat(F.substring(number, 5, 40), F.substring(number, 1, 4))
    each = F.split(turned, "(?!$)")
    values = F.transform(each, lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55))
    rest = F.aggregate(values, F.lit(0), lambda a, v: (a * F.when(v > 9, 100).otherwise(10) + v) % 97)
    known = F.array(*[F.lit(x) for x in IBAN_LENGTHS.split()])
    form = F.concat(F.substring(number, 1, 2), F.length(number).cast("string"))
    return F.array_contains(known, form) & (rest == 1)


def confirmed(kind: str, match: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(match, "[.]"), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "").rlike("^([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        digits = F.regexp_replace(match, "[ -]", "")
        return F.when(F.length(digits).between(16, 19), luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(F.regexp_replace(match, "[^0-9]", "")).between(8, 15)
    if kind == "iban":
        return mod_97(F.regexp_replace(match, " ", ""))
    if kind == "secret":
        return match.rlike("[0-9]") & match.rlike("[A-Za-z]")
    if kind == "national":
        return match.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$") & ~match.rlike("^(000|666|9)")
    if kind == "account":
        return F.length(match) <= 12
    return F.lit(True)


def _with_kind(df: DataFrame, kind: str, text: str = "text") -> DataFrame:
    """Adds column ``kind``: the spans of that kind, and _hits and _gaps for rebuilding the text."""
    pattern, test, score = KINDS[kind]
    none = F.array().cast("array<string>")
    hits, gaps = F.col("_hits"), F.col("_gaps")
    df = df.withColumn(
        "_hits",
        F.when(F.expr(test.replace("text", text)), F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))).otherwise(none),
    )
    some = F.size(hits) > 0
    df = df.withColumn("_gaps", F.when(some, F.split(F.col(text), pattern, -1)).otherwise(none))
    widths = F.transform(hits, lambda h, i: (F.length(h) + F.length(F.get(gaps, i))).cast("long"))
    df = df.withColumn("_at", F.when(some, running(widths)))

    def span(match: Column, i: Column) -> Column:
        start = F.get(F.col("_at"), i) + F.length(F.get(gaps, i))
        beside = F.lower(F.concat_ws(" ", F.right(F.get(gaps, i), F.lit(REACH)), F.left(F.get(gaps, i + 1), F.lit(REACH))))
        near = F.when(beside.rlike(CONTEXT[kind]), F.lit(BOOST)).otherwise(F.lit(0.0))
        return F.struct(
            start.alias("start"),
            (start + F.length(match)).alias("end"),
            F.round(F.when(confirmed(kind, match), F.lit(score) + near).otherwise(F.lit(0.0)), 2).alias("score"),
        )

    spans = F.transform(hits, span)
    empty = F.array().cast("array<struct<start:bigint,end:bigint,score:double>>")
    return df.withColumn("_spans", F.when(some, spans).otherwise(empty))


def _stays(kind: str, score: Column) -> Column:
    return score > 0 if kind in BASE else score >= THRESHOLD


def _staying(kind: str) -> Column:
    return F.filter("_spans", lambda s: _stays(kind, s["score"]))


def find_spans(docs: DataFrame) -> DataFrame:
    """doc_id, text and one array of (start, end, score) for each kind, in code points."""
    df = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    done: list[str] = []
    for kind in KINDS:
        df = _with_kind(df, kind).withColumn(kind, _staying(kind))
        done.append(kind)
        df = df.select("doc_id", "text", *done)
    return df


def listed(kinds: tuple[str, ...]) -> Column:
    """kind:start:end of all spans, comma-joined."""

    def lines(kind: str) -> Column:
        return F.transform(
            kind, lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string"))
        )

    return F.array_join(F.concat(*[lines(k) for k in kinds]), ",")


def listed_scores(kinds: tuple[str, ...]) -> Column:
    """Scores of all spans in hundredths, in the order of ``listed``, comma-joined."""
    scores = [F.transform(k, lambda s: F.round(s["score"] * 100).cast("int").cast("string")) for k in kinds]
    return F.array_join(F.concat(*scores), ",")


def _rebuilt(kind: str) -> Column:
    """The pieces of a text with its matches, or their kind, between them."""
    gaps, hits, spans = F.col("_gaps"), F.col("_hits"), F.col("_spans")

    def piece(gap: Column, i: Column) -> Column:
        shown = F.when(_stays(kind, F.get(spans, i)["score"]), F.lit(f"<{kind.upper()}>")).otherwise(F.get(hits, i))
        return F.concat(gap, F.coalesce(shown, F.lit("")))

    return F.when(F.size(hits) > 0, F.array_join(F.transform(gaps, piece), "")).otherwise(F.col("_text"))


def redacted(docs: DataFrame, column: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets; null texts stay null.

    One kind after the other, IBAN, secret and card before phone, so that an overlap is replaced once.
    """
    names = docs.columns
    df = docs.select(F.struct(*[F.col(c) for c in names]).alias("_row"), F.coalesce(column, F.lit("")).alias("_text"))
    for kind in ("email", "iban", "secret", "card", "ip", "phone", "national", "account"):
        df = _with_kind(df, kind, "_text").select("_row", _rebuilt(kind).alias("_text"))
    out = [
        F.when(F.col("_row")[c].isNotNull(), F.col("_text")).alias(c) if c == column else F.col("_row")[c].alias(c)
        for c in names
    ]
    return df.select(*out)
