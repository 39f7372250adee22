"""From raw documents to a training mix, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept. All but the
last return the columns of documents; the last adds the number of the copy and its place in the
shuffled order.

Edge cases, in every stage: an empty table gives an empty one; further columns are kept as they are,
whatever their names, but columns named copy and mix_key give way to those of the last stage; very
long texts are taken whole. Null texts and texts without a letter go in the first stage; a null
doc_id, source or lang does not matter. Equal rows are near duplicates, of which one stays.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsewatch.llm import decontaminate, langid, minhash, mixing, pii
from pulsewatch.llm.common import stored, table

#: Documents of whose letters a smaller share occurs in any learned language are rejected, as are those without a letter.
LEAST_LEARNED_LETTERS = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter or in letters of no learned language; name the language where none is given.

    Neither depends on the length of a text: a short text that several languages share stays. If no
    document names a language, all with a letter stay and none is named.
    """
    model = langid.fit(docs)
    found = langid.identified(docs, model)
    text = F.lower("row.text")
    letters = F.length(F.regexp_replace(text, r"\P{L}", ""))
    kept = found.where(letters > 0)
    known = langid.letters_of(model) if model.languages else []
    if known:
        learned = F.length(F.regexp_replace(text, f"[^{''.join(known)}]", ""))
        kept = kept.where(learned >= LEAST_LEARNED_LETTERS * letters)
    named = F.nullif("lang_pred", F.lit(langid.UNDETERMINED))
    return kept.select(
        *[
            (F.coalesce("row.lang", named) if c == "lang" else F.col("row")[c]).alias(c)
            for c in docs.columns
        ]
    )


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of the smallest doc_id in each group of near copies, told by shingles of five words at 0.8."""
    return minhash.deduplicated(docs, shingle=5, numer=80, denom=100)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold too much of the benchmark."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put the kind of personal data in place of each span; n_chars follows the text."""
    clean = pii.redacted(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat documents to the target weights of their sources and shuffle them."""
    out = mixing.mixed(docs)
    return out.select(*[F.col("row")[c].alias(c) for c in docs.columns if c not in ("copy", "mix_key")], "copy", "mix_key")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", identify_language),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal data", redact_personal_data),
    ("mixing", mix_sources),
]
#: The language stage has no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, f"stage-{k}")
    return docs
