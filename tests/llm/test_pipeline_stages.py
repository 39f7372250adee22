"""The pipeline's stages take effect, keep clean documents, and take what the stage before left."""

from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from pulsewatch.llm.common import table

SMALL = "/root/testdata/sf0.001"


def test_stages_one_by_one(spark):
    docs = table(spark, SMALL, "documents")
    odd = spark.createDataFrame(
        [
            (900001, None, None, None, None),
            (900002, "123 !!", "en", "src0", 6),
            (900003, docs.head()["text"], "fr", "src1", 1),
            (900004, "Write to someone@example.com or call +1 (275) 555-7228 about the rest of the day " * 3, "en", "src2", 1),
            (900005, table(spark, SMALL, "benchmark").head()["text"], "en", "src3", 1),
        ],
        docs.schema,
    )
    current = docs.unionByName(odd)
    kept = []
    for k, (_, stage) in enumerate(pipeline.STAGES):
        after = stage(spark, current, SMALL)
        if k < len(pipeline.STAGES) - 1:
            assert after.columns == docs.columns
            assert dict(after.dtypes) == dict(docs.dtypes)
        current = after.cache()
        kept.append({r["doc_id"]: r for r in current.collect()})
    language, copies, clean, private, mixed = kept
    assert {900001, 900002}.isdisjoint(language) and 900003 in language and len(language) >= docs.count()
    assert 900003 not in copies and 900004 in copies and docs.head()["doc_id"] in copies
    assert 900005 in copies and 900005 not in clean
    assert private[900004]["text"].startswith("Write to <EMAIL> or call <PHONE> about")
    assert private[900004]["n_chars"] == len(private[900004]["text"])
    assert len(private) == len(clean)
    untouched = [i for i in clean if not any(c in clean[i]["text"] for c in "@+0123456789")]
    assert all(private[i]["text"] == clean[i]["text"] for i in untouched) and len(untouched) > 50
    assert set(mixed) <= set(private) and {"copy", "mix_key"} <= set(current.columns)


def test_stages_of_an_empty_table(spark):
    current = table(spark, SMALL, "documents").limit(0)
    for _, stage in pipeline.STAGES:
        current = stage(spark, current, SMALL)
    assert current.count() == 0


def test_run(spark):
    out = pipeline.run(spark, SMALL)
    assert out.count() > 100 and out.where("doc_id is null or text is null").count() == 0


def test_near_copies_of_five_word_shingles(spark):
    words = [f"w{i}" for i in range(245)]
    rows = [(1, " ".join(words[:200])), (2, " ".join(words)), (3, "one clean text of its own"), (3, "and quite another text here"), (3, "one clean text of its own"), (4, "and quite another text here"), (4, "last text that only four has")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], table(spark, SMALL, "documents").schema)
    kept = sorted((r["doc_id"], r["text"]) for r in pipeline.drop_near_duplicates(spark, docs, SMALL).collect())
    assert kept == sorted({rows[0], rows[2], rows[3], rows[6]})


def test_language_stage_keeps_all_with_letters(spark):
    docs = table(spark, SMALL, "documents")
    short = ["A.", "De.", "Re.", "La", "en", "O", "Les", "Des", "No"]
    odd = spark.createDataFrame(
        [(900100 + i, t, None, None, len(t)) for i, t in enumerate(short)]
        + [(900200, "Это текст на другом языке", None, None, 1), (900201, "?!", "en", None, 1)],
        docs.schema,
    )
    got = {r["doc_id"]: r["lang"] for r in pipeline.identify_language(spark, docs.unionByName(odd), SMALL).collect()}
    lettered = {r["doc_id"] for r in docs.collect() if r["text"] and any(c.isalpha() for c in r["text"])}
    assert set(got) == lettered | {900100 + i for i in range(len(short))}
    assert all(got.values())
    unlabelled = docs.unionByName(odd).withColumn("lang", F.lit(None).cast("string"))
    got = {r["doc_id"]: r["lang"] for r in pipeline.identify_language(spark, unlabelled, SMALL).collect()}
    assert set(got) == lettered | {900100 + i for i in range(len(short))} | {900200} and not any(got.values())
