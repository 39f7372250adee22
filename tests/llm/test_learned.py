"""Language, quality and toxicity: the mathematics against brute force, held-out accuracy, edges."""

import math

import numpy as np
import pytest

from pulsewatch.llm import langid, quality, toxicity
from pulsewatch.llm import queries as q

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


# ---- language


def cuts(word):
    if not word:
        yield []
    for k in range(1, len(word) + 1):
        for rest in cuts(word[k:]):
            yield [word[:k], *rest]


def test_forward_sums_all_segmentations():
    pieces = ["▁", "▁a", "a", "ab", "b", "ba", "bab", "▁ab"]
    lattice = langid.Lattice(pieces)
    table = langid._table(np.random.default_rng(1).random((len(pieces) + 2, 3)))
    words = ["abab", "a", "zb", "babzab"]
    for places, ids in lattice.groups(words):
        total = langid.forward(ids, table)[:, -1]
        behind = langid.backward(ids, table)[:, 0]
        for row, at in enumerate(places):
            want = np.zeros(3)
            for cut in cuts(langid.MARK + words[at]):
                rows = [pieces.index(p) if p in pieces else lattice.unknown if len(p) == 1 else lattice.none for p in cut]
                want += np.prod(table[rows], axis=0)
            assert np.allclose(total[row], want) and np.allclose(behind[row], want)


def test_expected_counts_are_posteriors():
    pieces = ["▁", "▁a", "a", "ab", "b"]
    lattice, counts = langid.Lattice(pieces), np.array([[2.0]])
    table = langid._table(np.ones((len(pieces) + 2, 1)))
    got = langid.expected(["ab"], counts, lattice, table)
    weights = {tuple(c): math.prod(table[pieces.index(p), 0] for p in c) for c in cuts("▁ab") if all(p in pieces for p in c)}
    want = np.zeros(len(pieces) + 2)
    for cut, w in weights.items():
        for p in cut:
            want[pieces.index(p)] += 2 * w / sum(weights.values())
    assert np.allclose(got[:, 0], want)


def test_language_held_out_accuracy(spark):
    got = q.op2_langid(spark, "/root/testdata/sf0.01").toPandas()
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").toPandas()
    both = got.merge(truth, on="doc_id")
    held = both[both.held_out]
    assert len(got) == len(truth) and 150 < len(held) < 350
    assert (held.lang == held.lang_pred).mean() > 0.97
    assert got.score.between(0, 1).all()


def test_language_edges(spark):
    rows = [(i, t, lang, None, None) for i, (t, lang) in enumerate([("the cat and the dog " * 20, "en"), ("der Hund und die Katze " * 20, "de")] * 4)]
    model = langid.fit(spark.createDataFrame(rows, DOCS))
    odd = [None, "", "12 !!", "²½", "THE DOG", "xqzj" * 5000, "狗和猫" * 300, "the dog", "the dog"]
    docs = spark.createDataFrame([(i, t, "zz", None, None) for i, t in enumerate(odd)], DOCS).selectExpr("*", "1 as score", "2 as lang_pred")
    got = [r for r in langid.identified(docs, model).orderBy("row.doc_id").collect()]
    assert [r["lang_pred"] for r in got[:5]] == ["und", "und", "und", "und", "en"]
    assert [r["score"] for r in got[:4]] == [0.0] * 4
    assert all(0 <= r["score"] <= 1 for r in got) and got[6]["lang_pred"] in ("de", "en")
    assert got[7]["score"] == got[8]["score"]
    nothing = langid.fit(docs.limit(0))
    assert {r["lang_pred"] for r in langid.identified(docs, nothing).collect()} == {"und"}
    assert langid.identified(docs.limit(0), model).count() == 0


# ---- quality


def test_isotonic_pools_violators():
    x, y = quality.isotonic(np.arange(5.0), np.array([0.1, 0.6, 0.2, 0.4, 0.9]), np.array([1.0, 1, 1, 2, 1]))
    assert np.allclose(y, [0.1, 0.4, 0.9]) and np.allclose(x, [0, 2.25, 4])


def test_features_approximate_the_kernel():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(20, 6))
    kernel = quality.kernel_for(np.zeros(6), np.ones(6), features=20000)
    f = kernel(x)[:, :20000]
    want = np.exp(-((x[:, None] - x[None]) ** 2).sum(axis=2) / 2 / 6)
    assert np.abs(f @ f.T - want).max() < 0.05


def test_partition_sums_solve_the_whole_system(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 5))
    y = ((x**2).sum(axis=1) > 4).astype(int)
    rows = spark.createDataFrame([(i, a.tolist(), int(b)) for i, (a, b) in enumerate(zip(x, y, strict=True))], "doc_id long, x array<double>, y int")
    model = quality.fit(rows.repartition(5), features=64)
    f = model.kernel(x)
    gram = f.T @ f
    want = np.linalg.solve(gram + quality.PENALTY * np.trace(gram) / len(gram) * np.eye(len(gram)), f.T @ y)
    assert np.allclose(model.weights, want, atol=1e-6)
    assert (np.diff(model.values) >= 0).all()
    scores = {r["doc_id"]: r["score"] for r in quality.scored(rows.select("doc_id", "x"), model).collect()}
    assert np.mean([(scores[i] >= 0.5) == b for i, b in enumerate(y)]) > 0.9


def test_quality_held_out_accuracy(spark):
    got = q.op3_quality(spark, "/root/testdata/sf0.01").toPandas()
    held = got[got.held_out].merge(spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas(), on="doc_id")
    assert len(got) == 1000 and (held.predicted == held.quality).mean() > 0.95


@pytest.mark.parametrize("labels", [[], [(1, 1), (2, 1), (1, None), (None, 0), (2, 7)]])
def test_quality_edges(spark, labels):
    docs = spark.createDataFrame([(1, None), (2, ""), (2, ""), (3, "a" * 300000), (None, "\n \n")], "doc_id long, text string").selectExpr("*", "1 as x", "2 as y")
    found = quality.described(docs)
    assert all(all(map(math.isfinite, r["x"])) and len(r["x"]) == len(quality.STATISTICS) for r in found.collect())
    model = quality.fit(quality.labelled_rows(found, spark.createDataFrame(labels, "doc_id long, quality int")))
    assert [r["score"] for r in quality.scored(found, model).collect()] == [model.values[0]] * 5
    assert quality.scored(quality.described(docs.limit(0)), model).count() == 0


# ---- toxicity


def test_gradient_of_the_noisy_or():
    rng = np.random.default_rng(5)
    y = np.array([1, 0, 1])
    doc_of, sentence_of, flat = np.array([0, 0, 1, 2, 2]), np.array([0, 0, 1, 2, 3, 4, 4]), rng.integers(0, 6, 7)
    w, b = rng.normal(size=6), -0.5
    gain, slope, lean = toxicity.gradient(w, b, y, doc_of, sentence_of, flat)
    z = b + np.bincount(sentence_of, weights=w[flat], minlength=5)
    p = 1 / (1 + np.exp(-z))
    document = [1 - np.prod(1 - p[doc_of == d]) for d in range(3)]
    assert np.isclose(gain, sum(np.log(d if t else 1 - d) for d, t in zip(document, y, strict=True)))
    for i in range(6):
        up = np.eye(6)[i] * 1e-6
        change = (toxicity.gradient(w + up, b, y, doc_of, sentence_of, flat)[0] - toxicity.gradient(w - up, b, y, doc_of, sentence_of, flat)[0]) / 2e-6
        assert np.isclose(change, slope[i], atol=1e-5)
    change = (toxicity.gradient(w, b + 1e-6, y, doc_of, sentence_of, flat)[0] - toxicity.gradient(w, b - 1e-6, y, doc_of, sentence_of, flat)[0]) / 2e-6
    assert np.isclose(change, lean, atol=1e-5)


def test_classes_of_the_sample():
    assert toxicity.class_rates(900, 100, 2000) == (1.0, 1.0)
    assert toxicity.class_rates(9_000, 100, 1000) == (0.1, 1.0)  # all of the rare class, the rest of the other
    assert toxicity.class_rates(10_000, 10_000, 1000) == (0.05, 0.05)
    rng = np.random.default_rng(2)
    args = rng.normal(size=4), -0.5, np.array([1, 0]), np.array([0, 1, 1]), np.array([0, 1, 2]), rng.integers(0, 4, 3)
    twice = (args[0], args[1], np.array([1, 0, 0]), np.array([0, 1, 1, 2, 2]), np.array([0, 1, 2, 3, 4]), np.append(args[5], args[5][1:]))
    for got, want in zip(toxicity.gradient(*args, (2.0, 1.0)), toxicity.gradient(*twice), strict=True):
        assert np.allclose(got, want)


def test_a_rare_class_is_learned(spark):
    rng = np.random.default_rng(8)
    plain = [f"{a}{b}" for a in ("tra", "hou", "riv", "sto") for b in "abcdefghij"]
    rows = [(i, " ".join(rng.choice(plain, 8)) + (" grimblish!" if i % 50 == 0 else "."), int(i % 50 == 0)) for i in range(2000)]
    model = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string, y int"), sample_docs=200)
    docs = spark.createDataFrame([(1, "stoa grimblish trab"), (2, "stoa trab houc")], "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in toxicity.scored(docs, model, locate=False).collect()}
    assert got[1] > 0.5 > 0.1 > got[2]


def test_toxic_sentences_are_located(spark):
    rng = np.random.default_rng(6)
    plain = ["tree", "house", "river", "stone", "cloud", "bread", "light", "green"]
    rows = []
    for i in range(240):
        parts = [" ".join(rng.choice(plain, 6)) + "." for _ in range(5)]
        if i % 2:
            parts[i % 5] = f"you {rng.choice(['grimbly', 'grimblers', 'grimblish'])} {rng.choice(plain)}!"
        rows.append((i, " ".join(parts), i % 2))
    model = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string, y int"))
    text = "Ünder a tree. The grimblest stone! Bread\nand light"
    docs = spark.createDataFrame([(1, text), (2, "tree house."), (3, None), (4, ""), (4, ""), (5, "... 12")], "doc_id long, text string").selectExpr("*", "1 as y")
    got = {r["doc_id"]: r for r in toxicity.scored(docs, model).collect()}
    assert got[1]["score"] > 0.5 and [text[s["start"] : s["end"]].strip() for s in got[1]["offending"]] == ["The grimblest stone!"]
    assert max(got[i]["score"] for i in (2, 3, 4, 5)) < 0.5 and got[3]["score"] == got[4]["score"] == got[5]["score"]
    assert toxicity.scored(docs.limit(0), model).count() == 0


def test_toxicity_without_both_classes(spark):
    rows = spark.createDataFrame([(1, "a b", 1), (2, None, 1)], "doc_id long, text string, y int")
    for labelled, want in ((rows, 1.0), (rows.limit(0), 0.0)):
        score = toxicity.scored(rows, toxicity.fit(labelled)).where("doc_id = 2").head()["score"]
        assert abs(score - want) < 1e-3


def test_toxicity_held_out_accuracy(spark):
    got = q.op4_toxicity(spark, "/root/testdata/sf0.1").toPandas()
    held = got[got.held_out].merge(spark.read.parquet("/root/testdata/sf0.1/labels.parquet").toPandas(), on="doc_id")
    assert len(got) == 10000 and (held.predicted == held.toxic).mean() > 0.95


def test_copies_of_a_text_do_not_calibrate_each_other(spark):
    rng = np.random.default_rng(9)
    x = np.repeat(rng.normal(size=(40, len(quality.STATISTICS))), 12, axis=0)  # 40 texts of 12 copies
    y = np.repeat(rng.integers(0, 2, 40), 12)  # labels that no statistic tells
    rows = spark.createDataFrame([(i, a.tolist(), int(b)) for i, (a, b) in enumerate(zip(x, y, strict=True))], "doc_id long, x array<double>, y int")
    model = quality.fit(rows, bins=10)
    assert len(model.values) < 8 and np.ptp(model.values) < 0.75  # seen copies would give a map from 0 to 1


def test_one_text_alone_is_calibrated(spark):
    rows = spark.createDataFrame([(i, [1.0] * len(quality.STATISTICS), i % 2) for i in range(20)], "doc_id long, x array<double>, y int")
    model = quality.fit(rows)
    assert {round(r["score"], 6) for r in quality.scored(rows.select("doc_id", "x"), model).collect()} == {0.5}
