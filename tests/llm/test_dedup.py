"""Near duplicates of texts and vectors, and components, against brute force."""

import random

import numpy as np
import pytest

from pulsewatch.llm import minhash, vectors
from pulsewatch.llm.components import components


def closure(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {n: root(n) for n in nodes}


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    random.Random(1).shuffle(links)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame([*links, (None, 5)], "a long, b long"), "t").collect()}
    want = closure({n for x in links for n in x}, links)
    assert got == {n: c for n, c in want.items() if n != 300}
    assert components(spark.createDataFrame([], "a long, b long"), "t").count() == 0


def shingles(text, k=3):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))}


def near(rows):
    sets = {i: shingles(t) for i, t in rows if i is not None}
    ids = sorted(sets)
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    return sets, closure(ids, links)


def corpus():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(500)]
    rows = []
    for group in range(6):
        base = [rng.choice(vocabulary) for _ in range(80)]
        for copy in range(25):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 2, 3, 4, 6])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((group * 100 + copy, " ".join(words)))
    rows += [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 60)))) for i in range(700, 760)]
    rows += [(800, "One two"), (801, "one  TWO\n"), (802, "one"), (803, "one two three"), (804, ""), (805, None), (806, " \t"), (807, "É a b"), (808, "é a b")]
    rng.shuffle(rows)
    return rows


def test_near_duplicates_equal_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n", "2 as keys", "3 as rep")
    got = {r["doc_id"]: r for r in minhash.near_duplicates(docs).collect()}
    sets, roots = near(rows)
    assert len(got) == len(rows)
    for i, _ in rows:
        r = got[i]
        assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(sets[i]), roots[i], roots[i] == i)
    kept = minhash.deduplicated(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i in roots if roots[i] == i}


def test_near_duplicates_edges(spark):
    long_word = "x" * (minhash.SEGMENT + 10)
    rows = [(1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (2, "A b c d"), (3, f"{long_word} b c"), (4, f"{long_word} b c"), (5, f"{long_word}y b c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["component_id"], r["kept"]) for r in minhash.near_duplicates(docs).collect() if r["doc_id"])
    assert got == [(1, 1, True), (1, 1, True), (2, 1, False), (3, 3, True), (4, 3, False), (5, 5, True)]
    assert minhash.deduplicated(docs).count() == 4  # 1, 3, 5 and the row without a doc_id
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_word_hashes_do_not_depend_on_segments(monkeypatch):
    text = " ".join(f"word{i % 97}" for i in range(3000))
    whole = minhash.shingle_sets([text, "a b", text], 3, minhash.Powers())
    monkeypatch.setattr(minhash, "SEGMENT", 1000)
    cut = minhash.shingle_sets([text, "a b", text], 3, minhash.Powers())
    assert all((x == y).all() for x, y in zip(whole, cut, strict=True))
    assert len(whole[0]) == len(shingles(text))


def test_signature_matches_with_the_similarity():
    rng = np.random.default_rng(5)
    factors = minhash.multipliers(240)
    a = minhash.mix(rng.integers(0, 1 << 62, 1000).astype(np.uint64))
    b = np.concatenate((a[:900], minhash.mix(rng.integers(0, 1 << 62, 100).astype(np.uint64))))
    same = minhash.band_keys(a, factors, 480, 1) == minhash.band_keys(b, factors, 480, 1)
    assert abs(same.mean() - 900 / 1100) < 0.06


# ---- vectors


def cloud(n=260, dim=16, labels=3):
    rng = np.random.default_rng(9)
    rows = []
    for i in range(n):
        if rows and i % 3:
            base = np.array(rows[rng.integers(len(rows))][1])
            v = base + rng.normal(0, rng.choice([0.0, 0.02, 0.06, 0.1]), dim) * np.linalg.norm(base)
        else:
            v = rng.normal(0, 1, dim) * rng.uniform(0.1, 50)
        rows.append((i, [float(x) for x in v.astype(np.float32)], int(rng.integers(labels)) if i % 3 == 0 else rows[-1][2]))
    return rows


@pytest.mark.parametrize("sizes", [(8192, 4096), (40, 30)])
def test_vectors_equal_brute_force(spark, sizes):
    rows = cloud()
    odd = [(900, None, 1), (901, [], 1), (902, [0.0] * 16, 1), (903, [float("nan")] + [1.0] * 15, 1), (904, [None] + [1.0] * 15, 1), (905, rows[0][1], None), (906, [float("inf")] * 16, 1), (907, rows[0][1][:8], rows[0][2])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 as shard", "2 as n")
    got = {r["vec_id"]: r for r in vectors.near_vectors(df, shard=sizes[0], block=sizes[1]).collect()}
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    linked = (x @ x.T >= 0.93) & (label[:, None] == label)
    np.fill_diagonal(linked, False)
    roots = closure(range(len(rows)), zip(*np.nonzero(linked), strict=True))
    assert linked.sum() > 300
    for i in range(len(rows)):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (linked[i].sum(), roots[i], roots[i] == i)
    for i, _, _ in odd:
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)


def test_vectors_edges(spark):
    schema = "vec_id long, embedding array<float>, label int"
    rows = [(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [2.0, 0.1], 0), (None, [1.0, 0.0], 0), (3, [-1.0, 0.0], 0)]
    got = sorted((r["vec_id"] or 0, r["n_links"], r["component_id"], r["kept"]) for r in vectors.near_vectors(spark.createDataFrame(rows, schema)).collect())
    assert got == [(0, 0, None, True), (1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]
    assert vectors.near_vectors(spark.createDataFrame([], schema)).count() == 0


def test_graph_recall():
    x = np.random.default_rng(2).normal(size=(1500, 24)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph = vectors.Graph(24)
    for at in range(0, len(x), 200):
        graph.add(x[at : at + 200])
    found = graph.search(x[:300], 64)[0][:, :10]
    truth = np.argsort(-(x[:300] @ x.T), axis=1)[:, :10]
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(found, truth, strict=True)]) > 0.95


def test_each_text_of_a_repeated_id_links(spark):
    draw = random.Random(9)
    a, b, c = (" ".join(f"{x}{draw.randrange(10**6)}" for _ in range(60)) for x in "abc")
    schema = "doc_id long, text string"
    for one, two, other in ((1, 1, 2), (5, 5, 2), (1, 3, 2)):
        rows = [(one, a), (two, b), (other, b + " more"), (9, a + " more"), (10, c), (None, a), (10, c)]
        got = minhash.near_duplicates(spark.createDataFrame(rows, schema)).collect()
        ids = [{x for x in (one, two, other, 9) if x}] if one == two else [{one, 9}, {two, other}]
        want = {i: min(group) for group in ids for i in group} | {10: 10, None: None}
        assert len(got) == len(rows) and {(r["doc_id"], r["component_id"]) for r in got} == set(want.items())
        assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
