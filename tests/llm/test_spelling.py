"""Spelling variants against a comparison of all words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from pulsewatch.llm import spelling

SCHEMA = "doc_id long, text string, word string, n int"


def brute(rows, modulus=97, least_length=5, least_count=3, ratio=2):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % modulus == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}

    def one_apart(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    near = {a: [b for b in words if one_apart(a, b)] for a in words}
    form = {}
    for a, others in near.items():
        top = min(others, key=lambda b: (-words[b], b), default=None)
        if top and words[top] >= ratio * words[a]:
            form[a] = top
    out = set()
    for a in words:
        root = a
        while root in form:
            root = form[root]
        out.add((a, form.get(a), root, words[a], len(near[a]), words.get(form.get(a))))
    return out


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)


def found(docs, **options):
    rows = spelling.variants(docs, **options).collect()
    out = {tuple(r) for r in rows}
    assert len(rows) == len(out)
    return out


@pytest.mark.parametrize("cell", [spelling.CELL, 8])
def test_equals_a_comparison_of_all_words(spark, cell):
    draw = random.Random(5)
    letters = "aabcdeéÉ"
    words = ["".join(draw.choices(letters, k=draw.choice([4, 5, 5, 6, 6, 7]))) for _ in range(500)]
    words += [w[:2] + "z" + w[3:] for w in words[:40]] + [w[:3] + w[4:] for w in words[:40]]
    rows = [(i, " ".join(draw.choices(words, k=200)) + "; 7Zœ" + draw.choice(words).upper()) for i in range(40)]
    assert found(docs_of(spark, rows), cell=cell) == brute(rows)


def test_empty_null_long_repeated_and_tied(spark):
    long = "q" * 3000
    rows = [(1, None), (2, ""), (3, "12 ; !"), (None, "planet planet planet planet"), (4, f"{long} " * 3 + f"{long}q " * 6)]
    rows += [(5, "planes planes planes planes planes planes planes planes")] * 2
    rows += [(6, "planed " * 16), (7, "plane " * 50000), (8, "Planeé planeé planeé"), (9, "naps spans snaps")]
    assert found(docs_of(spark, rows)) == brute(rows)
    assert found(docs_of(spark, [])) == set()
    tied = [(1, "crane " * 9 + "crate " * 9 + "crave " * 4)]
    assert ("crave", "crane", "crane", 4, 2, 9) in found(docs_of(spark, tied), modulus=10**9)


def test_forms_lead_to_the_last(spark):
    rows = [(1, "marble " * 40 + "marbles " * 20 + "marbless " * 10 + "mmarbless " * 3)]
    got = {r[0]: r[2] for r in found(docs_of(spark, rows), modulus=10**9)}
    assert got == dict.fromkeys(("marble", "marbles", "marbless", "mmarbless"), "marble")


def test_anagrams_meet_by_a_hash(monkeypatch, spark):
    draw = random.Random(2)
    words = sorted({"".join(draw.sample("abcdef", 6)) for _ in range(300)} | {"".join(draw.sample("abcdeg", 6)) for _ in range(300)})
    words += sorted({"".join(draw.sample("abcdefh", 7)) for _ in range(300)})
    rows = [(1, " ".join(w for w in words for _ in range(3 + len(w) % 2)))]
    expected = brute(rows, modulus=10**9)
    for bound in (0, 1 << 30):
        cells = {}
        monkeypatch.setattr(spelling, "ANAGRAMS", bound)
        for length in (6, 7):
            some = [w for w in words if len(w) == length]
            cells[length] = spelling.Cell(some, [3] * len(some))
        pairs = set(cells[6].near([w for w in words if len(w) == 6], False)) | set(cells[7].near([w for w in words if len(w) == 6], True))
        pairs |= set(cells[7].near([w for w in words if len(w) == 7], False))
        degree = Counter(w for p in pairs for w in p)
        assert {r[0]: r[4] for r in expected} == {w: degree[w] for w in words}


def test_a_tree_finds_all_in_reach():
    draw = np.random.default_rng(3)
    counts = draw.integers(0, 3, (400, spelling._DIMS)).astype(np.int8) * (draw.random((400, spelling._DIMS)) < 0.05)
    counts = counts.astype(np.int8)
    codes = spelling.Codes(counts)
    points, _ = codes.encode(counts)
    asked = counts[:50].copy()
    asked[:, 0] += 1
    packed, over = codes.encode(asked)
    for tight in (True, False):
        tree = spelling.KdTree(codes, points, 8, tight)
        got = set()
        for node, rows in tree.reach(packed, 1, 2):
            got |= {(int(r), int(m)) for r in rows for m in tree.members[node]}
        for q in range(50):
            gap = counts.astype(int) - asked[q]
            for p in np.flatnonzero((np.maximum(gap, 0).sum(1) <= 1) & (np.maximum(-gap, 0).sum(1) <= 2)):
                assert (q, int(p)) in got
    homes = [int(r) for _, rows in spelling.KdTree(codes, points, 8, False).reach(points, 0, 0) for r in rows]
    assert sorted(homes) == list(range(400))
