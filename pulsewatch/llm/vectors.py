"""Near-duplicate embeddings with a navigable small-world graph per shard.

Vectors of one label are dealt over shards of bounded size. A shard first groups its vectors into
balls: within half the link angle of a leader, so that all members of a ball link with each other.
The leaders form a hierarchical navigable small-world graph. Every vector queries every shard of
its label, in blocks: a beam search finds all leaders that can hold a partner, wide enough that
its last entry is too far; some queries of each block are audited against all leaders of the
shard, and the beam widens until no leader is missed. Where the angles to a leader and its ball
settle the matter all members count or none, else the cosines are computed in double precision.
A query links with a ball by one edge, so a large group of copies costs one edge for each member
and shard; components are found over those edges.

Edge cases: rows that repeat a vec_id are one vector (the smallest label, then embedding); null
labels, and vectors that are null, empty, zero or hold null or non-finite components, link with
nothing; vectors of different lengths do not link; a null vec_id has 0 links, a null component and
is kept. Other columns are not read.
"""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsewatch.llm.common import stored
from pulsewatch.llm.components import components

THRESHOLD = 0.93
SHARD = 8192  # vectors in a shard, on average
BLOCK = 4096  # queries in a block, on average
NEIGHBOURS = 12
BEAM = 48
AUDITED = 24  # queries of a block that are held against all leaders
SLACK = 1e-7  # radians by which a bound must be clear


class Graph:
    """Hierarchical small-world graph over unit vectors, built and searched in batches."""

    def __init__(self, dim: int, neighbours: int = NEIGHBOURS, beam: int = BEAM, seed: int = 7) -> None:
        self.x = np.empty((0, dim), np.float32)
        self.level = np.empty(0, np.int64)
        self.layers: list[np.ndarray] = []
        self.neighbours, self.beam, self.entry = neighbours, beam, -1
        self.islands = np.empty(0, np.int64)  # further starts, one for each part that the entry cannot reach
        self.random = np.random.default_rng(seed)

    def width(self, layer: int) -> int:
        return self.neighbours * (2 if layer == 0 else 1)

    def beam_search(self, queries: np.ndarray, start: np.ndarray, beam: int, layer: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and cosines of the nearest nodes found, nearest first; -1 where there are fewer."""
        adjacent, q = self.layers[layer], len(queries)
        beam = max(beam, start.shape[1])
        rows = np.arange(q)
        seen = np.zeros((q, len(self.x)), bool)
        ids = np.full((q, beam), -1, np.int64)
        near = np.full((q, beam), -np.inf, np.float32)
        done = np.ones((q, beam), bool)
        k = start.shape[1]
        ids[:, :k] = start
        near[:, :k] = np.where(start >= 0, np.einsum("qd,qkd->qk", queries, self.x[start]), -np.inf)
        done[:, :k] = start < 0
        seen[rows[:, None], start] = True
        active, at_once = rows, min(4, beam)
        while True:
            waiting = np.where(done[active], -np.inf, near[active])
            pick = np.argpartition(-waiting, at_once - 1, axis=1)[:, :at_once]
            usable = np.take_along_axis(waiting, pick, axis=1) > -np.inf
            some = usable.any(axis=1)
            active, pick, usable = active[some], pick[some], usable[some]
            if not len(active):
                break
            at = active[:, None]
            done[at, pick] = True
            found = np.where(usable[:, :, None], adjacent[ids[at, pick]], -1).reshape(len(active), -1)
            found = np.where((found >= 0) & ~seen[at, found], found, -1)
            found.sort(axis=1)
            found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
            fresh = found >= 0
            seen[np.broadcast_to(at, found.shape)[fresh], found[fresh]] = True
            cosine = np.where(fresh, np.einsum("qd,qkd->qk", queries[active], self.x[found]), -np.inf)
            every = np.concatenate((near[active], cosine), axis=1)
            best = np.argpartition(-every, beam - 1, axis=1)[:, :beam]
            ids[active] = np.take_along_axis(np.concatenate((ids[active], found), axis=1), best, axis=1)
            done[active] = np.take_along_axis(np.concatenate((done[active], ~fresh), axis=1), best, axis=1)
            near[active] = np.take_along_axis(every, best, axis=1)
        order = np.argsort(-near, axis=1, kind="stable")
        return np.take_along_axis(ids, order, axis=1), np.take_along_axis(near, order, axis=1)

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``beam`` nearest nodes that a descent through the layers finds."""
        if self.entry < 0:
            return np.full((len(queries), 1), -1), np.full((len(queries), 1), -np.inf, np.float32)
        start = np.full((len(queries), 1), self.entry, np.int64)
        for layer in range(len(self.layers) - 1, 0, -1):
            start = self.beam_search(queries, start, 4, layer)[0]
        others = np.broadcast_to(self.islands, (len(queries), len(self.islands)))
        start = np.concatenate((np.where(np.isin(start, self.islands), -1, start), others), axis=1)
        return self.beam_search(queries, start, min(beam, len(self.x)), 0)

    def find_islands(self) -> None:
        """Pruned edges can cut nodes off; give each part that is cut off a start of its own."""
        reached, islands = np.zeros(len(self.x), bool), []
        front = np.array([self.entry] if self.entry >= 0 else [], np.int64)
        while not reached.all():
            if not len(front):
                front = np.flatnonzero(~reached)[:1]
                islands.append(int(front[0]))
            reached[front] = True
            front = np.unique(self.layers[0][front])
            front = front[(front >= 0) & ~reached[front]]
        self.islands = np.array(islands, np.int64)

    def _chosen(self, nodes: np.ndarray, ids: np.ndarray, near: np.ndarray, width: int) -> np.ndarray:
        """Of candidates, nearest first, those nearer to the node than to any chosen one; then the nearest others."""
        vectors = self.x[ids]
        between = np.einsum("acd,aed->ace", vectors, vectors)
        valid = (ids >= 0) & (ids != nodes[:, None]) & (near > -np.inf)
        closest = np.full(near.shape, -np.inf, np.float32)
        taken = np.zeros(near.shape, bool)
        for c in range(ids.shape[1]):
            ok = valid[:, c] & (near[:, c] > closest[:, c]) & (taken.sum(axis=1) < width)
            taken[ok, c] = True
            closest[ok] = np.maximum(closest[ok], between[ok, :, c])
        rank = np.where(taken, 0, np.where(valid, 1, 2)) * ids.shape[1] + np.arange(ids.shape[1])
        order = np.argsort(rank, axis=1)[:, :width]
        out = np.where(np.take_along_axis(valid, order, axis=1), np.take_along_axis(ids, order, axis=1), -1)
        if out.shape[1] < width:
            out = np.pad(out, ((0, 0), (0, width - out.shape[1])), constant_values=-1)
        return out

    def _add_back(self, layer: int, nodes: np.ndarray, chosen: np.ndarray) -> None:
        """Edges from the chosen to the nodes; a full node keeps the best of old and new."""
        sources, targets = np.repeat(nodes, chosen.shape[1]), chosen.ravel()
        sources, targets = sources[targets >= 0], targets[targets >= 0]
        if not len(targets):
            return
        cosine = np.einsum("ed,ed->e", self.x[sources], self.x[targets])
        order = np.lexsort((-cosine, targets))
        sources, targets = sources[order], targets[order]
        owners, first = np.unique(targets, return_index=True)
        place = np.arange(len(targets)) - np.repeat(first, np.diff(np.append(first, len(targets))))
        slots = min(64, int(place.max()) + 1)
        new = np.full((len(owners), slots), -1, np.int64)
        fits = place < slots
        new[np.searchsorted(owners, targets[fits]), place[fits]] = sources[fits]
        both = np.concatenate((self.layers[layer][owners], new), axis=1)
        both.sort(axis=1)
        both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
        near = np.where(both >= 0, np.einsum("ad,acd->ac", self.x[owners], self.x[both]), -np.inf)
        order = np.argsort(-near, axis=1, kind="stable")
        both, near = np.take_along_axis(both, order, axis=1), np.take_along_axis(near, order, axis=1)
        self.layers[layer][owners] = self._chosen(owners, both, near, self.width(layer))

    def add(self, vectors: np.ndarray) -> None:
        """Insert a batch; its vectors are candidates for each other as well."""
        if not len(vectors):
            return
        first, count = len(self.x), len(vectors)
        nodes = np.arange(first, first + count)
        level = np.floor(-np.log(1 - self.random.random(count)) / np.log(self.neighbours)).astype(np.int64)
        top = len(self.layers) - 1
        start = np.full((count, 1), self.entry, np.int64)
        found: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for layer in range(top, -1, -1):
            found[layer] = self.beam_search(vectors, start, min(self.beam, max(1, first)), layer)
            start = found[layer][0][:, :4]
        self.x = np.concatenate((self.x, vectors.astype(np.float32)))
        self.level = np.concatenate((self.level, level))
        for layer in range(max(top, int(level.max())) + 1):
            if layer == len(self.layers):
                self.layers.append(np.full((first, self.width(layer)), -1, np.int64))
            self.layers[layer] = np.concatenate((self.layers[layer], np.full((count, self.width(layer)), -1, np.int64)))
            own = np.flatnonzero(level >= layer)
            if not len(own):
                continue
            mutual = vectors[own] @ vectors[own].T
            np.fill_diagonal(mutual, -np.inf)
            keep = min(self.beam, len(own))
            peers = np.argpartition(-mutual, keep - 1, axis=1)[:, :keep]
            ids, near = nodes[own][peers], np.take_along_axis(mutual, peers, axis=1)
            if layer in found:
                ids = np.concatenate((ids, found[layer][0][own]), axis=1)
                near = np.concatenate((near, found[layer][1][own]), axis=1)
            order = np.argsort(-near, axis=1, kind="stable")[:, : 2 * self.beam]
            ids, near = np.take_along_axis(ids, order, axis=1), np.take_along_axis(near, order, axis=1)
            chosen = self._chosen(nodes[own], ids, near, self.width(layer))
            self.layers[layer][nodes[own]] = chosen
            self._add_back(layer, nodes[own], chosen)
        if self.entry < 0 or level.max() > self.level[self.entry]:
            self.entry = int(nodes[np.argmax(level)])


def unit_rows(values: pd.Series) -> np.ndarray:
    x = np.stack([np.asarray(v, np.float64) for v in values])
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("nd,nd->n", x, x))[:, None]


def build(ids: np.ndarray, x: np.ndarray, threshold: float) -> dict:
    """Balls and graph of one shard; members lie ball by ball."""
    inside = np.cos(np.arccos(threshold) / 2 - SLACK)
    graph = Graph(x.shape[1])
    leaders: list[int] = []
    ball = np.full(len(x), -1, np.int64)
    at = 0
    while at < len(x):
        part = np.arange(at, min(len(x), at + min(512, max(32, len(leaders) // 2))))
        at = int(part[-1]) + 1
        if leaders:
            nearest = graph.search(x[part].astype(np.float32), 8)[0][:, 0]
            cosine = np.einsum("nd,nd->n", x[part], x[np.array(leaders)[nearest]])
            ball[part] = np.where(cosine >= inside, nearest, -1)
        rest = part[ball[part] < 0]
        mutual, fresh = x[rest] @ x[rest].T, []
        for i, row in enumerate(rest):
            if ball[row] < 0:
                joined = rest[(mutual[i] >= inside) & (ball[rest] < 0)]
                ball[joined] = len(leaders) + len(fresh)
                ball[row] = len(leaders) + len(fresh)
                fresh.append(int(row))
        graph.add(x[fresh].astype(np.float32))
        leaders += fresh
    graph.find_islands()
    order = np.argsort(ball, kind="stable")
    bounds = np.searchsorted(ball[order], np.arange(len(leaders) + 1))
    cosine = np.clip(np.einsum("nd,nd->n", x[order], x[np.array(leaders)[ball[order]]]), -1, 1)
    radius = np.arccos(np.minimum.reduceat(cosine, bounds[:-1])) if len(x) else np.empty(0)
    return {
        "graph": graph, "leaders": x[leaders], "leader_ids": ids[leaders], "members": x[order],
        "member_ids": ids[order], "bounds": bounds, "radius": radius,
    }


def reach(shard: dict, queries: np.ndarray, threshold: float, audited: int = AUDITED) -> tuple[np.ndarray, np.ndarray]:
    """All (query, ball) that can hold a link, by beams that widen until their audits pass."""
    graph, leaders = shard["graph"], shard["leaders"]
    n, angle = len(leaders), np.arccos(threshold)
    # float32 search: a margin beyond its rounding
    cutoff = np.cos(min(np.pi, angle + float(shard["radius"].max(initial=0.0)) + 1e-3))
    audit = np.unique(np.linspace(0, len(queries) - 1, min(audited, len(queries))).astype(int))
    truth = queries[audit] @ leaders.T >= cutoff
    beam = min(BEAM, n)
    pairs: dict[int, np.ndarray] = {}
    open_rows = np.arange(len(queries))
    while len(open_rows) and beam < n:
        wide = []
        for at in range(0, len(open_rows), 512):
            rows = open_rows[at : at + 512]
            ids, near = graph.search(queries[rows].astype(np.float32), beam)
            full = near[:, -1] >= cutoff
            wide.append(rows[full])
            for row, own, cosine in zip(rows[~full], ids[~full], near[~full], strict=True):
                pairs[int(row)] = own[(cosine >= cutoff) & (own >= 0)]
        open_rows = np.concatenate(wide)
        if any(int(a) in pairs and not set(np.flatnonzero(t)) <= set(pairs[int(a)].tolist()) for a, t in zip(audit, truth, strict=True)):
            open_rows = np.arange(len(queries))
            pairs.clear()
        beam = min(n, 2 * beam)
    for at in range(0, len(open_rows), 256):  # as wide as the shard: all leaders
        hit = queries[open_rows[at : at + 256]] @ leaders.T >= cutoff
        pairs.update((int(open_rows[at + i]), np.flatnonzero(h)) for i, h in enumerate(hit))
    sizes = [len(pairs[i]) for i in range(len(queries))]
    which = np.repeat(np.arange(len(queries)), sizes)
    return which, np.concatenate([np.empty(0, np.int64), *[pairs[i] for i in range(len(queries))]]).astype(np.int64)


def link(shard: dict, ids: np.ndarray, queries: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links of each query in the shard, and edges (query, leader of a ball it links with)."""
    which, balls = reach(shard, queries, threshold)
    angle, bounds = np.arccos(threshold), shard["bounds"]
    # a vector of this shard meets its own ball whatever the beam has found
    by_id = np.argsort(shard["member_ids"], kind="stable")
    place = by_id[np.minimum(np.searchsorted(shard["member_ids"], ids, sorter=by_id), len(by_id) - 1)]
    here = np.flatnonzero(shard["member_ids"][place] == ids)
    home = np.searchsorted(bounds, place[here], side="right") - 1
    both = np.unique(np.stack((np.append(which, here), np.append(balls, home))), axis=1)
    which, balls = both[0], both[1]
    between = np.arccos(np.clip(np.einsum("nd,nd->n", queries[which], shard["leaders"][balls]), -1, 1))
    radius = shard["radius"][balls]
    sizes = (bounds[1:] - bounds[:-1])[balls]
    every = between + radius <= angle - SLACK
    none = between - radius > angle + SLACK
    counts = np.where(every, sizes, 0)
    for i in np.flatnonzero(~every & ~none):
        members = shard["members"][bounds[balls[i]] : bounds[balls[i] + 1]]
        counts[i] = int((members @ queries[which[i]] >= threshold).sum())
    total = np.bincount(which, weights=counts, minlength=len(queries)).astype(np.int64)
    total[here] -= 1  # these have counted themselves
    tied = counts > 0
    return total, ids[which[tied]], shard["leader_ids"][balls[tied]]


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every vector (vec_id, embedding, label)."""
    rows = stored(
        vectors.groupBy("vec_id").agg(F.min(F.struct("label", "embedding")).alias("v")).select(
            "vec_id", F.col("v.label").alias("label"), F.col("v.embedding").cast("array<double>").alias("embedding")
        ),
        "vectors",
    )
    finite = F.forall(
        "embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    ) & F.exists("embedding", lambda c: c != 0)
    usable = rows.where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("embedding") > 0) & finite
    ).withColumn("dim", F.size("embedding"))
    sizes = usable.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.select(
        "label", "dim", F.ceil(F.col("n") / shard).cast("int").alias("shards"), F.ceil(F.col("n") / block).cast("int").alias("blocks")
    )
    dealt = usable.join(sizes, ["label", "dim"]).select(
        "vec_id", "label", "dim", "embedding", "shards", "blocks",
        F.pmod(F.xxhash64("vec_id", F.lit(1)), F.col("shards")).cast("int").alias("shard"),
        F.pmod(F.xxhash64("vec_id", F.lit(2)), F.col("blocks")).cast("int").alias("block"),
    )
    label = rows.schema["label"].dataType.simpleString()
    node = rows.schema["vec_id"].dataType.simpleString()

    def build_shard(key: tuple, own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("vec_id")
        made = build(own["vec_id"].to_numpy(), unit_rows(own["embedding"]), threshold)
        return pd.DataFrame(
            {"label": [key[0]], "dim": [key[1]], "shard": [key[2]], "blocks": [int(own["blocks"].iloc[0])], "graph": [_packed(made)]}
        )

    def ask(key: tuple, graphs: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        if not len(graphs) or not len(own):
            return pd.DataFrame({"vec_id": [], "n": [], "balls": []})
        ids = own["vec_id"].to_numpy()
        total, sources, targets = link(_unpacked(graphs["graph"].iloc[0]), ids, unit_rows(own["embedding"]), threshold)
        balls = pd.Series(targets).groupby(pd.Series(sources)).agg(list) if len(sources) else pd.Series(dtype=object)
        return pd.DataFrame({"vec_id": ids, "n": total, "balls": [balls.get(i, []) for i in ids]})

    graphs = stored(
        dealt.groupBy("label", "dim", "shard").applyInPandas(
            build_shard, f"label {label}, dim int, shard int, blocks int, graph binary"
        ),
        "graphs",
    )
    keys = ["label", "dim", "shard", "block"]
    offered = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    asking = dealt.select("label", "dim", "block", "vec_id", "embedding", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"))
    answers = stored(
        offered.groupBy(*keys)
        .cogroup(asking.groupBy(*keys))
        .applyInPandas(ask, f"vec_id {node}, n long, balls array<{node}>"),
        "answers",
    )
    counts = answers.groupBy("vec_id").agg(F.sum("n").alias("n_links"))
    groups = components(answers.select(F.col("vec_id").alias("a"), F.explode("balls").alias("b")), "vector")
    return (
        rows.select("vec_id")
        .join(counts, "vec_id", "left")
        .join(groups.withColumnRenamed("node", "vec_id"), "vec_id", "left")
        .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    )


def _packed(made: dict) -> bytes:
    """A shard as plain arrays, so that reading it needs none of this module's classes."""
    graph = made.pop("graph")
    return pickle.dumps((made, graph.x, graph.level, graph.layers, graph.entry, graph.islands))


def _unpacked(data: bytes) -> dict:
    made, x, level, layers, entry, islands = pickle.loads(data)
    graph = Graph(x.shape[1])
    graph.x, graph.level, graph.layers, graph.entry, graph.islands = x, level, layers, entry, islands
    return made | {"graph": graph}
