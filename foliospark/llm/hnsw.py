"""Approximate nearest neighbours by inner product: a hierarchical navigable small-world graph for each shard.

Different vectors are dealt to shards by hash; each shard's graph is built once and written as flat neighbour arrays;
blocks of queries are searched in every shard and the shards' results merged. Equal vectors are one node that lists
its smallest ids, as many as any result can hold, so copies neither crowd the graph nor lose a result.

Graphs are built by insertion (Malkov and Yashunin, 2018): a node's candidates come from a search of the graph so far,
its neighbours from the diversity rule, and links back are pruned by the same rule. Nodes go in by batches, searched in
lockstep with numpy; a batch is at most half of what is there, and its members are candidates for each other. Nodes
that can't be reached then are linked from their nearest reachable neighbour. Inner product becomes distance by one
more coordinate that brings all vectors of a graph to one length (Bachrach et al., 2014). Where that coordinate is
large it drowns the others, so a shard has a graph for each range of lengths. They are searched from the longest
vectors down, and a graph is passed over, without loss, if no vector of its length can reach a query's worst result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, table

TOP = 20
EVERY = 20
SHARD = 16_384
#: A shard's vectors are cut into graphs by length, the longest at most so many times the shortest, but for LEAST_NODES.
LENGTHS = 1.4
LEAST_NODES = 256
#: Links that a node chooses; it keeps twice as many, and half as many again until it is pruned.
DEGREE = 20
#: Candidates that an insertion and a query keep in view.
BUILD_BEAM = 120
BEAM = 400
#: Nodes of the beam that are opened in one step.
WIDE = 4
FIRST, BATCH = 256, 1024
QUERY_BLOCK = 256
#: Query blocks that one task searches in a shard.
CHUNK = 32


def _distance(x: np.ndarray, sq: np.ndarray, q: np.ndarray, row: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Squared distance, less the query's own square, of x[ids] to q[row]."""
    return sq[ids] - 2 * np.einsum("ij,ij->i", x[ids], q[row])


def _parts(a: np.ndarray, size: int) -> list[np.ndarray]:
    return [a[i : i + size] for i in range(0, len(a), size)]


def _diverse(x: np.ndarray, sq: np.ndarray, ids: np.ndarray, dist: np.ndarray, want: int) -> np.ndarray:
    """Of each row's candidates (-1: none, dist inf; dist: squared distances) up to `want`: those that are nearer to
    the row's node than to any chosen before them, and if these are too few the nearest of the rest."""
    order = np.argsort(dist, axis=1, kind="stable")
    ids, dist = np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1)
    among = x[np.maximum(ids, 0)]
    own = sq[np.maximum(ids, 0)]
    cross = own[:, :, None] + own[:, None, :] - 2 * (among @ among.transpose(0, 2, 1))
    kept = np.zeros(ids.shape, bool)
    for j in range(ids.shape[1]):
        kept[:, j] = (ids[:, j] >= 0) & ~(kept[:, :j] & (cross[:, j, :j] < dist[:, j, None])).any(1)
    order = np.argsort(np.where(kept, 0, np.where(ids >= 0, 1, 2)), axis=1, kind="stable")[:, :want]
    return np.take_along_axis(ids, order, 1)


def _beam(x: np.ndarray, sq: np.ndarray, nb: np.ndarray, q: np.ndarray, entry: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-first search of one layer for all queries in lockstep: ids and distances, best first (-1: none)."""
    m, n, every = len(q), len(x), np.arange(len(q))
    ids, dist, done = np.full((m, beam), -1, np.int64), np.full((m, beam), np.inf, np.float32), np.ones((m, beam), bool)
    ids[:, 0], dist[:, 0], done[:, 0] = entry, _distance(x, sq, q, every, entry), False
    seen = np.zeros(m * n, bool)
    seen[every * n + entry] = True
    live = every
    while True:
        waits = ~done[live]
        some = waits.any(1)
        live, waits = live[some], waits[some]
        if not len(live):
            return ids, dist
        # the beam is in order, so the first that wait are the nearest
        r, c = np.nonzero(waits & (np.cumsum(waits, 1) <= WIDE))
        done[live[r], c] = True
        new = nb[ids[live[r], c]]
        key = (live[r][:, None] * n + new)[new >= 0]
        key = np.unique(key[~seen[key]])
        seen[key] = True
        row, new = np.divmod(key, n)
        d = _distance(x, sq, q, row, new)
        good = d < dist[row, -1]
        row, new, d = row[good], new[good], d[good]
        if not len(row):
            continue
        at = np.searchsorted(live, row)
        count = np.bincount(at, minlength=len(live))
        place = np.arange(len(row)) - (np.cumsum(count) - count)[at]
        more, far = np.full((len(live), count.max()), -1, np.int64), np.full((len(live), count.max()), np.inf, np.float32)
        more[at, place], far[at, place] = new, d
        all_ids, all_d = np.concatenate([ids[live], more], 1), np.concatenate([dist[live], far], 1)
        all_done = np.concatenate([done[live], more < 0], 1)
        order = np.argsort(all_d, axis=1, kind="stable")[:, :beam]
        ids[live], dist[live], done[live] = (np.take_along_axis(v, order, 1) for v in (all_ids, all_d, all_done))


def _descend(x: np.ndarray, sq: np.ndarray, layers: list[np.ndarray], root: int, q: np.ndarray) -> np.ndarray:
    """From layer to layer the nearest node that greedy steps reach."""
    at, every = np.full(len(q), root, np.int64), np.arange(len(q))
    best = _distance(x, sq, q, every, at)
    for nb in layers:
        live = every
        while len(live):
            ids = nb[at[live]].astype(np.int64)
            d = sq[np.maximum(ids, 0)] - 2 * np.einsum("qkd,qd->qk", x[np.maximum(ids, 0)], q[live])
            d = np.where(ids < 0, np.inf, d)
            k = d.argmin(1)
            v = d[np.arange(len(live)), k]
            better = v < best[live]
            live, k, v, ids = live[better], k[better], v[better], ids[better]
            at[live], best[live] = ids[np.arange(len(live)), k], v
    return at


def _pruned(x: np.ndarray, sq: np.ndarray, nodes: np.ndarray, cand: np.ndarray, want: int) -> np.ndarray:
    there = np.maximum(cand, 0)
    d = sq[nodes][:, None] + sq[there] - 2 * np.einsum("ijk,ik->ij", x[there], x[nodes])
    return _diverse(x, sq, cand, np.where(cand < 0, np.inf, d), want)


def _insert(x: np.ndarray, sq: np.ndarray, nodes: np.ndarray, entry, degree: int, beam: int) -> np.ndarray:
    """The neighbours (a row for each row of x, -1: none) of one layer whose nodes are inserted in order. entry(rows)
    gives the node from which each one's search begins, one that is in already."""
    most, room = 2 * degree, 3 * degree
    nb, size = np.full((len(x), room), -1, np.int32), np.zeros(len(x), np.int64)
    done = 0
    while done < len(nodes):
        batch = nodes[done : done + (FIRST if not done else min(BATCH, max(FIRST, done // 2)))]
        d = sq[batch][:, None] + sq[batch][None, :] - 2 * (x[batch] @ x[batch].T)
        np.fill_diagonal(d, np.inf)
        near = np.argsort(d, axis=1, kind="stable")[:, :beam]
        dist = np.take_along_axis(d, near, 1)
        ids = np.where(np.isfinite(dist), batch[near], -1).astype(np.int64)
        if done:
            found = [_beam(x, sq, nb, x[b], entry(b), beam) for b in _parts(batch, QUERY_BLOCK)]
            old, far = (np.concatenate(v) for v in zip(*found, strict=True))
            ids, dist = np.concatenate([old, ids], 1), np.concatenate([far + sq[batch][:, None], dist], 1)
            order = np.argsort(dist, axis=1, kind="stable")[:, :beam]
            ids, dist = np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1)
        chosen = np.concatenate([_diverse(x, sq, i, v, degree) for i, v in zip(_parts(ids, 64), _parts(dist, 64), strict=True)])
        width = chosen.shape[1]
        nb[batch, :width] = chosen
        size[batch] = (chosen >= 0).sum(1)
        # links back, those not there by both sides' choice, the nearest first
        src, dst = np.repeat(batch, width), chosen.ravel()
        src, dst = src[dst >= 0], dst[dst >= 0]
        once = ~(nb[dst] == src[:, None]).any(1)
        src, dst = src[once], dst[once]
        d = sq[src] - 2 * np.einsum("ij,ij->i", x[src], x[dst])
        order = np.lexsort((d, dst))
        src, dst = src[order], dst[order]
        rank = np.arange(len(dst)) - np.searchsorted(dst, dst)
        full = size[dst] + np.bincount(dst, minlength=len(x))[dst] > room
        nb[dst[~full], (size[dst] + rank)[~full]] = src[~full]
        for some in _parts(np.unique(dst[full]), 256):
            cand = np.full((len(some), room + most), -1, np.int64)
            cand[:, :room] = nb[some]
            mine = np.isin(dst, some) & (rank < most)
            cand[np.searchsorted(some, dst[mine]), room + rank[mine]] = src[mine]
            nb[some] = -1
            nb[some, :most] = _pruned(x, sq, some, cand, most)
        grown = np.unique(dst)
        size[grown] = (nb[grown] >= 0).sum(1)
        done += len(batch)
    for some in _parts(nodes[size[nodes] > most], 256):
        kept = _pruned(x, sq, some, nb[some].astype(np.int64), most)
        nb[some] = -1
        nb[some, :most] = kept
    return nb[:, :most]


def _connected(nb: np.ndarray, root: int) -> np.ndarray:
    """nb with one more column, in which the nodes that can't be reached from root hang in a chain on the first of
    their own neighbours that can (on root, if none can)."""
    n = len(nb)
    seen, front = np.zeros(n, bool), np.array([root])
    while len(front):
        seen[front] = True
        front = np.unique(nb[front])
        front = front[front >= 0]
        front = front[~seen[front]]
    lost, more = np.flatnonzero(~seen), np.full((n, 1), -1, np.int32)
    if len(lost):
        ok = (nb[lost] >= 0) & seen[np.maximum(nb[lost], 0)]
        host = np.where(ok.any(1), nb[lost][np.arange(len(lost)), ok.argmax(1)], root)
        order = np.argsort(host, kind="stable")
        lost, host = lost[order], host[order]
        follows = np.concatenate([[False], host[1:] == host[:-1]])
        more[np.where(follows, np.concatenate([[0], lost[:-1]]), host), 0] = lost
    return np.concatenate([nb, more], 1)


def build(x: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, seed: int = 7) -> list[tuple[np.ndarray, np.ndarray]]:
    """Layers from the top down: (nodes, neighbours), neighbours an int32 array, -1 for none; the first node of the
    top layer is where searches begin."""
    n, sq = len(x), (x * x).sum(1)
    level = np.floor(-np.log(np.random.Generator(np.random.PCG64(seed)).random(n)) / math.log(degree)).astype(int)
    order = np.argsort(-level, kind="stable")
    above, out = [], []
    for l in range(int(level.max()), -1, -1):
        nodes = order[: int((level >= l).sum())]
        upper = int((level > l).sum())
        rank = np.empty(n, np.int64)
        rank[nodes] = np.arange(len(nodes))

        def entry(rows, above=above, upper=upper, rank=rank):
            # nodes of the layers above go in first; until they are in, searches begin at the first of all
            return np.where(rank[rows] < upper, order[0], _descend(x, sq, above, order[0], x[rows])) if above else np.full(len(rows), order[0])

        nb = _insert(x, sq, nodes, entry, degree, beam)
        if not l:
            nb = _connected(nb, order[0])
        above = [*above, nb]
        out.append((nodes.astype(np.int32), nb[nodes]))
    return out


def search(x: np.ndarray, layers: list[tuple[np.ndarray, np.ndarray]], q: np.ndarray, beam: int = BEAM) -> np.ndarray:
    """For each query the numbers of up to `beam` rows of x found nearest, best first (-1: none)."""
    sq = (x * x).sum(1)
    full = []
    for nodes, nb in layers:
        all_ = np.full((len(x), nb.shape[1]), -1, np.int32)
        all_[nodes] = nb
        full.append(all_)
    entry = _descend(x, sq, full[:-1], int(layers[0][0][0]), q)
    return _beam(x, sq, full[-1], q, entry, min(beam, len(x)))[0]


def length_ranges(norm: np.ndarray, ratio: float = LENGTHS, least: int = LEAST_NODES) -> list[np.ndarray]:
    """Row numbers by falling length, cut where the first is more than `ratio` times as long and `least` rows are in."""
    order = np.argsort(-norm, kind="stable")
    sorted_, out, a = norm[order], [], 0
    while a < len(norm):
        b = max(int(np.searchsorted(-sorted_, -sorted_[a] / ratio, side="right")), a + least)
        b = len(norm) if len(norm) - b < least else b
        out.append(order[a:b])
        a = b
    return out


def _pack(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x).tobytes()


class Graph:
    """A graph and its vectors, to and from flat bytes."""

    @staticmethod
    def make(vectors: np.ndarray) -> dict:
        x, longest = _single(vectors)
        norm = (x.astype(np.float64) ** 2).sum(1)
        lift = np.sqrt(np.maximum(norm.max() - norm, 0)).astype(np.float32)
        layers = build(np.concatenate([x, lift[:, None]], 1))
        return {"vectors": _pack(vectors), "lift": _pack(lift), "longest": longest, "sizes": [len(n) for n, _ in layers], "widths": [nb.shape[1] for _, nb in layers], "nodes": _pack(np.concatenate([n for n, _ in layers])), "neighbours": _pack(np.concatenate([nb.ravel() for _, nb in layers]))}

    def __init__(self, row: dict, dims: int):
        self.vectors = np.frombuffer(row["vectors"]).reshape(-1, dims)
        self.x = np.concatenate([_single(self.vectors)[0], np.frombuffer(row["lift"], np.float32)[:, None]], 1)
        nodes, nb = np.frombuffer(row["nodes"], np.int32), np.frombuffer(row["neighbours"], np.int32)
        self.layers, a, b = [], 0, 0
        for n, w in zip(row["sizes"], row["widths"], strict=True):
            self.layers.append((nodes[a : a + n], nb[b : b + n * w].reshape(n, w)))
            a, b = a + n, b + n * w
        self.members, self.longest = row["members"], row["longest"]

    def nearest(self, ids: list[int], q: np.ndarray, best: list[list[tuple[float, int]]], top: int, beam: int) -> None:
        """Adds (score, -vec_id) of each query's nearest here to its list in best, its own row left out; lists hold
        `top` at most, best first."""
        length = np.array([math.hypot(*v) for v in q])
        can = [k for k in range(len(ids)) if len(best[k]) < top or length[k] * self.longest * (1 + 1e-9) >= best[k][-1][0]]
        if not can:
            return
        found = search(self.x, self.layers, np.concatenate([_single(q[can])[0], np.zeros((len(can), 1), np.float32)], 1), beam)
        for k, near in zip(can, found, strict=True):
            near = near[near >= 0]
            with np.errstate(over="ignore", invalid="ignore"):
                score = np.einsum("kd,d->k", self.vectors[near], q[k])
            rows = best[k]
            for j in np.argsort(-score, kind="stable"):  # equal scores stand together before they are cut
                if len(rows) >= top and score[j] < rows[top - 1][0]:
                    break
                rows += [(score[j], -m) for m in self.members[near[j]] if m != ids[k]]
                rows.sort(reverse=True)
                del rows[top:]


def _single(x: np.ndarray) -> tuple[np.ndarray, float]:
    """In single precision, brought to a largest length of 1, which changes no order; and that length."""
    longest = max((math.hypot(*v) for v in x), default=0.0)
    most = float(np.abs(x).max(initial=0.0)) or 1.0
    y = x / most
    return (y / (np.sqrt((y * y).sum(1)).max(initial=0.0) or 1.0)).astype(np.float32), longest


def valid(vectors: DataFrame, id_col: str, col: str) -> DataFrame:
    """vec_id, v (array of double, as given) of the rows that take part: no nulls, finite, not all zero. Other columns
    aren't read."""
    v = F.col(col).cast("array<double>")
    fine = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0.0)
    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where(fine & F.col("vec_id").isNotNull())


def nearest(vectors: DataFrame, queries: DataFrame, top: int = TOP, beam: int = BEAM, shard_size: int = SHARD) -> DataFrame:
    """query_id, rank, vec_id, score for queries (vec_id, v) among vectors (vec_id, v), both as valid() gives them.

    Scores are exact inner products in double precision (infinite where they overflow), ties go to the smaller vec_id,
    a query's own vec_id is left out. Vectors shorter than the longest count as filled up with zeros. Empty inputs give
    no rows; a vec_id repeated with the same vector counts once.
    """
    spark = vectors.sparkSession
    out = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("vec_id", T.LongType()), T.StructField("score", T.DoubleType())])
    dims = max([x[0] or 0 for df in (vectors, queries) for x in df.agg(F.max(F.size("v"))).collect()])
    filled = lambda df: df.select("vec_id", F.concat("v", F.array_repeat(F.lit(0.0), F.lit(dims) - F.size("v"))).alias("v"))
    # a vector common to any share of the rows: each task sends on its smallest ids only
    ranked = filled(vectors).distinct().withColumn("r", F.row_number().over(W.partitionBy("v").orderBy("vec_id"))).where(F.col("r") <= top + 1)
    distinct = cut(ranked.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("members")))
    asked = cut(filled(queries).distinct())
    n, m = distinct.count(), asked.count()
    if not n or not m:
        return spark.createDataFrame([], T.StructType([T.StructField("query_id", T.LongType()), T.StructField("rank", T.IntegerType()), T.StructField("vec_id", T.LongType()), T.StructField("score", T.DoubleType())]))
    shards, blocks = -(-n // shard_size), -(-m // QUERY_BLOCK)
    chunks = -(-blocks // CHUNK)
    fields = "shard int, vectors binary, lift binary, longest double, sizes array<int>, widths array<int>, nodes binary, neighbours binary, members array<array<bigint>>"

    def make(table_):
        flat = table_.column("v").combine_chunks()
        v = flat.flatten().to_numpy().reshape(-1, dims)
        members, shard = table_.column("members").to_pylist(), table_.column("shard")[0].as_py()
        rows = [Graph.make(v[own]) | {"shard": shard, "members": [members[k] for k in own]} for own in length_ranges(np.sqrt((_single(v)[0].astype(np.float64) ** 2).sum(1)))]
        names = [f.split()[0] for f in fields.split(", ")]
        kinds = {"shard": pa.int32(), "longest": pa.float64(), "sizes": pa.list_(pa.int32()), "widths": pa.list_(pa.int32()), "members": pa.list_(pa.list_(pa.int64()))}
        return pa.table([pa.array([row[c] for row in rows], kinds.get(c, pa.binary())) for c in names], names)

    dealt = distinct.withColumn("shard", F.pmod(F.xxhash64("v"), F.lit(shards)).cast("int"))
    graphs = cut(dealt.groupBy("shard").applyInArrow(make, fields))
    packed = asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")).groupBy("block").agg(F.collect_list(F.struct("vec_id", "v")).alias("asked"))
    # the stated query set in blocks, one copy for each shard; a shard's graphs go once to each chunk of blocks
    spread = packed.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).withColumn("chunk", F.expr(f"block div {CHUNK}").cast("int"))
    graph_rows = graphs.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))).withColumn("block", F.lit(-1))
    both = graph_rows.unionByName(spread, allowMissingColumns=True).repartition("shard", "chunk").sortWithinPartitions("shard", "chunk", "block", F.desc("longest"))

    def run(batches):
        key, own = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if (row["shard"], row["chunk"]) != key:
                    key, own = (row["shard"], row["chunk"]), []
                if row["block"] < 0:
                    own.append(Graph(row, dims))
                    continue
                ids, q = [a["vec_id"] for a in row["asked"]], np.array([a["v"] for a in row["asked"]])
                best: list[list[tuple[float, int]]] = [[] for _ in ids]
                for graph in own:
                    graph.nearest(ids, q, best, top, beam)
                found = [(i, -v, s) for i, x in zip(ids, best, strict=True) for s, v in x]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found, strict=True)], out.names)

    best = both.mapInArrow(run, out)
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


def op7_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = cut(valid(table(spark, sf_dir, "embeddings"), "vec_id", "embedding"))
    return nearest(vectors, vectors.where(F.col("vec_id") % EVERY == 0))
