"""SimHash near-duplicates by a Gray-order hierarchical index.

Fingerprints cut into p parts agree on at least p - 3 of them if they are within 3 of 64 bits. So each distinct
fingerprint is seen in a view for each choice of p - 3 parts, its bits put in another order so that these lead; an upper
node of a view holds all that share the leading parts (no difference spent there). p grows with the table (4 parts of
16 bits, 4 views; 5 parts, 10 views; 6 parts, 20 views; ...), so that an upper node holds NODE members on average at
most and work stays in proportion to the fingerprints. Below it the fingerprints are sorted by Gray rank, consecutive
ones are grouped into nodes, the bit pattern that all members share (under a mask) is factored into the node, and
groups of nodes form further nodes. Two nodes are compared once for all their members: differences in the bits that
both have fixed accumulate on the way down, and the pair is pruned with everything below it once they exceed 3.
Nodes of a partition are traversed together with numpy. Links go out as a spanning forest, never as all pairs.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import map_batches, texts
from .common import components, cut, free, table
from .rolling import labels, pairs_of, signed

MAX_BITS = 3
SHINGLE = 3
FANOUT = 8
#: Members of an upper node that one task compares; larger ones are dealt to blocks and every pair of blocks is compared.
BLOCK = 8192
#: Average members of an upper node beyond which a finer top level is taken.
NODE = 64
MOST_PARTS = 8
#: 8-byte ids or keys that a broadcast may hold: some 32 MB as a hash table.
MAX_BROADCAST_IDS = 1_000_000
#: Node pairs compared at once.
FRONT = 1 << 20
_SEED = 42


def fingerprint(text: bytes) -> int:
    """Of UTF-8 bytes: a bit is 1 if set in over half the XXH64 values of the 3-word shingles of the words, A-Z
    lower-cased; fewer words are one shingle; no words give 0."""
    words = text.lower().split()
    if not words:
        return 0
    shingles = map(b" ".join, zip(words, words[1:], words[2:], strict=False)) if len(words) >= SHINGLE else [b" ".join(words)]
    h = np.fromiter((xxhash.xxh64_intdigest(s, _SEED) for s in shingles), np.uint64)
    n, total = len(h), np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):
        total += np.unpackbits(h[i : i + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(total * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long). Null texts have no words."""
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("fp", T.LongType())])

    def make():
        return lambda batch: [batch.column(0), pa.array(signed(np.array([fingerprint(t) for t in batch.column(1).to_pylist()], np.uint64)))]

    return map_batches(texts(docs), make, schema)


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of a code in the reflected Gray order."""
    x = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(s)
    return x


def linked(group: np.ndarray, code: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """For codes sorted by (group, Gray rank): the first member of each code's component among the links in its group."""
    n = len(code)
    lab = np.arange(n)
    if n < 2:
        return lab
    one = np.uint64(0xFFFFFFFFFFFFFFFF)
    levels = [(code, np.full(n, one), group, None, None)]
    while True:  # nodes of FANOUT consecutive nodes, never across groups
        pattern, mask, of, _, _ = levels[-1]
        first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        size = np.diff(np.concatenate([first, [len(of)]]))
        if (size == 1).all():
            break
        rank = np.arange(len(of)) - np.repeat(first, size)
        begin = np.flatnonzero(rank % FANOUT == 0)
        count = np.diff(np.concatenate([begin, [len(of)]]))
        lead = pattern[begin]
        same = np.bitwise_and.reduceat(mask & ~(pattern ^ np.repeat(lead, count)), begin)
        levels.append((lead & same, same, of[begin], begin, count))
    roots = np.arange(len(levels[-1][0]))
    stack = [(len(levels) - 1, roots, roots, np.zeros(len(roots), np.uint8))]
    while stack:
        level, a, b, spent = stack.pop()
        if not level:
            i, j = a[a != b], b[a != b]
            lab = labels(n, i, j, lab)
            continue
        pattern, mask, _, begin, count = levels[level]
        child_pattern, child_mask = levels[level - 1][:2]
        work = count[a] * count[b]
        if work.sum() > FRONT and len(a) > 1:
            half = len(a) // 2
            stack += [(level, a[:half], b[:half], spent[:half]), (level, a[half:], b[half:], spent[half:])]
            continue
        entry, i, j = pairs_of(count[a], begin[a], count[b], begin[b])
        keep = i <= j
        entry, i, j = entry[keep], i[keep], j[keep]
        fixed = mask[a] & mask[b]
        fresh = child_mask[i] & child_mask[j] & ~fixed[entry]
        now = spent[entry] + np.bitwise_count((child_pattern[i] ^ child_pattern[j]) & fresh)
        keep = now <= max_bits
        stack.append((level - 1, i[keep], j[keep], now[keep]))
    return lab


def parts_for(n: int, node: int = NODE) -> int:
    """Parts of a fingerprint for a table of n: of p parts p - 3 lead, in choose(p, 3) views."""
    return next((p for p in range(MAX_BITS + 1, MOST_PARTS) if n <= node << (64 * (p - MAX_BITS) // p)), MOST_PARTS)


def turned(x: np.ndarray, parts: int, lead: tuple[int, ...]) -> tuple[np.ndarray, int]:
    """Codes with the bits of the leading parts first, and the number of these bits."""
    edges = [64 * k // parts for k in range(parts + 1)]
    out, leading = np.zeros_like(x), sum(edges[k + 1] - edges[k] for k in lead)
    for k in [*lead, *(k for k in range(parts) if k not in lead)]:
        width = edges[k + 1] - edges[k]
        out = (out << np.uint64(width)) | ((x >> np.uint64(64 - edges[k + 1])) & np.uint64((1 << width) - 1))
    return out, leading


def links(distinct: DataFrame, node: int = NODE) -> DataFrame:
    """Edges u, v between the `rep`s of distinct fingerprints (fp, rep), whose components are those of all links."""
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("gray", T.LongType()), T.StructField("code", T.LongType()), T.StructField("rep", T.LongType())])
    parts = parts_for(distinct.count(), node)
    views = list(itertools.combinations(range(parts), parts - MAX_BITS))

    def seen_in(batches):
        for batch in batches:
            x = batch.column(0).to_numpy().view(np.uint64)
            for v, lead in enumerate(views):
                code, leading = turned(x, parts, lead)
                key = (code >> np.uint64(64 - leading)).astype(np.int64) + (v << leading)
                order = signed(gray_rank(code) ^ np.uint64(1 << 63))  # signed order is the unsigned one
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(order), pa.array(signed(code)), batch.column(1)], schema.names)

    seen = distinct.select("fp", "rep").mapInArrow(seen_in, schema)
    hot = cut(seen.groupBy("key").count().where(F.col("count") > BLOCK).select("key", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")))
    if crowded := hot.count():
        dealt = seen.join(F.broadcast(hot) if crowded <= MAX_BROADCAST_IDS else hot, "key", "left").withColumn("own", F.pmod(F.xxhash64("code"), F.coalesce("blocks", F.lit(1))).cast("int"))
        dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)))
        dealt = dealt.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "gray", "code", "rep")
    else:
        dealt = seen.select("key", F.lit(0).alias("i"), F.lit(0).alias("j"), "gray", "code", "rep")
    spread = dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "gray")
    edge = T.StructType([T.StructField("u", T.LongType()), T.StructField("v", T.LongType())])

    def search(batches):
        held: list[np.ndarray] = []

        def flush(rows):
            new = (rows[1:, :3] != rows[:-1, :3]).any(axis=1)
            lab = linked(np.concatenate([[0], np.cumsum(new)]), np.ascontiguousarray(rows[:, 4]).view(np.uint64))
            own = np.flatnonzero(lab != np.arange(len(lab)))
            if len(own):
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(rows[own, 5])), pa.array(np.ascontiguousarray(rows[lab[own], 5]))], edge.names)

        for batch in batches:
            if batch.num_rows:
                held.append(np.stack([c.to_numpy().astype(np.int64) for c in batch.columns], 1))
                if sum(map(len, held)) >= 2 * BLOCK:  # up to the last group, which may go on
                    rows = np.concatenate(held)
                    last = np.flatnonzero((rows[1:, :3] != rows[:-1, :3]).any(axis=1))
                    if len(last):
                        yield from flush(rows[: last[-1] + 1])
                        rows = rows[last[-1] + 1 :]
                    held = [rows]
        if held:
            yield from flush(np.concatenate(held))

    return spread.mapInArrow(search, edge)


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, fp, component_id for every row of docs; component_id is the smallest doc_id reachable by links of at
    most 3 differing bits. Equal fingerprints (all texts without words among them) are one class. Repeated rows each
    get their row; empty input gives none; doc_id is an integer (rows without one are classed, but name no class that
    has others). Texts of any length are read whole; columns but doc_id and text aren't read."""
    prints = cut(fingerprints(docs))
    distinct = cut(prints.groupBy("fp").agg(F.min("doc_id").cast("long").alias("rep")).where("rep is not null"))
    found = components(links(distinct))
    named = distinct.join(found, F.col("rep") == F.col("node"), "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return prints.join(named, "fp", "left").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame) -> DataFrame:
    """docs without the documents that aren't the first (smallest doc_id) of their class; columns as in docs. The ids
    that go are broadcast up to MAX_BROADCAST_IDS of them, so that texts stay in place; more are joined by shuffle."""
    name = free(docs, "_gone_id")
    gone = cut(classes(docs).where("doc_id <> component_id").select(F.col("doc_id").alias(name)))
    if gone.count() <= MAX_BROADCAST_IDS:
        gone = F.broadcast(gone)
    return docs.join(gone, F.col("doc_id") == F.col(name), "left_anti")


def op2_gray_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = classes(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
