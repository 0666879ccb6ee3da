"""Exact substring dedup by distributed prefix doubling over sampled positions.

Ranking every byte's suffix would move each byte's (position, rank) pair through one sort per doubling. Equal ranks are
all that is asked for, and only up to 100 bytes, so positions are first thinned without loss: every 100-byte string is
filed under the least hash of its 32-byte substrings, its seed, and neighbouring starts filed under the same value form
one run. Equal strings are filed under equal seeds, so the runs' seeds are the positions that Spark sorts:

1. 32 bytes. Runs are sorted by seed; each different seed gets its number in that order as its rank. A run whose seed is
   unique has no repeat and leaves; a run whose extent (all its 100-byte strings at once) has an earlier equal is a
   repeat from end to end and leaves.
2. 66 bytes. Of the rest, the first of each extent under a rank, pairs (rank of the seed, the 34 bytes beside it) are
   sorted and numbered anew; strings whose pair is unique leave. A string takes the bytes to the left of its seed if it
   has so many there, else those to the right; of several equal seeds in a string the first counts.
3. 100 bytes. Pairs (rank of 66 bytes, what is left of the string at its two ends) are sorted; past the threshold a
   string is a repeat if its pair occurs earlier.

Each round's pair holds the rank that the round before gave; its other half names the bytes that come in by a 64-bit
hash, as only seeds are ranked. Ranks are numbers within a sorted partition, with the partition's number in front.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import map_batches, steps, texts
from .common import cut, free, table
from .rolling import Prefix, mix, signed, sliding

LENGTH = 100
SEED_LENGTH = 32
#: Starts in a run at most; longer runs (periodic text) are several.
RUN = 120
#: Bytes of text hashed at once; a step needs about a hundred times as much.
STEP = 1 << 20


def runs(values: list[bytes], length: int = LENGTH, seed: int = SEED_LENGTH):
    """Of a block of texts: text number, first start in it, number of starts, least seed hash, extent hash, and whether
    the seed occurs more than once under the run (then strings of the run may repeat each other)."""
    flat = np.frombuffer(b"".join(values), np.uint8)
    sizes = np.array([len(v) for v in values], np.int64)
    ends = np.cumsum(sizes)
    n = len(flat) - length + 1
    if n < 1 or sizes.max() < length:
        return None
    prefix = Prefix(flat)
    h = np.maximum(prefix.fixed(seed), np.uint64(1))
    w = length - seed + 1
    least = sliding(np.minimum, h, w)
    text = np.repeat(np.arange(len(values)), sizes)[:n]
    least[np.arange(n) + length > ends[text]] = 0
    starts = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    stops = np.concatenate([starts[1:], [n]])
    real = least[starts] > 0
    starts, stops = starts[real], stops[real]
    if not len(starts):
        return None
    # a seed's place p is the least of some string if the largest of the minima around it is its own hash
    padded = np.concatenate([np.zeros(w - 1, np.uint64), least, np.zeros(w - 1, np.uint64)])
    place = np.flatnonzero(sliding(np.maximum, padded, w)[: len(h)] == h)
    run = np.searchsorted(starts, place, side="right") - 1
    wrong = np.flatnonzero(least[starts[run]] != h[place])
    while len(wrong):
        run[wrong] -= 1
        wrong = wrong[(run[wrong] >= 0) & (least[starts[np.maximum(run[wrong], 0)]] != h[place[wrong]])]
    many = np.bincount(run[run >= 0], minlength=len(starts)) > 1
    pieces = -(-(stops - starts) // RUN)
    of = np.repeat(np.arange(len(starts)), pieces)
    step = (np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * RUN
    a = starts[of] + step
    b = np.minimum(a + RUN, stops[of])
    doc = text[a]
    extent = prefix.hash(a, b - 1 + length)
    return doc, a - (ends[doc] - sizes[doc]), b - a, least[a], extent, many[of]


def _once(doc: np.ndarray, start: np.ndarray, count: np.ndarray, k: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of a block's runs (doc: ids): the first of each extent, and the others, which repeat it. A hot seed of copies so
    comes to its task once for each block. Rows of a text repeated under its doc_id are neither."""
    order = np.lexsort((start, doc, count, e, k))
    new = np.concatenate([[True], (k[order[1:]] != k[order[:-1]]) | (e[order[1:]] != e[order[:-1]]) | (count[order[1:]] != count[order[:-1]])])
    first = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    return order[new], order[~new & ((doc[order] != doc[first]) | (start[order] != start[first]))]


def _split(sorted_runs: DataFrame) -> DataFrame:
    """Of runs sorted by (k, e, doc_id, at): repeats (k null) and the firsts that need a closer look (k kept), with the
    rank of their seed. Runs without k are repeats already."""
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("doc_id", "at", "k", "rank")])

    def run(batches):
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 40
        number = 0  # of the seed last seen
        last = None  # k, e, doc_id, at of the row before
        waiting = None  # the only first of the group so far, if it hasn't gone out
        for batch in batches:
            if known := batch.column(0).null_count:
                none = pa.nulls(known, pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(2).slice(0, known), batch.column(3).slice(0, known), none, none], schema.names)
                batch = batch.slice(known)
            if not batch.num_rows:
                continue
            k, e, doc, at = (c.to_numpy() for c in batch.columns)
            before = last if last is not None else (~k[0], 0, 0, 0)
            lag = lambda x, v: np.concatenate([[v], x[:-1]])
            new_k = k != lag(k, before[0])
            new_e = new_k | (e != lag(e, before[1])) | ((at & 0xFF) >> 1 != (lag(at, before[3]) & 0xFF) >> 1)
            itself = (doc == lag(doc, before[2])) & (at == lag(at, before[3])) & ~new_e
            group = np.cumsum(new_k)
            rank = base + number + group
            number += int(group[-1])
            firsts = np.bincount(group[new_e], minlength=group[-1] + 1)
            out = [waiting] if waiting is not None and firsts[0] else []
            if group[0] == 0:  # the last batch's group goes on; unless its one first waits, what comes is not alone
                firsts[0] += 1 if waiting is not None else 2 * (last is not None)
            if waiting is not None and (len(out) or group[-1] > 0):
                waiting = None
            look = new_e & ((firsts[group] > 1) | (at & 1 == 1))
            alone = np.flatnonzero(new_e & ~look & (group == group[-1]))
            if len(alone):
                waiting = (doc[alone[-1]], at[alone[-1]], k[alone[-1]], rank[alone[-1]])
            gone = ~new_e & ~itself
            held = np.array(out, np.int64).reshape(-1, 4)
            columns = [np.concatenate([held[:, i], x[look], x[gone]]) for i, x in enumerate((doc, at, k, rank))]
            if len(columns[0]):
                over = np.arange(len(columns[0])) >= len(out) + look.sum()
                yield pa.RecordBatch.from_arrays([pa.array(columns[0]), pa.array(columns[1]), pa.array(columns[2], mask=over), pa.array(columns[3], mask=over)], schema.names)
            last = (k[-1], e[-1], doc[-1], at[-1])

    return sorted_runs.mapInArrow(run, schema)


def _reranked(sorted_pairs: DataFrame, keys: int) -> DataFrame:
    """Of rows sorted by their first `keys` columns (the pair): those whose pair occurs twice, with the pair's number in
    that order as `rank` in the place of the pair."""
    rest = sorted_pairs.schema.fields[keys:]
    schema = T.StructType([T.StructField("rank", T.LongType()), *rest])

    def run(batches):
        from pyspark import TaskContext

        base, number, held, last = TaskContext.get().partitionId() << 40, 0, None, None
        emit = lambda cols, ranks: pa.RecordBatch.from_arrays([pa.array(ranks), *cols], schema.names)
        for batch in batches:
            if not batch.num_rows:
                continue
            pair = np.stack([batch.column(i).to_numpy() for i in range(keys)], 1)
            same = np.concatenate([[last is not None and bool((pair[0] == last).all())], (pair[1:] == pair[:-1]).all(1)])
            rank = base + number + np.cumsum(~same)
            number += int((~same).sum())
            if same[0] and held is not None:  # the last batch's last row has met its equal
                yield emit(held.columns, np.array([rank[0]]))
            twice = same | np.concatenate([same[1:], [False]])
            if twice.any():
                use = np.flatnonzero(twice)
                yield emit([c.take(pa.array(use)) for c in batch.columns[keys:]], rank[use])
            held = None if twice[-1] else pa.RecordBatch.from_arrays([c.slice(batch.num_rows - 1, 1) for c in batch.columns[keys:]], schema.names[1:])
            last = pair[-1]

    return sorted_pairs.mapInArrow(run, schema)


def _doubled(own: DataFrame, firsts: DataFrame, length: int, seed: int) -> DataFrame:
    """doc_id, look: array of (rank, side, place, start, n): strings in question whose 66 bytes, seed and those beside
    it, occur twice, with the rank of these 66 bytes and the place of the seed."""
    half, w = (length - seed) // 2, length - seed + 1
    names = ("below", "side", "name", "doc_id", "place", "start", "n")
    schema = T.StructType([T.StructField(c, T.LongType()) for c in names])

    def pairs():
        def step(batch):
            out = []
            for doc, text, look in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                prefix, size = Prefix(np.frombuffer(text, np.uint8)), len(text)
                h = signed(np.maximum(prefix.fixed(seed), np.uint64(1)))
                at, k, rank = (look.values.field(c).to_numpy() for c in ("at", "k", "rank"))
                first, n = at >> 8, (at & 0xFF) >> 1
                span = n + w - 1
                run = np.repeat(np.arange(len(at)), span)
                place = np.repeat(first - (np.cumsum(span) - span), span) + np.arange(span.sum())
                hit = h[place] == k[run]
                run, place = run[hit], place[hit]
                # a string belongs to the first seed in it
                before = np.concatenate([[-1], np.where(run[1:] == run[:-1], place[:-1], -1)])
                low = np.maximum(np.maximum(first[run], before + 1), place - w + 1)
                high = np.minimum(first[run] + n[run], place + 1)
                turn = np.clip(place - half + 1, low, np.maximum(low, high))  # strings before it have half to the left
                for side, begin, end, x, y in ((0, low, turn, place - half, place + seed), (1, turn, high, place, place + seed + half)):
                    use = (end > begin) & (x >= 0) & (y <= size)
                    out.append((rank[run[use]], np.full(use.sum(), side), signed(prefix.hash(x[use], y[use])), np.full(use.sum(), doc), place[use], begin[use], (end - begin)[use]))
            return [pa.array(np.concatenate(x)) for x in zip(*out, strict=True)]

        return step

    looked = firsts.groupBy("doc_id").agg(F.collect_set(F.struct("at", "k", "rank")).alias("look"))
    paired = map_batches(own.join(looked, "doc_id").select("doc_id", "text", "look"), pairs, schema, limit=STEP)
    ranked = _reranked(paired.repartition("below", "side", "name").sortWithinPartitions("below", "side", "name"), 3)
    return ranked.groupBy("doc_id").agg(F.collect_set(F.struct("rank", "place", "start", "n")).alias("look"))


def repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED_LENGTH) -> DataFrame:
    """doc_id, spans: array of (start, starts): 100-byte strings that occur earlier begin at start, start + 1, ...
    Documents without any are absent."""
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("k", "e", "doc_id", "at")])

    def make():
        def step(batch):
            found = runs(batch.column(1).to_pylist(), length, seed)
            if found is None:
                return None
            doc, start, count, k, e, many = found
            ids, k, e = batch.column(0).to_numpy()[doc].astype(np.int64), signed(k), signed(e)
            first, again = _once(ids, start, count, k, e)
            order = np.concatenate([first, again])
            return [pa.array(k[order], mask=np.arange(len(order)) >= len(first)), pa.array(e[order]), pa.array(ids[order]), pa.array(((start << 8) | (count << 1) | many)[order])]

        return step

    own = texts(docs).where("doc_id is not null")
    filed = map_batches(own, make, schema, limit=STEP).repartition(F.coalesce("k", F.xxhash64("doc_id", "at")))
    split = cut(_split(filed.sortWithinPartitions("k", "e", "doc_id", "at")))
    start, count = F.shiftright("at", 8), F.shiftright(F.col("at").bitwiseAND(0xFF), 1)
    closer = _doubled(own, split.where("k is not null"), length, seed)
    one = T.StructType([T.StructField(c, T.LongType()) for c in ("below", "name", "doc_id", "start")])

    def strings():
        half, turn = (length - seed) // 2, np.uint64(0x9E3779B97F4A7C15)

        def step(batch):
            out = []
            for doc, text, look in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                prefix = Prefix(np.frombuffer(text, np.uint8))
                rank, place, first, n = (look.values.field(c).to_numpy() for c in ("rank", "place", "start", "n"))
                pos = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
                place = np.repeat(place, n)
                left = pos <= place - half
                x, y = np.where(left, place - half, place), np.where(left, place + seed, place + seed + half)
                name = prefix.hash(pos, x) ^ mix(prefix.hash(y, pos + length) + (place - pos).astype(np.uint64) * turn)
                out.append((np.repeat(rank, n), signed(name), np.full(len(pos), doc, np.int64), pos))
            return [pa.array(np.concatenate(x)) for x in zip(*out, strict=True)]

        return step

    paired = map_batches(own.join(closer, "doc_id").select("doc_id", "text", "look"), strings, one, limit=STEP)
    # rank, not row_number: a doc_id in several rows gives the same (doc_id, start) again, which is no earlier copy
    again = paired.withColumn("n", F.rank().over(W.partitionBy("below", "name").orderBy("doc_id", "start"))).where("n > 1").select("doc_id", "start", F.lit(1).cast("long").alias("starts"))
    whole = split.where("k is null").select("doc_id", start.alias("start"), count.alias("starts"))
    return whole.union(again).groupBy("doc_id").agg(F.collect_list(F.struct("start", "starts")).alias("spans"))


def _cover(size: int, start: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Which bytes the strings cover."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, start, 1)
    np.add.at(change, start + starts - 1 + length, -1)
    return np.cumsum(change[:-1]) > 0


def _with_spans(docs: DataFrame, length: int, seed: int) -> DataFrame:
    return texts(docs).where("doc_id is not null").join(repeats(docs, length, seed), "doc_id").select("doc_id", "text", "spans")


def _masks(batch, length):
    for text, spans in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
        yield text, _cover(len(text), spans.values.field("start").to_numpy(), spans.values.field("starts").to_numpy(), length)


def removed(docs: DataFrame, length: int = LENGTH, seed: int = SEED_LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row of docs.

    Documents come in the order of their integer doc_id, which stands for one text: rows repeated as they are count as
    one occurrence and each gets the result. Null texts are empty; texts under `length` bytes lose nothing; rows without
    a doc_id keep their text and count for no other; an empty table gives no rows; other columns aren't read."""
    schema = T.StructType([T.StructField("_id", T.LongType()), T.StructField("gone", T.LongType()), T.StructField("n", T.LongType()), T.StructField("sha", T.StringType())])

    def make():
        def step(batch):
            gone, count, sha = [], [], []
            for text, mask in _masks(batch, length):
                gone.append(int(mask.sum()))
                count.append(int(mask[0]) + int((mask[1:] & ~mask[:-1]).sum()))
                sha.append(hashlib.sha256(np.frombuffer(text, np.uint8)[~mask].tobytes()).hexdigest())
            return [batch.column(0).cast(pa.int64()), pa.array(gone, pa.int64()), pa.array(count, pa.int64()), pa.array(sha, pa.string())]

        return step

    changed = map_batches(_with_spans(docs, length, seed), make, schema, limit=STEP).dropDuplicates(["_id"])
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    plain = docs.select("doc_id", F.octet_length(body).cast("long").alias("n_bytes"), F.sha2(body, 256).alias("own"))
    zero = F.lit(0).cast("long")
    return plain.join(changed, F.col("doc_id") == F.col("_id"), "left").select("doc_id", "n_bytes", F.coalesce("gone", zero).alias("n_removed"), F.coalesce("n", zero).alias("n_spans"), F.coalesce("sha", "own").alias("kept_sha256"))


def strip(docs: DataFrame, length: int = LENGTH, seed: int = SEED_LENGTH) -> DataFrame:
    """docs with repeats taken out of their texts; a code point of which a byte is taken goes whole. n_chars, if there,
    is counted anew for changed texts; other columns and null texts stay. Texts move once, to meet their spans."""
    names, own, where = docs.columns, free(docs, "_id"), free(docs, "_spans")
    spans = repeats(docs, length, seed).select(F.col("doc_id").alias(own), F.col("spans").alias(where))

    def run(batches):
        for batch in (part for whole in batches for part in steps(whole, names.index("text"))):
            arrays = list(batch.columns[: len(names)])
            found = batch.column(len(names))
            hit = np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False))
            if len(hit):
                i = names.index("text")
                new = arrays[i].to_pylist()
                counts = arrays[names.index("n_chars")].to_pylist() if "n_chars" in names else None
                for k in hit.tolist():
                    body, x = new[k].encode(), found[k].values
                    mask = _cover(len(body), x.field("start").to_numpy(), x.field("starts").to_numpy(), length)
                    new[k] = np.frombuffer(body, np.uint8)[~mask].tobytes().decode(errors="ignore")
                    if counts:
                        counts[k] = len(new[k])
                arrays[i] = pa.array(new, arrays[i].type)
                if counts:
                    arrays[names.index("n_chars")] = pa.array(counts, arrays[names.index("n_chars")].type)
            yield pa.RecordBatch.from_arrays(arrays, names)

    return docs.join(spans, F.col("doc_id") == F.col(own), "left").select(*names, where).mapInArrow(run, docs.schema)


def op10_prefix_doubling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removed(table(spark, sf_dir, "documents"))
