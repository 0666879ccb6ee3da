"""Substring dedup by paragraph MinHash banding.

Paragraphs are lines; inside a line a paragraph also ends at a sentence end (a word ending in . ! or ? before one that
doesn't begin with a-z), so that a passage set into another text falls into the same paragraphs there. Sentences of
under MIN_WORDS words are joined to the short ones after them in their line until they have enough; what is left over
before a longer one or at the line's end is a paragraph too: every word lies in exactly one. Words are those of the
SimHash operator (A-Z lower-cased), shingles have five words (fewer words: the whole). Paragraphs equal word for word
are one class without further work. Of the different ones, those that share a band (6 bands of 2 rows: a pair of
Jaccard similarity 0.8 is missed with probability 0.36**6 = 0.0022) are joined with the other paragraphs in that
bucket, the exact Jaccard similarity of their shingle sets is computed, and components of the links give the classes.
In each class the first paragraph stays.

Passages without a whole paragraph are found by chunks: CHUNK words, at the least hash of every WINDOW neighbouring
starts (winnowing). Two texts that share CHUNK + WINDOW - 1 = 51 words in a row choose an equal chunk there, wherever
lines and sentences end. A text of fewer words is one chunk. Chunks are compared word for word, and reported where
reported paragraphs don't cover them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import map_batches, texts
from .common import components, cut, drop_cut, table
from .rolling import Prefix, labels, mix, point_offsets, signed, sliding

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 6, 2
#: Sentences with fewer words are joined to the short ones that follow in their line.
MIN_WORDS = 10
#: Words of a chunk, and neighbouring starts of which one is chosen.
CHUNK, WINDOW = 31, 21
#: What counts as a repeated passage: neighbouring repeated paragraphs with so many words in all. A shorter one is a
#: common line; min_run_words=0 reports these too. Chunks have no such least.
MIN_RUN_WORDS = 20
#: Members of a bucket that one task compares; larger buckets are thinned around pivots first.
BLOCK = 2048
#: Buckets of up to so many members are compared many at a time.
SMALL = 16
STEP = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32
_RNG = np.random.Generator(np.random.PCG64(977))
_ODD = _RNG.integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_XOR = _RNG.integers(0, 1 << 63, BANDS * ROWS, np.uint64)
_K = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)]


def _joined(sizes: list[int], line_ends: list[bool], least: int) -> list[int]:
    """The last sentence of each paragraph: sentences are taken together in order until they have `least` words, never
    across a line's end nor into a sentence that has enough by itself."""
    out, words = [], 0
    for k, (n, ends) in enumerate(zip(sizes, line_ends, strict=True)):
        if words and n >= least:
            out.append(k - 1)
            words = 0
        words += n
        if ends or words >= least:
            out.append(k)
            words = 0
    return out


class Paragraphs:
    """Of a block of texts: doc (text number), number (among its text's paragraphs), start, end (code points), words,
    fp (of the word sequence), word (place in its text), and the shingles of paragraph i in
    shingles[first[i] : first[i] + count[i]]."""

    def __init__(self, values: list[bytes], least: int = MIN_WORDS):
        raw = np.frombuffer(b"\n".join(values) + b"\n", np.uint8)
        flat = _LOW[raw]
        begins = np.cumsum([0] + [len(v) + 1 for v in values[:-1]])
        inside = ~_SPACE[flat]
        edge = np.diff(np.concatenate([[0], inside.view(np.int8), [0]]))
        ws, we = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        word = Prefix(flat).hash(ws, we)
        lines = np.cumsum(flat == 10)
        gap = np.concatenate([lines[ws[1:]] > lines[we[:-1] - 1], [True]]) if len(ws) else np.zeros(0, bool)
        last = flat[we - 1]
        small = np.concatenate([(raw[ws[1:]] >= 97) & (raw[ws[1:]] <= 122), [False]]) if len(ws) else gap
        close = np.flatnonzero(gap | (((last == 46) | (last == 33) | (last == 63)) & ~small))
        ends = np.array(_joined(np.diff(close, prepend=-1).tolist(), gap[close].tolist(), least), np.int64)
        close = close[ends]
        first = np.concatenate([[0], close[:-1] + 1]).astype(np.int64) if len(close) else np.zeros(0, np.int64)
        self.bounds = np.searchsorted(ws, np.append(begins, len(flat)))
        self.of = np.repeat(np.arange(len(values)), np.diff(self.bounds))
        self.doc, self.words = self.of[first], close - first + 1
        self.number = np.arange(len(first)) - np.searchsorted(self.doc, self.doc)
        points = point_offsets(flat)
        self.place = lambda doc, a, b: (points[ws[a]] - points[begins[doc]], points[we[b]] - points[begins[doc]])
        self.word = first - self.bounds[self.doc]
        self.start, self.end = self.place(self.doc, first, close)
        self.prefix = Prefix(np.arange(len(word)), word)
        own = self.prefix.hash(first, close + 1) ^ _K[0]
        self.fp = signed(mix(own))
        self.count = np.maximum(self.words - SHINGLE + 1, 1)
        self.first = np.cumsum(self.count) - self.count
        five = self.prefix.fixed(SHINGLE) if len(word) >= SHINGLE else np.zeros(0, np.uint64)
        at = np.repeat(first - self.first, self.count) + np.arange(self.count.sum())
        short = np.repeat(self.words < SHINGLE, self.count)
        self.shingles = np.where(short, np.repeat(own, self.count), five[np.minimum(at, len(five) - 1)] if len(five) else np.uint64(0))

    def chunks(self) -> tuple[np.ndarray, ...]:
        """doc, number (after those of the text's paragraphs), start, end, words, fp, word (place in its text)."""
        sizes, span, of, prefix = np.diff(self.bounds), CHUNK + WINDOW - 1, self.of, self.prefix
        doc = np.flatnonzero((sizes > 0) & (sizes < span))
        first, words = self.bounds[doc], sizes[doc]
        fp = prefix.hash(first, first + words)
        if sizes.max(initial=0) >= span:
            h = np.maximum(prefix.fixed(CHUNK), np.uint64(1))
            least = sliding(np.minimum, h, WINDOW)
            least[of[: len(least)] != of[span - 1 :]] = 0
            none = np.zeros(WINDOW - 1, np.uint64)
            at = np.flatnonzero(sliding(np.maximum, np.concatenate([none, least, none]), WINDOW) == h)
            # of equal chunks that overlap (periodic text) one for every CHUNK words is enough
            new = np.concatenate([[True], (h[at[1:]] != h[at[:-1]]) | (at[1:] - at[:-1] >= CHUNK)])
            turn = (at - at[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]) // CHUNK
            at = at[new | np.concatenate([[False], turn[1:] > turn[:-1]])]
            first, words, fp = np.concatenate([first, at]), np.concatenate([words, np.full(len(at), CHUNK)]), np.concatenate([fp, h[at]])
            order = np.argsort(first, kind="stable")
            first, words, fp = first[order], words[order], fp[order]
            doc = of[first]
        before = np.bincount(self.doc, minlength=len(sizes))
        number = before[doc] + np.arange(len(doc)) - np.searchsorted(doc, doc)
        return doc, number, *self.place(doc, first, first + words - 1), words, signed(fp), first - self.bounds[doc]

    def bands(self) -> np.ndarray:
        if not len(self.first):
            return np.zeros((0, BANDS), np.uint64)
        least = [np.minimum.reduceat((self.shingles ^ x) * a, self.first) for a, x in zip(_ODD, _XOR, strict=True)]
        return np.stack([mix(sum((least[b * ROWS + r] * _K[r] for r in range(ROWS)), np.uint64(b * int(_K[4]) % (1 << 64)))) for b in range(BANDS)], 1)


def _longs(*names: str) -> T.StructType:
    return T.StructType([T.StructField(c, T.LongType()) for c in names])


def _units(own: DataFrame) -> DataFrame:
    """Paragraphs and chunks: doc_id, paragraph, start, end, n_words, fp, word, chunk, again (not the first of equal
    ones in its text), and for paragraphs of SHINGLE words or more their bands b0, b1, ..."""
    names = [f"b{i}" for i in range(BANDS)]
    schema = _longs("doc_id", "paragraph", "start", "end", "n_words", "fp", "word").add("chunk", T.BooleanType()).add("again", T.BooleanType())
    for c in names:
        schema = schema.add(c, T.LongType())

    def make():
        def step(batch):
            p = Paragraphs(batch.column(1).to_pylist())
            doc, *columns = (np.concatenate(x).astype(np.int64) for x in zip((p.doc, p.number, p.start, p.end, p.words, p.fp, p.word), p.chunks(), strict=True))
            order = np.lexsort((columns[0], columns[4], doc))
            again = np.zeros(len(doc), bool)
            again[order[1:]] = (doc[order[1:]] == doc[order[:-1]]) & (columns[4][order[1:]] == columns[4][order[:-1]])
            more = len(doc) - len(p.doc)
            none = np.concatenate([p.words < SHINGLE, np.ones(more, bool)])
            bands = [pa.array(np.concatenate([signed(b), np.zeros(more, np.int64)]), mask=none) for b in np.ascontiguousarray(p.bands().T)]
            return [*(pa.array(x) for x in (batch.column(0).to_numpy()[doc].astype(np.int64), *columns, np.arange(len(doc)) >= len(p.doc), again)), *bands]

        return step

    return map_batches(own, make, schema, limit=STEP)


def _different(units: DataFrame, bands: list[str]) -> DataFrame:
    """A row for each fp: fp, doc_id and paragraph (the first there), several (in more places than one), bands. `again`
    leaves one row for each fp and text, so that the first text names one paragraph; a row repeated under its doc_id is
    no other place."""
    first = F.min_by("paragraph", F.when(~F.col("again"), F.col("doc_id")))
    found = units.groupBy("fp").agg(F.min("doc_id").alias("doc_id"), first.alias("paragraph"), F.max("doc_id").alias("to"), F.max("again").alias("again"), *[F.first(b).alias(b) for b in bands])
    return found.select("fp", "doc_id", "paragraph", ((F.col("doc_id") < F.col("to")) | F.col("again")).alias("several"), *bands)


def _buckets(different: DataFrame) -> DataFrame:
    """band, fp: the members of every bucket that has at least two. `different`: fp and its bands, a row for each fp."""
    rows = different.where("b0 is not null").select(F.explode(F.array(*[f"b{i}" for i in range(BANDS)])).alias("band"), "fp")

    def shared(batches):
        last = waiting = None  # the last row's bucket, and its member if that hasn't gone out
        for batch in batches:
            if not batch.num_rows:
                continue
            band, fp = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            same = band[1:] == band[:-1]
            before = last is not None and band[0] == last
            use = np.concatenate([[before], same]) | np.concatenate([same, [False]])
            out = [np.zeros(0, np.int64)] * 2
            if before and waiting is not None:
                out = [np.array([last]), np.array([waiting])]
            waiting = None if use[-1] else fp[-1]
            last = band[-1]
            if use.any():
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([a, x[use]])) for a, x in zip(out, (band, fp), strict=True)], ["band", "fp"])

    return rows.repartition("band").sortWithinPartitions("band").mapInArrow(shared, _longs("band", "fp"))


def similar(sets: list[np.ndarray], similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of distinct-valued arrays whose exact Jaccard similarity reaches the threshold, by sparse counting."""
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, code = np.unique(np.concatenate(sets), return_inverse=True)
    width = int(code.max()) + 1
    found: list[tuple[np.ndarray, np.ndarray]] = []
    side = max(1, min(len(sets), (8 << 20) // max(1, width)))
    dense = lambda lo, hi: _dense(owner, code, lo, hi, width)
    for lo in range(0, len(sets), side):
        a = dense(lo, min(lo + side, len(sets)))
        for lo2 in range(lo, len(sets), side):
            b = a if lo2 == lo else dense(lo2, min(lo2 + side, len(sets)))
            both = a @ b.T
            either = sizes[lo : lo + len(a), None] + sizes[None, lo2 : lo2 + len(b)] - both
            i, j = np.nonzero(both >= similarity * either - 1e-9)
            i, j = i + lo, j + lo2
            found.append((i[i < j], j[i < j]))
    return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])


def _dense(owner, code, lo, hi, width):
    out = np.zeros((hi - lo, width), np.float32)
    a, b = np.searchsorted(owner, [lo, hi])
    out[owner[a:b] - lo, code[a:b]] = 1
    return out


def similar_in_groups(group: np.ndarray, sizes: np.ndarray, values: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """similar() inside every group at once, for small groups: rows i, j of one group. values: the rows' sets, one
    after another; group: a number for each row, the same for neighbours of one group."""
    row = np.repeat(np.arange(len(group)), sizes)
    order = np.lexsort((row, values, group[row]))
    row, values = row[order], values[order]
    same = (values[1:] == values[:-1]) & (group[row[1:]] == group[row[:-1]])
    pairs, hit, lag = [], same, 1
    while hit.any():  # hit: the element `lag` places on is the same one
        at = np.flatnonzero(hit)
        pairs.append(row[at] * len(group) + row[at + lag])
        hit = hit[:-1] & same[lag:]
        lag += 1
    if not pairs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pair, both = np.unique(np.concatenate(pairs), return_counts=True)
    i, j = np.divmod(pair, len(group))
    close = both >= similarity * (sizes[i] + sizes[j] - both) - 1e-9
    return i[close], j[close]


def _dealt(members: DataFrame) -> DataFrame:
    """band, i, j, fp, shingles: buckets of more than BLOCK members as pairs of blocks, each member in every pair of its
    block."""
    sizes = members.groupBy("band").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    own = members.join(sizes, "band").withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("long"))
    both = own.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1)))
    return both.select("band", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp", "shingles")


def _around_pivots(rest: DataFrame, similarity: float) -> tuple[list[DataFrame], list[DataFrame]]:
    """Hot buckets (band, fp, shingles) without squares, as groups (band, i, j, fp, shingles) to compare and links (u, v)
    found on the way. Jaccard distance is a metric: with r the distance of a link, members within r of a pivot are
    linked to it and need no comparison with each other, and those beyond 2r from it can't be linked to them. So only the
    members between r and 2r meet those within r, and the rest goes on to a new pivot. What pivots don't thin out by
    a tenth is dealt to pairs of blocks."""
    groups, links, turn = [], [], 0
    while True:
        turn += 1
        hot = cut(rest.groupBy("band").agg(F.min("fp").alias("pivot"), F.count("*").alias("n")).where(F.col("n") > BLOCK))
        mark = F.lit(turn).cast("long")
        groups.append(rest.join(hot.select("band"), "band", "left_anti").select("band", mark.alias("i"), mark.alias("j"), "fp", "shingles"))
        total = hot.agg(F.sum("n")).first()[0]
        if not total:
            return groups, links
        rest = rest.join(hot.select("band"), "band", "left_semi")
        pivots = rest.join(hot, "band").where("fp = pivot").select("band", "pivot", F.col("shingles").alias("p"))
        both = F.size(F.array_intersect("shingles", "p"))
        share = both / (F.size("shingles") + F.size("p") - both)
        near = F.col("share") >= similarity - 1e-9
        seen = cut(rest.join(pivots, "band").select("band", "fp", "shingles", "pivot", share.alias("share")).withColumn("near", near).withColumn("ring", ~near & (F.col("share") >= 2 * similarity - 1 - 1e-9)))
        links.append(seen.where("near and fp <> pivot").select(F.col("fp").alias("u"), F.col("pivot").alias("v")))
        sizes = seen.groupBy("band").agg(F.ceil(F.count_if("near") / BLOCK).cast("int").alias("a"), F.ceil(F.count_if("ring") / BLOCK).cast("int").alias("b")).where("b > 0")
        own = lambda n: F.pmod(F.xxhash64("fp"), F.col(n)).cast("long")
        every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n).cast("long") - 1))
        for part, i, j in (("near", own("a"), every("b")), ("ring", every("a"), own("b"))):
            met = seen.where(part).join(sizes, "band").select("band", "fp", "shingles", i.alias("i"), j.alias("j"))
            groups.append(met.select("band", (F.lit(turn << 32) + F.col("i")).alias("i"), "j", "fp", "shingles"))
        rest = seen.where("not near").select("band", "fp", "shingles")
        if seen.where("near").count() < total / 10:
            return [*groups, _dealt(rest)], links


def _links(members: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """u, v (fp): a spanning forest, for each group of a bucket, of the pairs similar enough."""
    hot = cut(members.groupBy("band").count().where(F.col("count") > BLOCK).select("band"))
    zero = F.lit(0).cast("long")
    full, links = members.join(sets, "fp").select("band", zero.alias("i"), zero.alias("j"), "fp", "shingles"), []
    if not hot.isEmpty():
        crowd = cut(members.join(hot, "band", "left_semi").join(sets, "fp").select("band", "fp", "shingles"))
        groups, links = _around_pivots(crowd, similarity)
        full = full.join(hot, "band", "left_anti")
        for g in groups:
            full = full.unionByName(g)
    spread = full.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j")

    def compare(table_):
        """Of whole groups, one after another."""
        key = np.stack([table_.column(c).to_numpy().astype(np.int64) for c in range(3)], 1)
        fp, lists = table_.column(3).to_numpy(), table_.column(4).combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        offsets = lists.offsets.to_numpy()
        values, offsets = lists.values.to_numpy()[offsets[0] : offsets[-1]], offsets - offsets[0]
        head = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(1)]))
        count = np.diff(np.append(head, len(fp)))
        group = np.repeat(np.arange(len(head)), count)
        small = (count <= SMALL)[group]
        sizes = np.diff(offsets)
        own = np.flatnonzero(small)
        i, j = similar_in_groups(group[own], sizes[own], values[np.repeat(small, sizes)], similarity)
        i, j = [own[i]], [own[j]]
        for k in np.flatnonzero(count > SMALL):
            a = head[k]
            x, y = similar([values[offsets[r] : offsets[r + 1]] for r in range(a, a + count[k])], similarity)
            i.append(x + a)
            j.append(y + a)
        lab = labels(len(fp), np.concatenate(i), np.concatenate(j))
        linked = np.flatnonzero(lab != np.arange(len(lab)))
        return pa.RecordBatch.from_arrays([pa.array(fp[linked]), pa.array(fp[lab[linked]])], ["u", "v"]) if len(linked) else None

    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            held = pa.concat_tables([*([held] if held is not None else []), pa.Table.from_batches([batch])])
            if held.num_rows < SMALL * SMALL:
                continue
            key = [held.column(c).to_numpy() for c in range(3)]
            last = np.flatnonzero(np.logical_or.reduce([x[1:] != x[:-1] for x in key]))
            if len(last):
                if (out := compare(held.slice(0, int(last[-1]) + 1))) is not None:
                    yield out
                held = held.slice(int(last[-1]) + 1)
        if held is not None and held.num_rows and (out := compare(held)) is not None:
            yield out

    out = spread.mapInArrow(run, _longs("u", "v"))
    for more in links:
        out = out.union(more)
    return out


def repeated(docs: DataFrame, similarity: float = SIMILARITY, min_run_words: int = MIN_RUN_WORDS) -> DataFrame:
    """One row per paragraph or chunk of a class of two or more: doc_id, paragraph (number among those of its text, then
    its chunks), start, end (code points), n_words, keeper_doc_id, keeper_paragraph (the class's first by doc_id and
    number), removed (not the first). Rows may overlap; a keeper that other rows cover has none of its own.

    Null texts and texts without words give no rows; a text repeated under several doc_ids repeats all its paragraphs;
    texts of any length are compared whole. doc_id is an integer that identifies a text: rows repeated under one doc_id
    count once, rows without one not at all. Columns but doc_id and text aren't read. An empty table gives no rows.
    """
    own = texts(docs).where("doc_id is not null")
    units = cut(_units(own))
    bands = [f"b{i}" for i in range(BANDS)]
    # paragraphs and chunks one after the other, and bands only as long as they are needed: less is on disk at once
    banded = cut(_different(units.where("not chunk"), bands).where("several or b0 is not null"))
    members = cut(_buckets(banded))
    exact = cut(banded.drop(*bands).union(_different(units.where("chunk"), []).where("several")))
    drop_cut(banded)
    near = members.select("fp").distinct().join(exact.drop("several"), "fp").groupBy("doc_id").agg(F.collect_list("paragraph").alias("numbers"))

    def shingled():
        def step(batch):
            p = Paragraphs(batch.column(1).to_pylist())
            wanted = batch.column(2)
            text = np.repeat(np.arange(len(wanted)), wanted.value_lengths().to_numpy())
            key = lambda d, n: (d << 40) + n
            chosen = np.flatnonzero(np.isin(key(p.doc, p.number), key(text, wanted.flatten().to_numpy())))
            count = p.count[chosen]
            row = np.repeat(np.arange(len(chosen)), count)
            value = signed(p.shingles)[np.repeat(p.first[chosen] - (np.cumsum(count) - count), count) + np.arange(len(row))]
            order = np.lexsort((value, row))
            row, value = row[order], value[order]
            new = np.concatenate([[True], (row[1:] != row[:-1]) | (value[1:] != value[:-1])]) if len(row) else np.zeros(0, bool)
            offsets = np.concatenate([[0], np.cumsum(np.bincount(row[new], minlength=len(chosen)))]).astype(np.int32)
            return [pa.array(p.fp[chosen]), pa.ListArray.from_arrays(pa.array(offsets), pa.array(value[new]))]

        return step

    schema = T.StructType([T.StructField("fp", T.LongType()), T.StructField("shingles", T.ArrayType(T.LongType()))])
    sets = cut(map_batches(own.join(near, "doc_id").select("doc_id", "text", "numbers"), shingled, schema, limit=STEP).dropDuplicates(["fp"]))
    edges = cut(_links(members, sets, similarity))
    for done in (members, sets):
        drop_cut(done)
    found = components(edges)
    named = exact.join(found, F.col("fp") == F.col("node"), "left").where("several or component is not null")
    named = named.select("fp", "doc_id", "paragraph", F.coalesce("component", "fp").alias("class"))
    heads = named.groupBy("class").agg(F.min(F.struct("doc_id", "paragraph")).alias("keeper"))
    of = named.join(heads, "class").select("fp", F.col("keeper.doc_id").alias("keeper_doc_id"), F.col("keeper.paragraph").alias("keeper_paragraph"))
    rows = units.drop("again", *bands).join(of, "fp")
    order = W.partitionBy("doc_id").orderBy("chunk", "paragraph")
    repeat = F.lag(F.struct("chunk", "paragraph")).over(order).eqNullSafe(F.struct("chunk", "paragraph"))
    rows = rows.withColumn("_run", F.when(~F.col("chunk"), F.col("paragraph") - F.dense_rank().over(order))).withColumn("_repeat", repeat).where(~F.col("_repeat"))
    run = rows.withColumn("_all", F.sum("n_words").over(W.partitionBy("doc_id", "_run"))).where(F.col("chunk") | (F.col("_all") >= min_run_words))
    # stretches that the paragraphs left cover without a gap; a chunk inside one says nothing new
    end = F.col("word") + F.col("n_words")
    order = W.partitionBy("doc_id").orderBy("word", "chunk")
    reach = F.max(F.when(~F.col("chunk"), end))
    both = run.withColumn("_reach", reach.over(order.rowsBetween(W.unboundedPreceding, -1)))
    both = both.withColumn("_stretch", F.sum(F.when(~F.col("chunk") & (F.col("_reach").isNull() | (F.col("word") > F.col("_reach"))), 1).otherwise(0)).over(order.rowsBetween(W.unboundedPreceding, 0)))
    both = both.withColumn("_reach", reach.over(W.partitionBy("doc_id", "_stretch")))
    removed = (F.col("doc_id") != F.col("keeper_doc_id")) | (F.col("paragraph") != F.col("keeper_paragraph"))
    left = both.where(~F.col("chunk") | F.col("_reach").isNull() | (F.col("_reach") < end))
    return left.select("doc_id", "paragraph", "start", "end", "n_words", "keeper_doc_id", "keeper_paragraph", removed.alias("removed"))


def op1_paragraph_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated(table(spark, sf_dir, "documents"))
