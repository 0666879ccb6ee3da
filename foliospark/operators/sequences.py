"""Orders, segments and selections over pages and documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import clean_line, words
from .roles import TOKEN, count_of

PAGE = ("doc_id", "page")
#: Words that narrative text has and labels lack; heads that open a section.
STOPWORDS = ("a", "an", "and", "are", "as", "at", "by", "for", "from", "in", "is", "of", "on", "or", "that", "the", "their", "this", "to", "using", "was", "were", "with")
SECTION_CUE = r"^(?i)(results|discussion|materials\s+and\s+methods|methods|introduction|conclusion|background|clinical\s+study|cadaveric\s+study)\b"


def _tokens(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(TOKEN), F.lit(0))


def coherence(rows: DataFrame, *keys: str) -> DataFrame:
    """keys, label of clusters of short texts: non_narrative_graphic, narrative or uncertain. All counts add up over rows,
    so they are aggregated before the exchange. Null and blank texts count for nothing."""
    t = clean_line(F.col("text"))
    w = _tokens(t)
    count = lambda test: F.size(F.filter(w, test))
    r = rows.select(*keys, (t != "").cast("int").alias("lines"), F.size(w).alias("n"), count(lambda x: F.length(x) <= 3).alias("short"), count(lambda x: x.rlike("^[0-9]")).alias("number"), count(lambda x: F.lower(x).isin(*STOPWORDS)).alias("stop"), count_of(t, "[.;:]").alias("marks"))
    a = r.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in ("lines", "n", "short", "number", "stop", "marks")))
    part = lambda c: F.col(c) / F.greatest(F.lit(1), F.col("n"))
    prose = (F.col("n") >= 10) & (part("stop") >= 0.12)
    label = F.when(F.col("n") == 0, "uncertain").when((part("stop") <= 0.2) & (((F.col("lines") >= 5) & (part("short") >= 0.5)) | (part("number") >= 0.25)), "non_narrative_graphic").when(prose & ((F.col("marks") >= 1) | (F.col("lines") <= 3)), "narrative").otherwise("uncertain")
    return a.select(*keys, label.alias("label"))


def coarse_seeds(blocks: DataFrame, most: int, cell: int = 800, scale: float = 1.0) -> DataFrame:
    """doc_id, page, block_id, seed_no: up to `most` blocks of a page by score; until half are found only the best of
    each grid cell, then any. Greedy in words, but a window in fact: the count of first-of-cell blocks up to a rank tells
    where the first half ends. Pages of at most `most` blocks keep scan order."""
    t = clean_line(F.col("text"))
    w = _tokens(t)
    alpha, number = F.size(F.filter(w, lambda x: x.rlike("[A-Za-z]"))), F.size(F.filter(w, lambda x: x.rlike("^[0-9]")))
    add = lambda test, v: F.when(test, v).otherwise(0)
    s = F.least(F.length(t), F.lit(160)) + add(t.rlike(r"^(?i)(fig(?:ure)?\.?|table)\b"), 120) + add(alpha >= 4, 60) + add(F.col("is_heading"), 40) + add(F.col("is_header_footer"), 20) - add(number >= F.greatest(F.lit(2), F.size(w) - 1), 80)
    x, y = (F.floor((F.col(a) + F.col(b)) / 2 * scale / cell) for a, b in (("x0", "x1"), ("y0", "y1")))
    page = W.partitionBy(*PAGE)
    b = blocks.select(*PAGE, "block_id", "ord", x.alias("cx"), y.alias("cy"), F.count("*").over(page).alias("n"), F.row_number().over(page.orderBy(s.desc(), alpha.desc(), F.length(t).desc(), "y0", "x0", "ord")).alias("rank"))
    b = b.withColumn("best", (F.row_number().over(W.partitionBy(*PAGE, "cx", "cy").orderBy("rank")) == 1).cast("int"))
    before = F.sum("best").over(page.orderBy("rank")) - F.col("best")
    b = b.withColumn("late", ((F.col("best") == 0) & (before < most // 2)).cast("int"))
    order = page.orderBy(F.when(F.col("n") <= most, F.struct(F.lit(0).alias("a"), F.col("ord").cast("long").alias("b"))).otherwise(F.struct(F.col("late").alias("a"), F.col("rank").cast("long").alias("b"))))
    return b.withColumn("seed_no", F.row_number().over(order)).where(F.col("seed_no") <= most).select(*PAGE, "block_id", "seed_no")


def input_packages(blocks: DataFrame, most: int | None = None, chars: int = 220) -> DataFrame:
    """What a page hook gets: the first `most` blocks by (column_guess, y0, x0), texts cut, and the page's totals."""
    page = W.partitionBy(*PAGE)
    b = blocks.select(*PAGE, "block_id", F.substring("text", 1, chars).alias("text"), F.row_number().over(page.orderBy("column_guess", "y0", "x0", "ord")).alias("pos"), F.count("*").over(page).alias("total_blocks"))
    return b if most is None else b.where(F.col("pos") <= most)


def column_order(paragraphs: DataFrame, two_column: DataFrame) -> DataFrame:
    """doc_id, para_id, bucket, pos: reading order by page, bucket, y0, x0. On pages in two_column(doc_id, page) wide
    blocks at the top come first (0) and at the bottom last (3), left before right (1, 2)."""
    page = W.partitionBy(*PAGE)
    left, right, top, bottom = F.min("x0").over(page), F.max("x1").over(page), F.min("y0").over(page), F.max("y1").over(page)
    w, h = F.greatest(F.lit(1e-6), right - left), F.greatest(F.lit(1e-6), bottom - top)
    x, y = ((F.col("x0") + F.col("x1")) / 2 - left) / w, ((F.col("y0") + F.col("y1")) / 2 - top) / h
    bucket = F.when(F.col("_two").isNull(), 0).when((F.col("x1") - F.col("x0")) / w >= 0.72, F.when(y <= 0.2, 0).when(y >= 0.82, 3).otherwise(2)).when(x < 0.5, 1).otherwise(2)
    p = paragraphs.join(two_column.select(*PAGE).distinct().withColumn("_two", F.lit(True)), [*PAGE], "left").withColumn("bucket", bucket)
    return p.select("doc_id", "para_id", "bucket", F.row_number().over(W.partitionBy("doc_id").orderBy("page", "bucket", "y0", "x0", "ord")).alias("pos"))


def heading_segments(roled: DataFrame) -> DataFrame:
    """doc_id, page, block_id, segment: every heading alone, the blocks between two headings together."""
    order = W.partitionBy(*PAGE).orderBy("reading_pos")
    head = F.col("role") == "Heading"
    cut = head | F.coalesce(F.lag(head).over(order), F.lit(True))
    r = roled.withColumn("_cut", cut.cast("int"))
    return r.select(*PAGE, "block_id", F.sum("_cut").over(order).alias("segment"))


def parents_of_sections(sections: DataFrame) -> DataFrame:
    """doc_id, section of numbered sections (`2.1 Methods`) that have a numbered descendant. Every number meets its own
    proper prefixes by equality, so no pair of sections is compared."""
    number = F.regexp_extract(clean_line(F.col("section")), r"^(\d+(?:\.\d+)*)\.?\s+[A-Za-z]", 1)
    s = sections.select("doc_id", "section", number.alias("number")).where("number <> ''").distinct()
    parts = F.split("number", r"\.")
    up = s.where(F.size(parts) > 1).select("doc_id", F.explode(F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda i: F.array_join(F.slice(parts, 1, i), "."))).alias("number"))
    return s.join(up.distinct(), ["doc_id", "number"], "left_semi").select("doc_id", "section")


def regrouping_hints(groups: DataFrame, hints: DataFrame) -> DataFrame:
    """doc_id, hint_no, block_ids: hints(doc_id, hint_ord, block_ids) of two or more blocks, none of them in
    groups(doc_id, block_id) or in an earlier accepted hint; numbered from 0 as accepted."""
    h = hints.withColumn("block_ids", F.array_distinct(F.filter("block_ids", lambda x: F.trim(x) != ""))).where(F.size("block_ids") >= 2)
    taken = h.select("doc_id", "hint_ord", F.explode("block_ids").alias("block_id")).join(groups.select("doc_id", "block_id"), ["doc_id", "block_id"], "left_semi")
    free = h.join(taken, ["doc_id", "hint_ord"], "left_anti")
    ordered = F.array_sort(F.collect_list(F.struct("hint_ord", "block_ids")))
    none = F.struct(F.array().cast("array<string>").alias("seen"), F.array().cast("array<array<string>>").alias("kept"))
    fold = lambda a, x: F.when(F.arrays_overlap(a["seen"], x["block_ids"]), a).otherwise(F.struct(F.concat(a["seen"], x["block_ids"]).alias("seen"), F.concat(a["kept"], F.array(x["block_ids"])).alias("kept")))
    kept = free.groupBy("doc_id").agg(ordered.alias("hs")).select("doc_id", F.aggregate("hs", none, fold)["kept"].alias("kept"))
    return kept.select("doc_id", F.posexplode("kept").alias("hint_no", "block_ids"))


def leading_fragments(paragraphs: DataFrame) -> DataFrame:
    """doc_id, ord of the paragraphs to drop from a document's head, three at most and never the last: a short
    continuation (lower-case start, a sentence end or a figure hook) before a fresh paragraph much longer than it, at a
    place where columns or pages turn. A fresh paragraph never begins in lower case, so nothing is merged and the
    verdicts of neighbours are enough."""
    page, doc = W.partitionBy(*PAGE), W.partitionBy("doc_id").orderBy("ord")
    left, right, top, bottom = F.min("x0").over(page), F.max("x1").over(page), F.min("y0").over(page), F.max("y1").over(page)
    w, h = F.greatest(F.lit(1e-6), right - left), F.greatest(F.lit(1e-6), bottom - top)
    t = clean_line(F.col("text"))
    v, n = words(t), F.size(words(t))
    fresh = F.regexp_extract(t, "[A-Za-z0-9]", 0).rlike("[A-Z0-9]")
    hook = F.lower(F.get(v, F.lit(1))).startswith("(fig") | F.contains(F.substring(F.lower(t), 1, 30), F.lit("(fig"))
    orphan = n.between(3, 45) & F.get(v, F.lit(0)).rlike("^[a-z]{1,5}$") & (hook | t.rlike("[.!?]"))
    p = paragraphs.select("doc_id", "ord", "page", n.alias("n"), fresh.alias("fresh"), t.rlike(SECTION_CUE).alias("cue"), orphan.alias("orphan"), (((F.col("x0") + F.col("x1")) / 2 - left) / w).alias("x"), (((F.col("y0") + F.col("y1")) / 2 - top) / h).alias("y"), ((F.col("y0") - top) / h).alias("up"))
    nxt = {c: F.lead(c).over(doc) for c in ("n", "fresh", "cue", "page", "x", "y", "up")}
    same, x, y = F.col("page") == nxt["page"], F.col("x"), F.col("y")
    down = same & (nxt["y"] > y)
    turn = ((y <= 0.42) & ((x >= 0.52) | (~same & (nxt["page"] >= F.col("page"))) | (down & (F.abs(x - nxt["x"]) <= 0.22)))) | (down & (x >= 0.52) & (nxt["x"] >= 0.45)) | (same & (x >= 0.62) & (nxt["x"] <= 0.45) & (F.abs(F.col("up") - nxt["up"]) <= 0.06) & (nxt["cue"] | nxt["fresh"]))
    drop = F.coalesce(F.col("orphan") & nxt["fresh"] & (nxt["n"] >= F.greatest(F.lit(12), F.floor(F.col("n") * 1.5))) & turn, F.lit(False))
    p = p.select("doc_id", "ord", drop.alias("drop"), F.row_number().over(doc).alias("pos"))
    return p.where("pos <= 3").select("doc_id", "ord", F.min("drop").over(W.partitionBy("doc_id").orderBy("pos")).alias("drop")).where("drop").select("doc_id", "ord")


def chunk_lines(lines: DataFrame) -> DataFrame:
    """doc_id, page, chunk, first_ord, n_lines, n_words, text: lines(doc_id, page, ord, x0, y0, x1, y1, text) of a page cut into
    paragraphs at wide gaps, numbered items, column jumps, after 180 words, or after 120 where a sentence ends. The word
    count restarts with each chunk, so this is a fold in order over sorted partitions that holds one chunk at a time."""
    import pyarrow as pa

    names = ["doc_id", "page", "chunk", "first_ord", "n_lines", "n_words", "text"]

    def fold(batches):
        import re

        item, at, now, prev = re.compile(r"\s*\d+[).]"), None, None, None
        for batch in batches:
            out = []
            for doc, page, order, x0, y0, y1, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                t = (text or "").strip()
                n, new_page = len(t.split()), at != (doc, page)
                if not new_page:
                    px, py0, py1, pt, pn = prev
                    starts = t[:1].isupper() or t[:1].isdigit()
                    cut = now[5] >= 180 or (now[5] >= 120 and starts and pt.endswith((".", "?", "!", ":", ";"))) or y0 - py1 > 0.9 * max(1.0, py1 - py0)
                    cut = cut or bool(item.match(t) and (now[4] >= 2 or pn > 10)) or (y0 <= py0 and abs(x0 - px) > 80)
                if new_page or cut:
                    if now is not None:
                        out.append([*now[:6], " ".join(now[6])])
                    now = [doc, page, 1 if new_page else now[2] + 1, order, 0, 0, []]
                now[4], now[5] = now[4] + 1, now[5] + n
                now[6].append(t)
                at, prev = (doc, page), (x0, y0, y1, t, n)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names)
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in [*now[:6], " ".join(now[6])]], names)

    rows = lines.select(F.col("doc_id").cast("long"), F.col("page").cast("long"), F.col("ord").cast("long"), *(F.col(c).cast("double") for c in ("x0", "y0", "y1")), "text")
    return rows.repartition("doc_id", "page").sortWithinPartitions("doc_id", "page", "ord").mapInArrow(fold, "doc_id long, page long, chunk long, first_ord long, n_lines long, n_words long, text string")


def source_mix(merged: DataFrame) -> DataFrame:
    """provider, kind, n: how many sources of merged references each provider and each kind gave (two grouping sets)."""
    r = merged.select(F.coalesce("provider", F.lit("unknown")).alias("provider"), F.coalesce("kind", F.lit("api")).alias("kind"))
    return r.groupingSets([[F.col("provider")], [F.col("kind")]], "provider", "kind").agg(F.count("*").alias("n"))


def structure_flags(roled: DataFrame, metrics: DataFrame) -> DataFrame:
    """Document flags: roles of a page came from the fallback and hold a bibliography or captions; unstable sections."""
    some = lambda test: F.coalesce(F.bool_or(F.coalesce(F.col("fallback_used"), F.lit(False)) & test), F.lit(False))
    f = roled.groupBy("doc_id").agg(some(F.col("role") == "ReferenceList").alias("reference_region_ambiguous"), some(F.col("role").isin("FigureCaption", "TableCaption")).alias("caption_linking_partial"))
    return f.join(metrics.select("doc_id", "section_boundary_unstable"), "doc_id", "left").select("doc_id", "reference_region_ambiguous", "caption_linking_partial", F.coalesce("section_boundary_unstable", F.lit(False)).alias("section_boundary_unstable"))
