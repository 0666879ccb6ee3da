"""Blocks, the pieces they are split into, and the paragraphs they are gathered in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import clean_line

#: Sections and clean roles that keep a paragraph out of the narrative, and those that fit in.
EXCLUDED_SECTIONS = ("authors", "affiliations", "document metadata", "references", "figures and tables")
NON_NARRATIVE = ("nuisance", "reference_entry", "figure_caption", "table_caption")
COMPATIBLE = ("body_text", "section_heading", "main_title")


def block_roles(blocks: DataFrame, roles: DataFrame, default: str = "Body") -> DataFrame:
    """blocks with the role that roles (doc_id, block_id, role) gives, or the default."""
    return blocks.drop("role").join(roles.select("doc_id", "block_id", "role"), ["doc_id", "block_id"], "left").withColumn("role", F.coalesce("role", F.lit(default)))


def paragraph_roles(sources: DataFrame, roles: DataFrame) -> DataFrame:
    """doc_id, para_id, roles: the clean roles of a paragraph's blocks, sorted. sources: doc_id, para_id, block_id, a row
    for each block of a paragraph. Paragraphs whose blocks have no role get an empty array."""
    both = sources.join(roles.select("doc_id", "block_id", F.col("role").alias("_role")), ["doc_id", "block_id"], "left")
    return both.groupBy("doc_id", "para_id").agg(F.array_sort(F.collect_set("_role")).alias("roles"))


def narrative_candidates(paragraphs: DataFrame, roles: DataFrame) -> DataFrame:
    """paragraphs (doc_id, para_id, role, section_path array) with `narrative`: a body paragraph outside the excluded
    sections whose clean roles hold none that keeps it out and, if there are any, one that fits in."""
    path = F.transform(F.coalesce("section_path", F.array().cast("array<string>")), lambda s: F.lower(clean_line(s)))
    known = F.coalesce("roles", F.array().cast("array<string>"))
    any_of = lambda a, values: F.arrays_overlap(a, F.array(*map(F.lit, values)))
    fits = ~any_of(known, NON_NARRATIVE) & ((F.size(known) == 0) | any_of(known, COMPATIBLE))
    both = paragraphs.join(roles, ["doc_id", "para_id"], "left")
    return both.withColumn("narrative", (F.col("role") == "Body") & ~any_of(path, EXCLUDED_SECTIONS) & fits).drop("roles")


def caption_overlaps(sources: DataFrame, captions: tuple[str, ...] = ("FigureCaption", "TableCaption")) -> DataFrame:
    """doc_id, para_id of the paragraphs that share a block of their page with a caption. sources: doc_id, page, para_id,
    role, block_id."""
    held = sources.where(F.col("role").isin(*captions)).select("doc_id", "page", "block_id").distinct()
    return sources.where(~F.col("role").isin(*captions)).join(held, ["doc_id", "page", "block_id"], "left_semi").select("doc_id", "para_id").distinct()


def split_lines(blocks: DataFrame, starts: Column, text: str = "text") -> DataFrame:
    """Blocks cut before the lines that `starts` (an expression over a column `line`) picks: the columns of blocks, with
    text the piece's lines joined by blanks, block_id `<block>__s<k>` where there are several, source_block_id, first_line
    and last_line (from 0). Blank lines go; blocks without text stay whole."""
    lines = blocks.select("*", F.posexplode_outer(F.split(F.coalesce(F.col(text), F.lit("")), "\n")).alias("line_no", "_raw")).withColumn("line", clean_line(F.col("_raw")))
    own = W.partitionBy("doc_id", "block_id").orderBy("line_no")
    kept = lines.where((F.col("line") != "") | (F.trim(F.coalesce(text, F.lit(""))) == ""))
    cut = F.sum(F.when((F.row_number().over(own) > 1) & starts, 1).otherwise(0)).over(own)
    rest = [c for c in blocks.columns if c not in ("doc_id", "block_id", text)]
    pieces = kept.withColumn("_k", cut).groupBy("doc_id", "block_id", "_k").agg(*[F.first(c).alias(c) for c in rest], F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("_l"), F.min("line_no").alias("first_line"), F.max("line_no").alias("last_line"))
    many = F.max("_k").over(W.partitionBy("doc_id", "block_id")) > 0
    name = F.when(many, F.concat("block_id", F.lit("__s"), F.col("_k").cast("string"))).otherwise(F.col("block_id"))
    return pieces.select("doc_id", name.alias("block_id"), F.col("block_id").alias("source_block_id"), "first_line", "last_line", F.array_join(F.transform("_l", lambda x: x["line"]), " ").alias(text), *rest)


def expand_order(order: DataFrame, lineage: DataFrame) -> DataFrame:
    """order (doc_id, pos, block_id) over split blocks brought back to source blocks: doc_id, pos (from 1), block_id, each
    where its first piece stands. lineage: doc_id, block_id, source_block_id, k (place among its pieces); blocks
    without a row stand for themselves."""
    both = order.join(lineage, ["doc_id", "block_id"], "left").select("doc_id", "pos", F.coalesce("k", F.lit(0)).alias("k"), F.coalesce("source_block_id", "block_id").alias("block_id"))
    first = both.groupBy("doc_id", "block_id").agg(F.min(F.struct("pos", "k")).alias("at"))
    return first.select("doc_id", F.row_number().over(W.partitionBy("doc_id").orderBy("at", "block_id")).alias("pos"), "block_id")


def gathered(blocks: DataFrame, groups: DataFrame) -> DataFrame:
    """Paragraphs of merge groups and of the blocks in none: doc_id, para_id, page, block_ids, text (pieces in the
    group's order joined by blanks), x0, y0, x1, y1. groups: doc_id, group_id, pos, block_id; a group's missing blocks
    are passed over."""
    named = groups.join(blocks, ["doc_id", "block_id"]).select("doc_id", F.col("group_id").alias("para_id"), "pos", "block_id", "page", "text", "x0", "y0", "x1", "y1")
    alone = blocks.join(groups.select("doc_id", "block_id").distinct(), ["doc_id", "block_id"], "left_anti")
    alone = alone.select("doc_id", F.concat(F.lit("para_"), F.col("block_id")).alias("para_id"), F.lit(0).alias("pos"), "block_id", "page", "text", "x0", "y0", "x1", "y1")
    part = F.array_sort(F.collect_list(F.struct("pos", "block_id", F.trim(F.coalesce("text", F.lit(""))).alias("text"))))
    rows = named.unionByName(alone).groupBy("doc_id", "para_id").agg(F.min("page").alias("page"), part.alias("_p"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))
    text = F.array_join(F.filter(F.transform("_p", lambda x: x["text"]), lambda x: x != ""), " ")
    return rows.select("doc_id", "para_id", "page", F.array_join(F.transform("_p", lambda x: x["block_id"]), ",").alias("block_ids"), text.alias("text"), "x0", "y0", "x1", "y1")


def two_column_pages(paragraphs: DataFrame) -> DataFrame:
    """doc_id, page of pages whose paragraphs stand left and right: of those narrower than .75 of the page's extent and
    below its top .15, four at least, two at least have their centre left of .4 and two right of .6, and no more than
    .3 of them lie between."""
    own = W.partitionBy("doc_id", "page")
    low, high, top, bottom = F.min("x0").over(own), F.max("x1").over(own), F.min("y0").over(own), F.max("y1").over(own)
    p = paragraphs.select("doc_id", "page", "x0", "x1", "y0", low.alias("l"), (high - low).alias("w"), top.alias("t"), (bottom - top).alias("h")).where("w > 0")
    p = p.where((F.col("x1") - F.col("x0") < 0.75 * F.col("w")) & (F.col("y0") - F.col("t") >= 0.15 * F.greatest(F.col("h"), F.lit(1.0))))
    at = ((F.col("x0") + F.col("x1")) / 2 - F.col("l")) / F.col("w")
    n = p.groupBy("doc_id", "page").agg(F.count("*").alias("n"), F.count_if(at < 0.4).alias("left"), F.count_if(at > 0.6).alias("right"))
    return n.where((F.col("n") >= 4) & (F.col("left") >= 2) & (F.col("right") >= 2) & (F.col("n") - F.col("left") - F.col("right") <= 0.3 * F.col("n"))).select("doc_id", "page")


def review_candidates(blocks: DataFrame, most: int) -> DataFrame:
    """The `most` blocks of a page whose headings inside should be looked at: doc_id, page, block_id, rank. blocks: role,
    is_header_footer, text, pos (reading order), headings (found inside). Headings come first, then where the first
    heading stands, then the number of them; a heading of under 80 characters or 8 words is none to look at."""
    t = clean_line(F.col("text"))
    heading = F.col("role") == "Heading"
    b = blocks.where(F.col("role").isin("Body", "Heading") & ~F.col("is_header_footer") & (F.size("headings") > 0))
    b = b.where(~heading | ((F.length(t) >= 80) & (F.size(F.split(t, " ")) >= 8)))
    at = F.greatest(F.lit(0), F.position(F.lower(F.col("headings")[0]), F.lower(t)) - 1)
    return b.withColumn("_at", at).withColumn("rank", F.row_number().over(W.partitionBy("doc_id", "page").orderBy(F.when(heading, 0).otherwise(1), "_at", F.desc(F.size("headings")), "pos"))).where(F.col("rank") <= most).select("doc_id", "page", "block_id", "rank")


def low_confidence_pages(pages: DataFrame, below: float = 0.7, most: int = 10) -> DataFrame:
    """The first `most` pages of each document whose layout is unsure and not verified: pages (doc_id, page, confidence,
    verified). A missing confidence counts as .5."""
    unsure = pages.where((F.coalesce("confidence", F.lit(0.5)) < below) & ~F.coalesce("verified", F.lit(False)))
    return unsure.withColumn("_n", F.row_number().over(W.partitionBy("doc_id").orderBy("page"))).where(F.col("_n") <= most).drop("_n")


def violations(observed: DataFrame, rules: DataFrame) -> DataFrame:
    """doc_id, artifact, key, violation. rules: artifact, key, type, required. observed: doc_id, artifact, key, type, value
    (a row for each key there). Required keys that are absent, keys of another type, and doc_id values that differ from
    their document."""
    docs = observed.select("doc_id").distinct()
    # the rules are a short constant list
    wanted = docs.join(F.broadcast(rules.where("required").select("artifact", "key")))
    absent = wanted.join(observed.select("doc_id", "artifact", "key"), ["doc_id", "artifact", "key"], "left_anti").withColumn("violation", F.lit("missing_required"))
    wrong = observed.join(F.broadcast(rules.select("artifact", "key", F.col("type").alias("_type"))), ["artifact", "key"]).where("type <> _type").select("doc_id", "artifact", "key", F.concat(F.lit("type_"), F.col("type"), F.lit("_not_"), F.col("_type")).alias("violation"))
    other = observed.where((F.col("key") == "doc_id") & ~F.col("value").eqNullSafe(F.col("doc_id").cast("string"))).select("doc_id", "artifact", "key", F.lit("doc_id_differs").alias("violation"))
    return absent.unionByName(wrong).unionByName(other)


def union_of_logs(*logs: DataFrame) -> DataFrame:
    """Event logs one after another; columns that one lacks are null."""
    out = logs[0]
    for log in logs[1:]:
        out = out.unionByName(log, allowMissingColumns=True)
    return out
