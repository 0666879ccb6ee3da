"""Page layout over blocks(doc_id, block_id, ord, page, x0, y0, x1, y1, text, font_size, is_bold, font, column_guess).

Everything is partitioned by (doc_id, page), so one exchange serves a page's windows; ord is the scan order and
breaks every tie.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.geometry import inside, overlap, x_overlap_ratio

#: The patterns of captions and of noise. For roles a word boundary must follow `fig.`, so `Fig. 3` is none.
CAPTION = r"^(?i)\s*(figure|fig\.|table)\b"
NOISE = r"^(?i)(orcid\s*:?\s*\d{4}-\d{4}-\d{4}-\d{3}[0-9x]|\s*\d+\s*$|www\.|https?://|[\w.-]+@[\w.-]+\.\w+$|(19|20)\d{2}\s*(vol\.|volume)?\s*\d+)"
#: The same with a year of four digits; NOISE, as the reference, also takes longer numbers that open with 19 or 20 and text after them.
NOISE_OF_YEARS = NOISE.replace(r"(19|20)\d{2}", r"(19|20)\d{2}(?!\d)")
NUMBERED_CAPTION = r"^(?i)(figure|fig\.|table)\s*\d+|^(图|表)\s*\d+|^(?i)(fig\.?|table|chart|diagram)\s*[a-z]?\d+"
PAGE = ("doc_id", "page")


def flags(blocks: DataFrame, width: float = 595.0, height: float = 791.0) -> DataFrame:
    """is_heading, is_header_footer, column: larger than 1.1 times the document's mean size, short and bold; in the
    outer tenths of the page and short; left or right half."""
    mean = F.coalesce(F.avg(F.when(F.col("font_size") > 0, F.col("font_size"))).over(W.partitionBy("doc_id")), F.lit(12.0))
    n = F.length("text")
    return blocks.select("doc_id", "block_id", ((F.col("font_size") > 1.1 * mean) & (n < 150) & F.col("is_bold")).alias("is_heading"), (((F.col("y0") < 0.1 * height) | (F.col("y1") > 0.9 * height)) & (n < 100)).alias("is_header_footer"), F.when((F.col("x0") + F.col("x1")) / 2 < width / 2, 1).otherwise(2).alias("column"))


def classify(blocks: DataFrame, width: float = 595.0, height: float = 791.0, noise: str = NOISE) -> DataFrame:
    """category and confidence of each block by the first rule that holds; noise: the pattern of texts that are none."""
    t = F.trim(F.coalesce("text", F.lit("")))
    rules = (
        (t == "", "noise", 0.9),
        (t.rlike(noise), "noise", 0.85),
        (t.rlike(NUMBERED_CAPTION), F.when(F.lower(t).rlike("^(table|表)"), "table").otherwise("figure"), 0.8),
        (((F.col("y1") / height < 0.1) | (F.col("y0") / height > 0.9)) & (F.length(t) < 50), "header_footer", 0.7),
        (((F.col("x1") / width < 0.2) | (F.col("x0") / width > 0.8)) & (F.length(t) < 100), "sidebar", 0.6),
    )
    first = F.lit(None)
    for test, name, sure in reversed(rules):
        first = F.when(test, F.struct((F.lit(name) if isinstance(name, str) else name).alias("category"), F.lit(sure).alias("confidence"))).otherwise(first if first is not None else None)
    out = F.coalesce(first, F.struct(F.lit("content").alias("category"), F.lit(0.7).alias("confidence")))
    return blocks.select("doc_id", "block_id", out.alias("_r")).select("doc_id", "block_id", "_r.*")


def fallback_roles(blocks: DataFrame) -> DataFrame:
    """role of each block without a model, and its place in the page by (column, y0, x0)."""
    t = F.trim("text")
    role = F.when(t.rlike(CAPTION), F.when(F.lower(t).startswith("fig"), "FigureCaption").otherwise("TableCaption")).when(F.col("is_heading"), "Heading").when(F.col("is_header_footer"), "HeaderFooter").when(t.rlike(r"^\d+\.\s+|^\[[\d,-]+\]") & (F.length(t) > 50), "ReferenceList").otherwise("Body")
    order = W.partitionBy(*PAGE).orderBy("column_guess", "y0", "x0", "ord")
    return blocks.select(*blocks.columns, role.alias("role"), F.row_number().over(order).alias("reading_pos"))


def merge_groups(roled: DataFrame, gap: float = 20.0) -> DataFrame:
    """doc_id, page, group_no, block_id: runs of at least two Body blocks of one column, at most `gap` apart."""
    order = W.partitionBy(*PAGE).orderBy("column_guess", "y0", "ord")
    d = F.col("y0") - F.lag("y1").over(order)
    joined = (F.lag("role").over(order) == "Body") & (F.col("role") == "Body") & (F.lag("column_guess").over(order) == F.col("column_guess")) & d.between(0, gap)
    run = F.sum(F.when(F.coalesce(joined, F.lit(False)), 0).otherwise(1)).over(order)
    runs = roled.withColumn("run", run).withColumn("n", F.count("*").over(W.partitionBy(*PAGE, "run"))).where("n > 1")
    return runs.withColumn("group_no", F.dense_rank().over(W.partitionBy(*PAGE).orderBy("run")) - 1).select("doc_id", "page", "group_no", "block_id")


def paragraph_islands(blocks: DataFrame, gap: float = 6.0) -> DataFrame:
    """doc_id, page, island, block_id: neighbouring blocks of one paragraph. Empty blocks and captions end a run;
    a run needs one column, left edges within 3 points, a gap of at most max(12, 2.5 * line gap), like fonts and an
    x overlap of 0.85; runs of one are left out."""
    order = W.partitionBy(*PAGE).orderBy("y0", "x0", "ord")
    out = (F.trim("text") == "") | F.trim("text").rlike(NUMBERED_CAPTION)
    lag = lambda c: F.lag(c).over(order)
    marked = blocks.withColumn("out", out)
    joins = ~lag("out") & (lag("column_guess") == F.col("column_guess")) & (F.abs(lag("x0") - F.col("x0")) <= 3) & (F.col("y0") - lag("y1")).between(0, max(12.0, 2.5 * gap)) & (F.abs(lag("font_size") - F.col("font_size")) <= 0.6) & (lag("font") == F.col("font")) & (x_overlap_ratio(lag("x0"), lag("x1"), F.col("x0"), F.col("x1")) >= 0.85)
    run = F.sum(F.when(F.coalesce(joins, F.lit(False)) & ~F.col("out"), 0).otherwise(1)).over(order)
    runs = marked.withColumn("run", run).where(~F.col("out")).withColumn("n", F.count("*").over(W.partitionBy(*PAGE, "run"))).where("n > 1")
    return runs.withColumn("island", F.dense_rank().over(W.partitionBy(*PAGE).orderBy("run"))).select("doc_id", "page", "island", "block_id")


def font_profile(blocks: DataFrame) -> DataFrame:
    """Per document and kind (caption, heading, body): count, median size, share of bold, the commonest font (ties:
    the one seen first)."""
    kind = F.when(F.trim("text").rlike(NUMBERED_CAPTION), "caption").when(F.col("is_bold") & (F.length("text") <= 180), "heading").otherwise("body")
    full = blocks.where(F.trim("text") != "").withColumn("kind", kind)
    fonts = full.groupBy("doc_id", "kind", "font").agg(F.count("*").alias("n"), F.min("ord").alias("o")).groupBy("doc_id", "kind").agg(F.max_by("font", F.struct("n", -F.col("o"))).alias("dominant_font"))
    base = full.groupBy("doc_id", "kind").agg(F.count("*").alias("n_blocks"), F.median("font_size").alias("median_size"), F.round(F.avg(F.col("is_bold").cast("int")), 3).alias("bold_ratio"))
    return base.join(fonts, ["doc_id", "kind"])


def columns_of_pages(blocks: DataFrame, width: float = 595.0) -> DataFrame:
    """doc_id, page, columns, confidence from the shares of blocks left of .35, between and right of .65; and the
    document's vote (the commonest count; ties: the earliest page's)."""
    x = (F.col("x0") + F.col("x1")) / 2 / width
    share = lambda t: F.avg(F.when(t, 1.0).otherwise(0.0))
    s = blocks.groupBy(*PAGE).agg(share(x < 0.35).alias("l"), share(x.between(0.35, 0.65)).alias("m"), share(x > 0.65).alias("r"))
    two = (F.col("l") > 0.2) & (F.col("r") > 0.2) & (F.col("m") < 0.3)
    three = (F.col("l") > 0.15) & (F.col("m") > 0.15) & (F.col("r") > 0.15)
    pick = lambda a, b, c, d, e: F.when(F.col("m") > 0.6, a).when(two, b).when(three, c).when((F.col("l") > 0) & (F.col("r") > 0), d).otherwise(e)
    pages = s.select(*PAGE, pick(1, 2, 3, 2, 1).alias("columns"), pick(0.8, 0.85, 0.7, 0.6, 0.5).alias("confidence"))
    votes = pages.groupBy("doc_id", "columns").agg(F.count("*").alias("n"), F.min("page").alias("p")).groupBy("doc_id").agg(F.max_by("columns", F.struct("n", -F.col("p"))).alias("column_mode"))
    return pages.join(votes, "doc_id")


def page_bounds(blocks: DataFrame) -> DataFrame:
    return blocks.groupBy(*PAGE).agg(F.min("x0").alias("bx0"), F.min("y0").alias("by0"), F.max("x1").alias("bx1"), F.max("y1").alias("by1"))


def layout_mode(blocks: DataFrame, dense: int = 90, denser: int = 80) -> DataFrame:
    """hierarchical for pages of very many short blocks, else direct."""
    n = F.length(F.trim("text"))
    s = blocks.groupBy(*PAGE).agg(F.count("*").alias("n"), F.avg(n).alias("avg_len"), F.avg(F.when(n <= 24, 1.0).otherwise(0.0)).alias("short"), F.avg(F.when((F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0")) <= 3500.0, 1.0).otherwise(0.0)).alias("small"))
    many = ((F.col("n") >= dense) & (F.col("avg_len") <= 40) & (F.col("short") >= 0.6)) | ((F.col("n") >= denser) & (F.col("avg_len") <= 45) & ((F.col("short") >= 0.55) | (F.col("small") >= 0.45)))
    return s.select(*PAGE, "n", F.when(many, "hierarchical").otherwise("direct").alias("mode"))


def project_regions(blocks: DataFrame, regions: DataFrame, least: float = 0.05) -> DataFrame:
    """doc_id, block_id, region_id, class_rank: the region that holds a block's centre (first class first), else the one
    with the largest overlap of at least `least` of the block. regions: doc_id, page, region_id, class_rank, rx0..ry1."""
    area = (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))
    share = overlap(F.col("x0"), F.col("x1"), F.col("rx0"), F.col("rx1")) * overlap(F.col("y0"), F.col("y1"), F.col("ry0"), F.col("ry1")) / F.greatest(F.lit(1.0), area)
    centre = inside((F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2, F.col("rx0"), F.col("ry0"), F.col("rx1"), F.col("ry1"))
    both = blocks.join(regions, list(PAGE)).withColumn("hit", centre).withColumn("share", share).where(centre | (share >= least))
    key = F.struct(F.when(F.col("hit"), 0).otherwise(1), F.when(F.col("hit"), F.lit(0.0)).otherwise(-F.col("share")), "class_rank", "region_id")
    return both.groupBy("doc_id", "block_id").agg(F.min_by(F.struct("region_id", "class_rank"), key).alias("_r")).select("doc_id", "block_id", "_r.*")


def column_flips(blocks: DataFrame) -> DataFrame:
    """Changes of page half from one block to the next in scan order, and per 1000 words, for each document."""
    order = W.partitionBy("doc_id").orderBy("page", "ord")
    bounds = page_bounds(blocks)
    x = ((F.col("x0") + F.col("x1")) / 2 - F.col("bx0")) / F.greatest(F.lit(1e-6), F.col("bx1") - F.col("bx0"))
    side = blocks.where(F.trim("text") != "").join(bounds, list(PAGE)).withColumn("right", x >= 0.5)
    flip = (F.lag("page").over(order) == F.col("page")) & (F.lag("right").over(order) != F.col("right"))
    n = F.size(F.array_remove(F.split(F.trim("text"), r"\s+"), ""))
    return side.withColumn("flip", F.coalesce(flip.cast("int"), F.lit(0))).groupBy("doc_id").agg(F.sum("flip").alias("flips"), F.sum(n).alias("tokens")).withColumn("flips_per_1000", F.when(F.col("tokens") > 0, F.round(F.col("flips") * 1000.0 / F.col("tokens"), 6)).otherwise(0.0))


def moving_average(series: DataFrame, key: str, order: str, value: str, k: int) -> DataFrame:
    """Mean of the last k values, fewer at the head."""
    w = W.partitionBy(key).orderBy(order).rowsBetween(-(k - 1), 0)
    return series.withColumn("moving_average", F.round(F.avg(value).over(w), 6))
