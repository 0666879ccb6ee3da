"""Clean roles of blocks and text tests behind them; JVM-side, one pass over (doc_id, page) windows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import clean_line, has_digit, starts_upper, words

#: Tokens, words that name an affiliation, words that name a journal, words no author name has.
TOKEN = r"[A-Za-z]+(?:[-'][A-Za-z]+)?|\d+(?:\.\d+)?"
NUMBER = r"\b\d+(?:\.\d+)?\b"
AFFILIATION = ("department", "university", "hospital", "institute", "school of", "faculty of", "medical center", "address", "division of")
JOURNAL = ("issn", "copyright", "vol", "volume", "issue", "pp.", "pages")
NO_AUTHOR = ("department", "university", "hospital", "institute", "address", "doi")
GRAPHIC = ("p-value", "log10", "log2", "fold change")
REGION_CAPTION = "CaptionRegion"
#: What a bibliography entry shows.
YEAR = r"\b(?:19|20)\d{2}\b"
IDENTIFIER = r"(?i)\b10\.\d{4,}(?:\.\d+)*/[^\s\]>\"']+\b|\b\d{7,9}\b|http"
AUTHOR = r"\b[A-Z][a-zA-Z'`-]+,\s*(?:[A-Z]\.){1,3}|(?i:et al)"
JOURNAL_HINT = r"(?i)\b(?:BMJ|Arthroscopy|Radiology|Nature|Clin\.|Orthop\.|AJR|Am\.\s*J\.|J\.)\b"
NUMBERED = r"^\s*(?:\[\d+\]|\d+[.)])\s+"
MARKERS = r"\[\d{1,3}\]|(?:^|\s)\d{1,3}[.)]"


def contains_any(c: Column, parts) -> Column:
    return reduce(lambda a, b: a | b, (F.contains(c, F.lit(p)) for p in parts))


def hits(c: Column, parts) -> Column:
    """How many of the parts occur."""
    return reduce(lambda a, b: a + b, (F.contains(c, F.lit(p)).cast("int") for p in parts))


def count_of(c: Column, pattern: str) -> Column:
    return F.regexp_count(c, F.lit(pattern))


def share(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, F.lit(0.0)).otherwise(part / whole)


def title_share(w: Column) -> Column:
    alpha = F.filter(w, lambda x: x.rlike(r"\p{L}"))
    return share(F.size(F.filter(alpha, starts_upper)), F.size(alpha))


def lower_share(w: Column) -> Column:
    return share(F.size(F.filter(w, lambda x: x.rlike(r"^\p{Ll}"))), F.size(w))


def is_compact_label(c: Column) -> Column:
    """Short axis or legend labels: at most 72 characters and 9 tokens, mostly short, with capitals or a marker of graphics."""
    t = clean_line(c)
    w = F.regexp_extract_all(t, F.lit(TOKEN), F.lit(0))
    n, marked = F.size(w), contains_any(F.lower(t), GRAPHIC)
    short = F.size(F.filter(w, lambda x: F.length(x) <= 4))
    upper = F.size(F.filter(w, lambda x: x.rlike("^(?=.*[A-Z].*)[^a-z]{2,}$")))
    lower = F.size(F.filter(w, lambda x: x.rlike("^[a-z]")))
    return F.length(t).between(1, 72) & n.between(1, 9) & (marked | (lower <= F.greatest(F.lit(1), F.floor(n / 3)))) & (short >= F.greatest(F.lit(2), F.floor(n / 2))) & ((upper >= 1) | marked)


def is_boxed_sidebar(c: Column, size: Column, bold: Column, n: Column, lower: Column) -> Column:
    """Small print of boxes: bullets, classification heads, labels of patient tables; n words, a share `lower` of them in
    lower case."""
    low = F.lower(c)
    rules = (
        (count_of(c, "[•▪■◦]") >= 4) & (n <= 72) & (lower <= 0.55),
        F.contains(low, F.lit("classification")) & (n <= 14) & bold & (lower <= 0.72),
        low.rlike(r"\b(?:work compensation|risk factors?|demographics|tear characteristics)\b") & (n <= 6) & bold,
        F.contains(c, F.lit("•")) & F.contains(c, F.lit(":")) & (n <= 48) & (lower <= 0.5),
    )
    return (n > 0) & (size <= 8.5) & ~c.rlike(r"[.!?]\s*$") & reduce(lambda a, b: a | b, rules)


def caption_kind(c: Column) -> Column:
    """figure_caption or table_caption where a numbered label opens the text or follows a few words of it, else null;
    of three or more words with letters; sub-panels (`Fig. 2a.`) open none."""
    t = clean_line(c)
    label = r"(?i)\b(fig(?:ure)?|table)\s*\.?\s*\d+[a-z]?\b"
    panel = r"^(?i)fig(?:ure)?\s*\.?\s*\d+[a-z](?:\)\.?|\.)\s"
    at = F.regexp_instr(t, F.lit(label))
    before, rest = words(F.substring(t, F.lit(1), at - 1)), F.substring(t, at, F.length(t))
    alpha = F.size(F.filter(before, lambda x: x.rlike(r"\p{L}")))
    inside = (at > 1) & (F.size(before) < 7) & (alpha < 5) & ~(F.array_join(before, " ").rlike("[.!?;:]") & (alpha >= 3))
    told = (F.length(rest) >= 8) & (F.size(F.filter(words(rest), lambda x: x.rlike(r"\p{L}"))) >= 3)
    found = ((at == 1) | inside) & told & ~rest.rlike(panel)
    return F.when(found, F.when(F.lower(rest).startswith("table"), "table_caption").otherwise("figure_caption"))


def author_segments(c: Column) -> Column:
    """The parts of a byline that look like names of two to six words."""
    t = F.regexp_replace(F.regexp_replace(clean_line(c), "[¹²³⁰⁴-⁹]+", ""), r"(?:\s|^)(?:\d+|[*†‡]+)[\s,;:]*$", "")
    for pattern in (r"(?i)\s+and\s+", "[;,]+", r"(?<=[A-Za-z])(?:\d+|[*†‡]+)(?=\s+[A-Z])", r"\s(?:\d+|[*†‡]+)\s+(?=[A-Z])"):
        t = F.regexp_replace(t, pattern, " | ")
    bare = F.transform(F.split(t, r"\|"), lambda s: F.trim(F.regexp_replace(F.regexp_replace(F.trim(s), r"(?:\s|^)(?:\d+|[*†‡]+)$", ""), r"(?<=[A-Za-z])(?:\d+|[*†‡]+)$", "")))

    def named(s: Column) -> Column:
        w = words(s)
        good = F.filter(w, lambda x: x.rlike(r"^(?:[A-Z][a-zA-Z'`-]+|[A-Z]\.)$"))
        return ~contains_any(F.lower(s), NO_AUTHOR) & F.size(w).between(2, 6) & (F.size(good) >= 2) & F.exists(good, lambda x: x.rlike(r"^[A-Z][a-zA-Z'`-]+$"))

    return F.filter(bare, named)


def metadata_role(t: Column, page: Column, y: Column, n: Column, digits: Column, title: Column, lower: Column) -> Column:
    """keywords, doi, received, journal_meta, affiliation_meta or author_meta on the first two pages, else null; n words,
    digits of them with a digit, title and lower the shares of title-case and lower-case words."""
    low, doi = F.lower(t), F.contains(F.lower(t), F.lit("doi"))
    email, keyed = F.contains(t, F.lit("@")), low.rlike("^key ?words:")
    place, marked = contains_any(low, AFFILIATION), t.rlike(r"^\d{1,3}(?:\s+|\*+\s*|\)+\s*|\.\s*)(?=[A-Za-z])")
    citation = t.rlike(r"^[A-Z]{2,}\s+\d{4};\s*\d+[–:：-]\d+|^\d{4}[–-]\d{3}[\dXx](?:/\d+)?") | (F.contains(low, F.lit("et al")) & t.rlike(r"^[A-Z][a-zA-Z'`-]+\s+[A-Z],"))
    return F.when(
        page <= 2,
        F.when(keyed & (y <= 0.9) & (n <= 40), "keywords")
        .when(doi & (y <= 0.9) & (n <= 28) & (digits >= 1), "doi")
        .when(low.rlike("^(received|accepted|revised|published online)") & (y <= 0.95) & (n <= 48), "received")
        .when((n <= 45) & ((hits(low, JOURNAL) >= 2) | F.contains(t, F.lit("©"))), "journal_meta")
        .when((n <= 18) & citation, "journal_meta")
        .when((y <= 0.97) & n.between(4, 90) & (email | marked | place | low.startswith("address correspondence")) & (lower <= 0.78), "affiliation_meta")
        .when((y <= 0.72) & n.between(2, 90) & (title >= 0.45) & (lower <= 0.75) & ~email & ~place & ~low.startswith("keywords:") & ~doi & (F.size(author_segments(t)) >= 1),
              F.when((digits >= F.greatest(F.lit(1), F.floor(n / 2))) & marked, "affiliation_meta").otherwise("author_meta")),
    )


def clean_roles(roled: DataFrame, profile: DataFrame | None = None, repeated: DataFrame | None = None) -> DataFrame:
    """doc_id, block_id, clean_role of blocks with a role (fallback or a model's) by the first rule that holds: repeated
    noise, roles that decide alone, captions by text, labels and boxes, main title, headings by the document's font
    profile or shape, bibliography entries, front matter, body.

    profile(doc_id, heading_size, heading_bold, heading_font, body_size) and repeated(doc_id, block_id, n, n_blocks,
    is_nuisance) are optional; without them these rules don't hold. Null texts are empty and end as body_text."""
    page = W.partitionBy("doc_id", "page")
    top, bottom = F.min("y0").over(page), F.max("y1").over(page)
    b = roled.withColumn("_t", clean_line(F.col("text"))).withColumn("_y", ((F.col("y0") + F.col("y1")) / 2 - top) / F.greatest(F.lit(1e-6), bottom - top))
    if profile is not None:
        b = b.join(profile, "doc_id", "left")
    if repeated is not None:
        b = b.join(repeated.select("doc_id", "block_id", "n", "n_blocks", "is_nuisance"), ["doc_id", "block_id"], "left")
    # What many rules read is computed once, in projections of its own.
    w = F.col("_w")
    b = b.withColumn("_w", F.array_remove(F.split("_t", " "), "")).withColumns({"_n": F.size(w), "_title": title_share(w), "_lower": lower_share(w), "_digits": F.size(F.filter(w, has_digit)), "_kind": caption_kind(F.col("_t"))})
    t, role, size, n, title, digits, lower = F.col("_t"), F.col("role"), F.coalesce("font_size", F.lit(0.0)), F.col("_n"), F.col("_title"), F.col("_digits"), F.col("_lower")
    bold = F.coalesce("is_bold", F.lit(False))
    candidate, open_end = F.coalesce("is_heading", F.lit(False)), ~t.rlike("[.;:]$")
    shown = F.lit(False)
    if profile is not None:
        large = (F.col("heading_size") > 0) & (F.col("body_size") > 0) & (F.col("heading_size") >= F.col("body_size") + 1) & (size >= F.greatest(F.col("heading_size") - 0.6, F.col("body_size") + 0.9))
        same = F.coalesce(F.col("font") == F.col("heading_font"), F.lit(False))
        other = (F.coalesce("font", F.lit("")) != "") & (F.coalesce("heading_font", F.lit("")) != "") & ~same
        shown = F.coalesce(large & n.between(1, 16) & (digits <= 2) & open_end & ((title >= 0.5) | (n <= 3)) & ~other & (same | ((F.col("heading_bold") >= 0.75) & bold)), F.lit(False))
    noise = F.coalesce("is_nuisance", F.lit(False)) if repeated is not None else F.lit(False)
    often = F.coalesce((F.col("n") >= 3) & (F.col("n") >= 0.6 * F.col("n_blocks")), F.lit(False)) if repeated is not None else F.lit(False)
    entry = n.between(4, 55) & (t.rlike(r"^\d+[.)]\s+|^\[\d+\]") | F.lower(t).rlike("^references[ :]")) & (count_of(t, r"\.") >= 2)
    meta = F.when(~t.rlike(r"^\d+(?:\.\d+)*\.\s+[A-Za-z]"), metadata_role(t, F.col("page"), F.col("_y"), n, digits, title, lower))
    clean = (
        F.when(noise, "nuisance").when(role == "FigureCaption", "figure_caption").when(role == "TableCaption", "table_caption")
        .when(role.isin("TableHeader", "TableData", "Sidebar"), "nuisance").when(role == "ReferenceList", "reference_entry")
        .when(F.col("_kind").isNotNull(), F.col("_kind")).when(is_compact_label(t) | is_boxed_sidebar(t, size, bold, n, lower), "nuisance")
        .when((F.col("page") == 1) & (F.col("_y") <= 0.35) & (n >= 6) & ((role == "Heading") | candidate | (bold & (size >= 13))), "main_title")
        .when(shown | (role == "Heading") | (candidate & (n <= 16) & (title >= 0.55) & open_end & (digits <= 2)), "section_heading")
        .when(entry, "reference_entry").when(often & meta.isin("journal_meta", "received"), "nuisance").otherwise(F.coalesce(meta, F.lit("body_text")))
    )
    # the generator is a barrier: a filter on the role doesn't evaluate these rules a second time
    return b.select("doc_id", "block_id", F.explode(F.array(clean)).alias("clean_role"))


def is_reference_text(c: Column) -> Column:
    """At least two of year, identifier, author and journal."""
    return (c.rlike(YEAR).cast("int") + c.rlike(IDENTIFIER).cast("int") + c.rlike(AUTHOR).cast("int") + c.rlike(JOURNAL_HINT).cast("int")) >= 2


def reference_paragraphs(paragraphs: DataFrame) -> DataFrame:
    """doc_id, para_id, is_reference: by role; in a bibliography section numbered, with two markers or two signals;
    elsewhere numbered with two signals or the word references. Null texts are none."""
    t, section = F.coalesce("text", F.lit("")), F.lower(F.coalesce("section", F.lit("")))
    numbered, shown = t.rlike(NUMBERED), is_reference_text(F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"\s+", " ")))
    listed = (F.contains(section, F.lit("reference")) | F.contains(section, F.lit("bibliograph"))) & (numbered | (count_of(t, MARKERS) >= 2) | shown)
    out = (F.coalesce("role", F.lit("")) == "ReferenceList") | listed | (numbered & (shown | F.contains(F.lower(t), F.lit("references"))))
    return paragraphs.select("doc_id", "para_id", out.alias("is_reference"))


def region_roles(blocks: DataFrame, regions: DataFrame) -> DataFrame:
    """doc_id, block_id, region_role of the region that holds a block's centre or overlaps it most, the first of equals;
    caption regions by the block's text. regions(doc_id, page, region_ord, role, rx0, ry0, rx1, ry1)."""
    dx = F.greatest(F.lit(0.0), F.least("x1", "rx1") - F.greatest("x0", "rx0"))
    area = dx * F.greatest(F.lit(0.0), F.least("y1", "ry1") - F.greatest("y0", "ry0"))
    centre = ((F.col("x0") + F.col("x1")) / 2).between(F.col("rx0"), F.col("rx1")) & ((F.col("y0") + F.col("y1")) / 2).between(F.col("ry0"), F.col("ry1"))
    score = area + F.when(centre, 1e6).otherwise(0.0)
    role = F.when(F.col("role") == REGION_CAPTION, F.when(F.lower(clean_line(F.col("text"))).startswith("table"), "TableCaption").otherwise("FigureCaption")).otherwise(F.col("role"))
    b = blocks.select("doc_id", "page", "block_id", "text", "x0", "y0", "x1", "y1")
    return b.join(regions, ["doc_id", "page"]).where(score > 0).groupBy("doc_id", "block_id").agg(F.max_by(role, F.struct(score, -F.col("region_ord"))).alias("region_role"))


def titles(cleaned: DataFrame) -> DataFrame:
    """doc_id, title: of first-page blocks with 4 to 40 words, 24 characters or more and no full stop, the main title
    before DOI lines before others, then the largest, the topmost, the longest and the last in order of text."""
    t = clean_line(F.col("text"))
    for pattern in (r"^(?i)(?:article|review)\s+", r"^(?i)doi[:\s]+", r"^(?i)https?://doi\.org/[^\s>\"')]+\s*", r"^10\.\d{4,}[^\s>\"')]+\s*"):
        t = F.regexp_replace(t, pattern, "")
    b = cleaned.where("page = 1 AND clean_role <> 'nuisance'").withColumn("_t", F.regexp_replace(t, r"^[ \-:;,.]+|[ \-:;,]+$", ""))
    low, n = F.lower("_t"), F.size(words(F.col("_t")))
    good = n.between(4, 40) & (F.length("_t") >= 24) & ~F.col("_t").endswith(".") & ~low.rlike("^(received|accepted|keywords|submission timeline)")
    rank = F.when(F.col("clean_role") == "main_title", 2).when(F.col("clean_role") == "doi", 1).otherwise(0)
    return b.where(good).groupBy("doc_id").agg(F.max_by("_t", F.struct(rank, F.coalesce("font_size", F.lit(0.0)), -F.col("y0"), F.length("_t"), F.col("_t"))).alias("title"))
