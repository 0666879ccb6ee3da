"""Markers, nearest paragraphs, reference mapping and merging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import clean_line, expand_markers, reference_key

MARKER = r"^[\[(]?\d+(\s*[-,;]\s*\d+)*[\])]?$"
DOI = r"(?i)\b10\.\d{4,}(\.\d+)*/[^\s\]>\"']+"


def anchor_types(anchors: DataFrame) -> DataFrame:
    """anchors(anchor_text, link_type) with anchor_type."""
    t = F.lower(F.trim(F.coalesce("anchor_text", F.lit(""))))
    kind = F.when(t.rlike(MARKER), "citation_marker").when(t.rlike(DOI) | t.rlike(r"\b(pmid[:\s]*)?\d{7,9}\b"), "citation_marker").when(t.startswith("http") | F.contains(t, F.lit("doi.org/")) | F.contains(t, F.lit("pubmed")), "resource_link")
    return anchors.withColumn("anchor_type", F.coalesce(kind, F.when(F.col("link_type") == "internal", "citation_marker").when(F.col("link_type") == "external", "resource_link").otherwise("structural_link")))


def distinct_anchors(anchors: DataFrame) -> DataFrame:
    """The first of equal anchors (page, text, link_type): links come before inline ones (source_rank), then order."""
    w = W.partitionBy("doc_id", "page", "anchor_text", "link_type").orderBy("source_rank", "anchor_id")
    return anchors.withColumn("n", F.row_number().over(w)).where("n = 1").drop("n")


def nearest_paragraphs(anchors: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """anchor_id, para_id: on the anchor's page, or else the nearest page that has paragraphs (the earlier of two), the
    paragraph with the least (|dy|, |dx of centres|, id). Two equi joins; no pair leaves its document."""
    pages = paragraphs.select("doc_id", F.col("page").alias("para_page")).distinct()
    page = anchors.join(pages, "doc_id").groupBy("doc_id", "anchor_id").agg(F.min(F.struct(F.abs(F.col("para_page") - F.col("page")).alias("d"), "para_page")).alias("best"))
    placed = anchors.join(page, ["doc_id", "anchor_id"]).select("doc_id", "anchor_id", F.col("ax").alias("ax"), "ay", F.col("best.para_page").alias("page"))
    near = F.struct(F.abs(F.col("y0") - F.col("ay")), F.abs((F.col("x0") + F.col("x1")) / 2 - F.col("ax")), "para_id")
    return placed.join(paragraphs, ["doc_id", "page"]).groupBy("doc_id", "anchor_id").agg(F.min_by("para_id", near).alias("para_id"))


def map_markers(anchors: DataFrame, references: DataFrame) -> DataFrame:
    """anchor_id, marker, ref_key, strategy: each number of a marker looked up in the document's bibliography
    (doc_id, marker, ref_key, ord; the first entry of a marker counts)."""
    first = references.groupBy("doc_id", "marker").agg(F.min_by("ref_key", "ord").alias("ref_key"))
    each = anchors.withColumn("marker", F.explode(expand_markers(F.regexp_replace("anchor_text", r"[\[\]()]", ""))))
    return each.join(first, ["doc_id", "marker"], "left").select("doc_id", "anchor_id", "marker", "ref_key", F.when(F.col("ref_key").isNull(), "none").otherwise("regex").alias("strategy"))


def fuzzy_references(anchors: DataFrame, references: DataFrame, least: float = 0.35) -> DataFrame:
    """anchor_id, ref_key, confidence: .88 for the first entry that holds the anchor's text of 8 characters or more, else
    by shared tokens of four characters or more through an inverted index: .55 + .35 * containment, at most .84; ties
    to the entry listed first. Numeric markers and anchors without such tokens take no part."""
    tokens = lambda c: F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit("([a-z0-9]{4,})"), 1))
    stop = F.array(*map(F.lit, ("http", "https", "www", "doi", "pmid")))
    low = F.trim(F.lower("anchor_text"))
    named = anchors.where(~low.rlike(MARKER)).select("doc_id", "anchor_id", low.alias("said"), F.array_except(tokens(F.col("anchor_text")), stop).alias("t")).where(F.size("t") > 0)
    a = named.select("doc_id", "anchor_id", F.size("t").alias("n"), F.explode("t").alias("token"))
    r = references.select("doc_id", "ref_key", "ord", F.explode(tokens(F.col("text"))).alias("token"))
    hits = a.join(r, ["doc_id", "token"]).groupBy("doc_id", "anchor_id", "n", "ref_key", "ord").agg(F.count("*").alias("k")).where(F.col("k") / F.col("n") >= least)
    shared = hits.select("doc_id", "anchor_id", "ref_key", "ord", (F.col("k") / F.col("n")).alias("part"), F.least(F.lit(0.84), 0.55 + F.col("k") / F.col("n") * 0.35).alias("score"))
    # a text may begin or end inside a token, so this looks at every entry of the document
    held = named.where(F.length("said") >= 8).join(references.select("doc_id", "ref_key", "ord", F.lower("text").alias("body")), "doc_id").where(F.contains("body", "said"))
    held = held.select("doc_id", "anchor_id", "ref_key", "ord", F.lit(2.0).alias("part"), F.lit(0.88).alias("score"))
    best = shared.union(held).groupBy("doc_id", "anchor_id").agg(F.max_by(F.struct("ref_key", F.round("score", 6).alias("confidence")), F.struct("part", -F.col("ord"))).alias("_best"))
    return best.select("doc_id", "anchor_id", "_best.*")


def merge_references(references: DataFrame) -> DataFrame:
    """One record for each key (DOI, else PMID, else title and year): the first filled value of each field (API before
    PDF, then order), the highest confidence, all sources. references: doc_id, kind, provider, ord, title, doi, pmid,
    year, venue, confidence."""
    keyed = references.withColumn("ref_key", reference_key(F.col("doi"), F.col("pmid"), F.col("title"), F.col("year")))
    rank = F.struct(F.when(F.col("kind") == "api", 0).otherwise(1), F.col("ord"))
    first = lambda c: F.min_by(c, F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) != "", rank)).alias(c)
    return keyed.groupBy("doc_id", "ref_key").agg(first("title"), first("doi"), first("pmid"), first("year"), first("venue"), F.max("confidence").alias("confidence"), F.array_join(F.array_sort(F.collect_set("provider")), "+").alias("source_chain"), F.count("*").alias("n_records"))


#: Bracketed markers; parentheses with several numbers, or with one near a word of citation; named destinations.
BRACKETED = r"\[(\d{1,3}(?:\s*[-,;]\s*\d{1,3})*)\]"
PARENTHESES = r"(?is)\(\d{1,3}(?:\s*[-,;]\s*\d{1,3})+\)|(?<=ref.{0,15}|citation.{0,10})\(\d{1,3}\)|\(\d{1,3}\)(?=.{0,9}ref|.{0,4}citation)"
DESTINATION = r"(?i)\bbib[-_]?0*(\d{1,4})\b"


def inline_anchors(paragraphs: DataFrame) -> DataFrame:
    """doc_id, para_id, page, anchor_text of every number of the markers in paragraphs' texts, `[n]` each, repeats
    included; bibliography entries (is_reference) have none. Brackets always count, parentheses if they hold several
    numbers or a word of citation is near."""
    t = F.coalesce("text", F.lit(""))
    inside = F.transform(F.regexp_extract_all(t, F.lit(PARENTHESES), F.lit(0)), lambda m: F.regexp_replace(m, r"[()\s]", ""))
    marks = F.concat(F.transform(F.regexp_extract_all(t, F.lit(BRACKETED), F.lit(1)), lambda m: F.regexp_replace(m, r"\s", "")), inside)
    own = paragraphs.where(~F.coalesce("is_reference", F.lit(False)))
    return own.select("doc_id", "para_id", "page", F.explode(F.flatten(F.transform(marks, expand_markers))).alias("_n")).select("doc_id", "para_id", "page", F.concat(F.lit("["), "_n", F.lit("]")).alias("anchor_text"))


def destination_marker(c: Column) -> Column:
    n = F.regexp_extract(F.coalesce(c, F.lit("")), DESTINATION, 1).try_cast("int")
    return F.when(n > 0, n)


def demote(anchors: DataFrame, references: DataFrame) -> DataFrame:
    """anchors with the anchor_type structural_link where a bare digit isn't in the bibliography or an internal link
    points to a named place outside it."""
    digit = F.when(F.trim("anchor_text").rlike(r"^\d$"), F.trim("anchor_text").try_cast("int"))
    known = references.where("ref_key IS NOT NULL").select("doc_id", F.col("marker").alias("_digit")).distinct().withColumn("_known", F.lit(True))
    a = anchors.withColumn("_digit", digit).join(known, ["doc_id", "_digit"], "left")
    bare = (F.col("_digit") > 0) & F.col("_known").isNull()
    away = (F.col("link_type") == "internal") & (F.coalesce("dest_name", F.lit("")) != "") & destination_marker(F.col("dest_name")).isNull()
    loose = F.coalesce(bare, F.lit(False)) | F.coalesce(away, F.lit(False))
    return a.withColumn("anchor_type", F.when((F.col("anchor_type") == "citation_marker") & loose, "structural_link").otherwise(F.col("anchor_type"))).select(*anchors.columns)


def identifier_key(c: Column) -> Column:
    """doi: or pmid: key of the first identifier in a text, else null."""
    doi = F.regexp_extract(c, r"(?i)\b(10\.\d{4,}(?:\.\d+)*/[^\s\]>\"']+)\b", 1)
    doi = F.regexp_replace(F.regexp_replace(F.lower(doi), "[.,;:)]+$", ""), "[&?].*$", "")
    pmid = F.regexp_extract(c, r"(?i)\b(?:PMID[:\s]*)?(\d{7,9})\b", 1)
    return F.when(doi != "", F.concat(F.lit("doi:"), doi)).when(pmid != "", F.concat(F.lit("pmid:"), pmid))


def free_key(c: Column) -> Column:
    """bib: key of a free text: first author, four-digit year and 8 digits of the text's MD5; without author or year
    `ref` and the digits."""
    bare = F.trim(F.regexp_replace(c, r"^\s*(?:\[\d+\]|\d+[.)])\s*", ""))
    bare = F.when(bare == "", F.trim(c)).otherwise(bare)
    low = F.regexp_replace(F.lower(bare), r"^[a-z]\)\s*", "")
    listed, opening = F.regexp_extract(low, r"(?:^|[,\s])([a-z][a-z-]+)\s*,", 1), F.regexp_extract(low, "^([a-z][a-z-]+)", 1)
    author, year = F.when(listed != "", listed).otherwise(opening), F.regexp_extract(bare, r"\b((?:19|20)\d{2})\b", 1)
    digits = F.substring(F.md5(bare), 1, 8)
    return F.when((author != "") & (year != ""), F.concat_ws("_", F.concat(F.lit("bib:"), author), year, digits)).otherwise(F.concat(F.lit("bib:ref_"), digits))


def map_citations(anchors: DataFrame, references: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """doc_id, anchor_id, ref_key, strategy, confidence, reason by the first rule that holds: a named destination, an
    identifier in the text, a free text's own key, the first number known to the bibliography, the nearest reference
    paragraph of an internal link without text.

    anchors: doc_id, anchor_id, anchor_text, link_type, dest_name, anchor_type, nearest_para_id; references: doc_id, marker,
    ord, ref_key; paragraphs: doc_id, para_id, text of reference paragraphs. Lookups are equi joins on (doc_id, number)
    and (doc_id, para_id). Null texts are empty."""
    t = F.trim(F.coalesce("anchor_text", F.lit("")))
    first = references.where("ref_key IS NOT NULL").groupBy("doc_id", "marker").agg(F.min_by("ref_key", "ord").alias("_key"))
    indexed = first.select("doc_id").distinct().withColumn("_indexed", F.lit(True))
    marks = expand_markers(F.when(t.rlike(MARKER), F.regexp_replace(t, r"[\[\]()\s]", "")).otherwise(""))
    a = anchors.select("doc_id", "anchor_id", t.alias("_t"), "link_type", "anchor_type", "nearest_para_id", destination_marker(F.col("dest_name")).alias("_dest"), marks.alias("_marks"))
    numbers = a.select("doc_id", "anchor_id", F.explode(F.when(F.col("_dest").isNotNull(), F.array("_dest")).otherwise(F.col("_marks"))).alias("marker"))
    looked = numbers.join(first, ["doc_id", "marker"]).groupBy("doc_id", "anchor_id").agg(F.min_by("_key", "marker").alias("_key"))
    near = paragraphs.select("doc_id", F.col("para_id").alias("nearest_para_id"), F.coalesce(identifier_key(F.col("text")), free_key(F.col("text"))).alias("_near"))
    a = a.join(looked, ["doc_id", "anchor_id"], "left").join(indexed, "doc_id", "left").join(near, ["doc_id", "nearest_para_id"], "left")
    own, free = identifier_key(F.col("_t")), (F.col("_t") != "") & ~F.col("_t").rlike(MARKER)
    none = F.lit(None).cast("string")
    out = lambda key, strategy, sure, reason=none: F.struct(key.alias("ref_key"), F.lit(strategy).alias("strategy"), (F.lit(sure) if isinstance(sure, float) else sure).alias("confidence"), reason.alias("reason"))
    lost = F.when(F.col("_t") == "", "empty anchor_text").when(F.col("_indexed").isNull(), "no reference entries available").when(F.col("link_type") == "external", "external link not mappable to bibliography").otherwise("no matching reference found")
    found = (
        F.when(F.col("anchor_type") != "citation_marker", out(none, "none", 0.0, F.concat(F.lit("non-citation anchor type: "), "anchor_type")))
        .when(F.col("_dest").isNotNull(), out(F.coalesce("_key", F.concat(F.lit("bib:dest_"), F.lpad(F.col("_dest").cast("string"), 4, "0"))), "internal_dest", F.when(F.col("_key").isNull(), 0.72).otherwise(0.93)))
        .when(own.isNotNull(), out(own, "regex", F.when(own.startswith("doi:"), 0.95).otherwise(0.9)))
        .when(free, out(free_key(F.col("_t")), "regex", 0.62))
        .when(F.col("_key").isNotNull(), out(F.col("_key"), "internal_dest", 0.86))
        .when(F.size("_marks") > 0, out(none, "none", 0.0, F.when(F.col("_indexed").isNull(), "reference marker index unavailable").otherwise("marker not found in reference index")))
        .when((F.col("link_type") == "internal") & F.col("_near").isNotNull(), out(F.col("_near"), "internal_dest", 0.82))
        .otherwise(out(none, "none", 0.0, lost))
    )
    return a.select("doc_id", "anchor_id", found.alias("_f")).select("doc_id", "anchor_id", "_f.*")


def resolve_keys(mapped: DataFrame, entries: DataFrame, merged: DataFrame) -> DataFrame:
    """mapped(doc_id, anchor_id, ref_key, strategy, confidence) with keys of merged references: a key already there stays;
    else that of the same title and year (the higher confidence), else the DOI of the same author and year
    (author_year_match, .75), else the key as it is. entries and merged: doc_id, ref_key, title, author, year; merged also
    doi and confidence. The first merged record of a title or author and year, in order of key, counts."""
    title = F.trim(F.regexp_replace(F.regexp_replace(F.lower(clean_line(F.col("title"))), r"\b(19|20)\d{2}\b", ""), "[^a-z0-9]+", " "))
    keyed = lambda df: df.select("doc_id", "ref_key", title.alias("_title"), F.lower("author").alias("_author"), F.col("year").alias("_year"), *([F.col("doi").alias("_doi"), F.col("confidence").alias("_sure")] if df is merged else []))
    e, m = keyed(entries).dropDuplicates(["doc_id", "ref_key"]), keyed(merged)
    have = m.select("doc_id", "ref_key").distinct().withColumn("_have", F.lit(True))
    titled = m.where("_title <> ''").groupBy("doc_id", "_title", "_year").agg(F.min(F.struct("ref_key", "_sure")).alias("_by_title"))
    signed = m.where("_author <> '' AND _doi <> ''").groupBy("doc_id", "_author", "_year").agg(F.min_by("_doi", "ref_key").alias("_by_author"))
    j = mapped.join(have, ["doc_id", "ref_key"], "left").join(e, ["doc_id", "ref_key"], "left").join(titled, ["doc_id", "_title", "_year"], "left").join(signed, ["doc_id", "_author", "_year"], "left")
    by_title, by_author = F.col("_have").isNull() & F.col("_by_title").isNotNull(), F.col("_have").isNull() & F.col("_by_author").isNotNull()
    return j.select(
        "doc_id", "anchor_id", F.when(by_title, F.col("_by_title.ref_key")).when(by_author, F.concat(F.lit("doi:"), F.lower("_by_author"))).otherwise(F.col("ref_key")).alias("ref_key"),
        F.when(~by_title & by_author, "author_year_match").otherwise(F.col("strategy")).alias("strategy"),
        F.when(by_title, F.greatest("confidence", "_by_title._sure")).when(by_author, 0.75).otherwise(F.col("confidence")).alias("confidence"),
    )
