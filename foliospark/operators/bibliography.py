"""Reference entries: parsing, catalog, order, back-fill from providers, title similarity."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

#: Identifiers as they stand in texts.
DOI = r"(?i)\b(10\.\d{4,}(?:\.\d+)*/[^\s\]>\"']+)\b"
PMID = r"(?i)\b(PMID[:\s]*)?(\d{7,9})\b"
ARXIV = r"(?i)\b(?:arxiv\s*[:/]\s*)?(\d{4}\.\d{4,5}(?:v\d+)?)\b"
MARKER = r"^\s*(?:\[\d+\]|\d+[.)])\s*"


def arxiv_id(c: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(c, ARXIV, 1)), F.lit(""))


def _blanks(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def _count(c: Column, pattern: str) -> Column:
    return F.regexp_count(c, F.lit(pattern))


def _words(c: Column) -> Column:
    return F.size(F.array_remove(F.split(c, " "), ""))


def parse(entries: DataFrame, text: str = "text") -> DataFrame:
    """entries with authors, title, year, venue, doi, pmid, raw_text, read from a free reference text: the title is the
    first sentence of four words or more that doesn't look like a list of authors, what stands before it is the authors
    (ten at most), the sentence after it the venue. A null text is empty."""
    e = entries.withColumn("raw_text", F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), MARKER, "")))
    doi = F.regexp_replace(F.lower(F.regexp_extract("raw_text", DOI, 1)), r"[.,;:)]+$", "")
    e = e.withColumn("doi", F.nullif(doi, F.lit(""))).withColumn("pmid", F.nullif(F.regexp_extract("raw_text", PMID, 2), F.lit("")))
    e = e.withColumn("year", F.get(F.reverse(F.regexp_extract_all("raw_text", F.lit(r"\b(19\d{2}|20\d{2})\b"), F.lit(1))), 0).cast("int"))
    plain = F.when(F.col("doi").isNotNull(), F.regexp_replace("raw_text", F.concat(F.lit(r"(?i)\Q"), F.col("doi"), F.lit(r"\E")), F.lit(""))).otherwise(F.col("raw_text"))
    plain = F.when(F.col("pmid").isNotNull(), F.regexp_replace(plain, F.concat(F.lit(r"(?i)\bPMID[:\s]*"), F.col("pmid"), F.lit(r"\b")), F.lit(""))).otherwise(plain)
    e = e.withColumn("_plain", _blanks(plain))
    strip = lambda x, chars: F.regexp_replace(x, rf"^[{chars}]+|[{chars}]+$", "")
    e = e.withColumn("_chunks", F.filter(F.transform(F.split("_plain", r"\.\s+"), lambda x: strip(x, " .")), lambda x: x != ""))
    names = lambda x: F.lower(x).contains("et al") | (_count(x, r"\b[A-Z]\.") >= 2) | ((F.length(x) - F.length(F.replace(x, F.lit(","), F.lit(""))) >= 2) & (_words(x) <= 20))
    e = e.withColumn("_at", F.array_position(F.transform("_chunks", lambda x: ~names(x) & (_words(x) >= 4)), True).cast("int"))
    e = e.withColumn("_at", F.greatest(F.lit(1), F.col("_at")))
    title = F.coalesce(F.get("_chunks", F.col("_at") - 1), F.lit(""))
    written = F.when(F.size("_chunks") == 0, F.col("_plain")).when(F.col("_at") > 1, F.array_join(F.slice("_chunks", F.lit(1), F.col("_at") - 1), ". ")).otherwise(F.get("_chunks", 0))
    each = F.transform(F.split(written, r",\s*(?=[A-Z][a-z]|[A-Z]\.)|\s+and\s+|\s*&\s*"), lambda x: strip(x, " ,"))
    authors = F.filter(each, lambda x: (F.length(x) > 2) & ~F.lower(x).isin("et al", "et al."))
    e = e.withColumn("authors", F.slice(authors, 1, 10)).withColumn("title", F.when(_words(title) <= 2, F.substring("_plain", 1, 180)).otherwise(title))
    return e.withColumn("venue", F.coalesce(F.get("_chunks", F.col("_at")), F.lit(""))).drop("_plain", "_chunks", "_at")


def catalog(entries: DataFrame) -> DataFrame:
    """The first entry of every ref_key, parsed: doc_id, ref_key, para_id, page, marker, authors, title, year, venue, doi,
    pmid, raw_text, confidence (.65 with a marker, else .55). entries: doc_id, ord, ref_key, para_id, page, marker, text;
    those without a key go."""
    own = W.partitionBy("doc_id", "ref_key").orderBy("ord")
    first = entries.where(F.coalesce("ref_key", F.lit("")) != "").withColumn("_n", F.row_number().over(own)).where("_n = 1")
    return parse(first).select("doc_id", "ref_key", "para_id", "page", "marker", "authors", "title", "year", "venue", "doi", "pmid", "raw_text", F.when(F.col("marker").isNotNull(), F.lit(0.65)).otherwise(F.lit(0.55)).alias("confidence"))


def ordered(references: DataFrame) -> DataFrame:
    """references with `rank` in their document: most confident first, then by title in lower case and source."""
    order = W.partitionBy("doc_id").orderBy(F.desc("confidence"), F.lower("title"), "source", "ref_key")
    return references.withColumn("rank", F.row_number().over(order))


def shown_authors(authors: Column, most: int = 3) -> Column:
    """Up to `most` names; of more, the first ones and et al."""
    names = F.array_join(F.slice(authors, 1, most), ", ")
    return F.when(F.size(authors) > most, F.concat(names, F.lit(" et al."))).otherwise(names)


def backfill(references: DataFrame, provided: DataFrame, fields: tuple[str, ...], most: int) -> DataFrame:
    """references (doc_id, ref_key, ord, fields) with missing or empty fields filled from provided (ref_key, fields, rank:
    the provider's turn), for the first `most` incomplete references of a document; filled: number of fields filled."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) == ""
    incomplete = F.greatest(*[blank(c).cast("int") for c in fields]) == 1
    turn = F.sum(incomplete.cast("int")).over(W.partitionBy("doc_id").orderBy("ord", "ref_key").rowsBetween(W.unboundedPreceding, 0))
    asked = references.withColumn("_asks", incomplete & (turn <= most))
    first = provided.groupBy("ref_key").agg(*[F.min_by(c, F.when(~blank(c), F.col("rank"))).alias(f"_{c}") for c in fields])
    both = asked.join(first, "ref_key", "left")
    fills = {c: F.col("_asks") & blank(c) & F.col(f"_{c}").isNotNull() for c in fields}
    out = both.withColumn("filled", sum((f.cast("int") for f in fills.values()), F.lit(0)))
    return out.select(*[F.when(fills[c], F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in fields else c for c in references.columns], "filled")


def identifiers_agree(left: Column, right: Column) -> Column:
    """Whether two arrays of identifiers share one, upper and lower case alike."""
    low = lambda a: F.transform(a, lambda x: F.lower(F.trim(x)))
    return F.coalesce(F.arrays_overlap(low(left), low(right)), F.lit(False))


@F.pandas_udf(DoubleType())
def title_similarity(left: pd.Series, right: pd.Series) -> pd.Series:
    """Ratio of matching runs of characters (difflib) of two title keys; 1 if they are equal, 0 if one is empty. The
    measure has no counterpart among SQL functions, so it comes in Arrow batches."""
    def ratio(a, b):
        return 0.0 if not a or not b else 1.0 if a == b else difflib.SequenceMatcher(None, a, b).ratio()

    return pd.Series([ratio(a, b) for a, b in zip(left, right, strict=True)], dtype="float64")
