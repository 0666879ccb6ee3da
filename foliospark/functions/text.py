"""Text expressions; JVM-side, no Python in the row path (but for the compatibility form). White space is ASCII white space and U+00A0."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

SPACE = r"[\s ]+"


def clean_line(c: Column) -> Column:
    """Soft hyphens out, white space runs to one blank, trimmed."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), "­", ""), SPACE, " "))


def let(value: Column, body) -> Column:
    """body(value) with value evaluated once, also where body uses it many times."""
    return F.transform(F.array(value), body)[0]


def template(c: Column) -> Column:
    """What repeated lines have in common: lower case, digit runs as #, only a-z and #, 180 characters."""
    t = F.lower(F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), SPACE, " ")))
    t = F.regexp_replace(F.regexp_replace(t, r"[0-9]+", "#"), r"[^a-z# ]", " ")
    return F.substring(F.trim(F.regexp_replace(t, " +", " ")), 1, 180)


def words(c: Column) -> Column:
    return F.array_remove(F.split(clean_line(c), " "), "")


def count_words(w: Column, test) -> Column:
    return F.size(F.filter(w, test))


def has_digit(w: Column) -> Column:
    return w.rlike("[0-9]")


def starts_upper(w: Column) -> Column:
    return w.rlike(r"^\p{Lu}")


def first_statement(c: Column, most: int = 30) -> Column:
    """The first sentence, at most 30 words of it."""
    return F.array_join(F.slice(words(F.element_at(F.split(clean_line(c), r"(?<=[.!?]) "), 1)), 1, most), " ")


def quote(c: Column, most: int = 30) -> tuple[Column, Column]:
    """The quote and whether it had to be cut."""
    w = words(c)
    long = F.size(w) > most
    return F.when(long, F.concat(F.array_join(F.slice(w, 1, most), " "), F.lit(" ..."))).otherwise(c), long


def expand_markers(c: Column) -> Column:
    """`1,3-5;9` to [1, 3, 4, 5, 9]: reversed ranges, ranges longer than 30 and zero are dropped; sorted, distinct."""
    parts = F.split(F.regexp_replace(c, " ", ""), "[,;]")

    def of(p: Column) -> Column:
        low = F.regexp_extract(p, r"^([0-9]{1,9})-([0-9]{1,9})$", 1).try_cast("int")
        high = F.regexp_extract(p, r"^([0-9]{1,9})-([0-9]{1,9})$", 2).try_cast("int")
        one = F.when(p.rlike("^[0-9]{1,9}$"), F.array(p.try_cast("int")))
        return F.coalesce(F.when((low <= high) & (high - low <= 30), F.sequence(low, high)), one, F.array().cast("array<int>"))

    return F.array_sort(F.array_distinct(F.filter(F.flatten(F.transform(parts, of)), lambda x: x > 0)))


def token_set(c: Column) -> Column:
    return F.array_distinct(F.array_remove(F.split(F.regexp_replace(F.lower(c), r"[^a-z0-9\s]", " "), r"\s+"), ""))


def token_similarity(a: Column, b: Column) -> Column:
    """The larger of containment and Jaccard similarity of two token sets; 0 where one is empty."""
    both = F.size(F.array_intersect(a, b))
    least = F.least(F.size(a), F.size(b))
    return F.when(least == 0, F.lit(0.0)).otherwise(F.greatest(both / least, both / F.size(F.array_union(a, b))))


def reference_key(doi: Column, pmid: Column, title: Column, year: Column) -> Column:
    key = F.trim(F.regexp_replace(F.lower(title), "[^a-z0-9]+", " "))
    return F.when(F.coalesce(doi, F.lit("")) != "", F.concat(F.lit("doi:"), F.lower(doi))).when(F.coalesce(pmid, F.lit("")) != "", F.concat(F.lit("pmid:"), pmid)).otherwise(F.concat(F.lit("title:"), key, F.lit("|year:"), F.coalesce(year.cast("string"), F.lit(""))))


def repair_hyphens(c: Column) -> Column:
    """Wrapped words: a soft hyphen before a lower-case piece goes with the blank, before another it leaves a blank; a
    hard hyphen keeps its place and loses the blank before a lower-case piece."""
    letter = r"\p{L}"
    t = F.regexp_replace(c, rf"(?<![\p{{L}}\d_])({letter}{{2,}})­[\s ]+(\p{{Ll}}{letter}+)(?![\p{{L}}\d_])", "$1$2")
    t = F.regexp_replace(t, rf"(?<![\p{{L}}\d_])({letter}{{2,}})­[\s ]+({letter}{{2,}})(?![\p{{L}}\d_])", "$1 $2")
    return clean_line(F.regexp_replace(t, rf"(?<![\p{{L}}\d_])({letter}{{3,}})-[\s ]+(\p{{Ll}}{letter}+)(?![\p{{L}}\d_])", "$1-$2"))


#: What a caption's number may look like, and what stands between it and the text.
FIGURE_LABEL = r"^(?i)(?:fig(?:ure)?s?\.?)\s*([0-9]+[a-z]?)\b\s*(.*)$"
TABLE_LABEL = r"^(?i)table\s*([0-9]+[a-z]?)\b\s*(.*)$"


def canonical_caption(c: Column, kind: Column) -> Column:
    """`Fig. 3 | text` or `Table 3 | text`, without what parts label and text; other texts with single blanks; null if
    empty. kind: figure or table."""
    raw = F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), SPACE, " "))

    def labelled(pattern: str, name: str) -> Column:
        rest = F.regexp_replace(F.regexp_replace(F.regexp_extract(raw, pattern, 2), r"^[|:\-–—.;,\s]+", ""), r"\s*\|\s*\|+\s*", " | ")
        rest = F.regexp_replace(rest, r"^[ |]+|[ |]+$", "")
        return F.when(raw.rlike(pattern), F.concat(F.lit(name), F.regexp_extract(raw, pattern, 1), F.when(rest != "", F.concat(F.lit(" | "), rest)).otherwise("")))

    return F.nullif(F.coalesce(F.when(kind == "figure", labelled(FIGURE_LABEL, "Fig. ")), F.when(kind == "table", labelled(TABLE_LABEL, "Table ")), raw), F.lit(""))


def json_value(c: Column) -> Column:
    """The JSON text inside a code fence or after prose, null where that doesn't parse."""
    t = F.trim(F.coalesce(c, F.lit("")))
    t = F.when(t.startswith("```"), F.regexp_replace(F.regexp_replace(t, r"^```(?:json)?\s*", ""), r"\s*```$", "")).otherwise(t)
    at = F.regexp_instr(t, F.lit(r"[\{\[]"))
    t = F.when(at > 0, F.substr(t, at)).otherwise(t)
    return F.when(F.try_parse_json(t).isNotNull(), t)


def iso_time(c: Column) -> Column:
    """A timestamp as ISO 8601 in UTC, to the second."""
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")


@F.pandas_udf(StringType())
def compatible(c: pd.Series) -> pd.Series:
    """Unicode's compatibility form (NFKC), which also takes ligatures apart; SQL functions have no counterpart."""
    return c.str.normalize("NFKC")


def heading_key(c: Column) -> Column:
    """What headings are compared by: compatibility form, single blanks, lower case."""
    return F.lower(clean_line(compatible(F.coalesce(c, F.lit("")))))
