"""Raw web pages as documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def outline(pages: DataFrame) -> DataFrame:
    """page_id, title (the first h1 without tags), n_headings, n_paragraphs."""
    title = F.trim(F.regexp_replace(F.regexp_extract("html", r"(?s)<h1[^>]*>(.*?)</h1>", 1), "<[^>]+>", ""))
    return pages.select("page_id", title.alias("title"), F.regexp_count("html", F.lit("<h[1-6]")).alias("n_headings"), F.regexp_count("html", F.lit("<p[ >]")).alias("n_paragraphs"))


def plain_text(pages: DataFrame) -> DataFrame:
    """page_id, text: scripts, styles and tags out, block ends as line breaks, five entities decoded."""
    t = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->", "")
    t = F.regexp_replace(F.regexp_replace(t, r"(?i)</(p|h[1-6]|li|div|tr)>|<br\s*/?>", "\n"), r"(?s)<[^>]+>", "")
    for name, c in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        t = F.replace(t, F.lit(name), F.lit(c))
    return pages.select("page_id", F.regexp_replace(t, r"^\s+|\s+$", "").alias("text"))
