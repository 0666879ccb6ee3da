"""Notes: one markdown text for each document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def notes(roled: DataFrame, references: DataFrame) -> DataFrame:
    """doc_id, text: headings and bodies in reading order, captions as quotes, then the references, mapped ones marked.
    roled: doc_id, page, reading_pos, role, text; references: doc_id, ref_key, title, mapped."""
    t = F.trim("text")
    line = F.when(F.col("role") == "Heading", F.concat(F.lit("## "), t)).when(F.col("role").isin("FigureCaption", "TableCaption"), F.concat(F.lit("> "), t)).otherwise(t)
    join = lambda order, c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, c.alias("x")))), lambda s: s["x"]), "\n\n")
    body = roled.where((t != "") & (F.col("role") != "HeaderFooter")).groupBy("doc_id").agg(join(["page", "reading_pos"], line).alias("body"))
    entry = F.concat(F.when(F.col("mapped"), "- [mapped] ").otherwise("- [catalog] "), "ref_key", F.lit(" "), F.coalesce("title", F.lit("")))
    refs = references.groupBy("doc_id").agg(join(["ref_key"], entry).alias("refs"))
    return body.join(refs, "doc_id", "left").select("doc_id", F.concat("body", F.when(F.col("refs").isNotNull(), F.concat(F.lit("\n\n## References\n\n"), "refs")).otherwise("")).alias("text"))
