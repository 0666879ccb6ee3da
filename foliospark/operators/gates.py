"""Quality gates: one row for each document and gate, and the status of the whole."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .reading import is_strong_claim

HARD = ("provenance_coverage", "paragraph_inversion_rate", "citation_mapping_coverage")


def _ratio(a: Column, b: Column) -> Column:
    return F.when(F.coalesce(b, F.lit(0)) == 0, F.lit(0.0)).otherwise(F.round(a / b, 6))


def _gate(rows: DataFrame, name: str, value: Column, passed: Column, failed: str = "FAIL") -> DataFrame:
    return rows.select("doc_id", F.lit(name).alias("gate"), value.alias("value"), F.when(passed, "PASS").otherwise(failed).alias("status"))


def anchored_facts(facts: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """facts with `reason`: ok, or why a fact isn't anchored. A fact whose para_id is unknown is recovered if exactly one
    paragraph with its block and page exists. facts: doc_id, fact_id, para_id, page, block_id, quote, statement."""
    para = paragraphs.select("doc_id", F.col("para_id").alias("p_id"), F.col("page").alias("p_page"), F.trim(F.coalesce("text", F.lit(""))).alias("p_text"))
    known = facts.join(para, (facts.doc_id == para.doc_id) & (F.col("para_id") == F.col("p_id")), "left").drop(para.doc_id)
    by_block = paragraphs.where(F.trim("text") != "").select("doc_id", "block_id", "page", F.col("para_id").alias("c_id"))
    other = facts.join(by_block, ["doc_id", "block_id", "page"]).groupBy("doc_id", "fact_id").agg(F.countDistinct("c_id").alias("candidates"))
    both = known.join(other, ["doc_id", "fact_id"], "left")
    text = F.coalesce(F.nullif(F.trim("quote"), F.lit("")), F.nullif(F.trim("statement"), F.lit("")))
    reason = F.when(F.coalesce("page", F.lit(0)) <= 0, "missing_or_invalid_evidence_page").when(F.col("block_id").isNull(), "missing_source_block_ids").when(text.isNull(), "missing_text_evidence").when(F.coalesce("para_id", F.lit("")) == "", "missing_para_id").when(F.col("p_id").isNotNull() & (F.col("p_text") == ""), "empty_paragraph_text").when(F.col("p_id").isNotNull(), F.when(F.col("page") == F.col("p_page"), "ok").otherwise("fact_page_not_in_paragraph_span")).when(F.col("candidates") == 1, "ok").when(F.col("candidates") > 1, "ambiguous_paragraph_mapping").otherwise("missing_paragraph_mapping")
    return both.select(*facts.columns, reason.alias("reason"))


def provenance(claims: DataFrame, anchored: DataFrame) -> DataFrame:
    """claims (doc_id, line_id, statement, fact_id): a claim is anchored if all its facts are."""
    a = anchored.select("doc_id", "fact_id", "category", (F.col("reason") == "ok").alias("ok"))
    c = claims.join(a, ["doc_id", "fact_id"], "left").groupBy("doc_id", "line_id").agg(F.bool_and(F.coalesce("ok", F.lit(False))).alias("ok"), F.bool_or(is_strong_claim(F.col("statement"), F.coalesce("category", F.lit("")))).alias("strong"))
    d = c.groupBy("doc_id").agg(F.count("*").alias("n"), F.count_if("ok").alias("k"), F.count_if(F.col("strong") & ~F.col("ok")).alias("bad"))
    value = _ratio(F.col("k"), F.col("n"))
    return _gate(d, "provenance_coverage", value, (value >= 0.95) & (F.col("bad") == 0))


def reading_order(paragraphs: DataFrame, pairs: DataFrame, columns: DataFrame) -> DataFrame:
    """pairs (doc_id, left_id, right_id, left_first): share of known pairs that stand the other way round. columns
    (doc_id, page, interleaved): the pages of several columns, and whether their columns are mixed up."""
    pos = paragraphs.select("doc_id", F.col("para_id"), F.col("ord").alias("pos"))
    left = pairs.join(pos.withColumnsRenamed({"para_id": "left_id", "pos": "lp"}), ["doc_id", "left_id"])
    both = left.join(pos.withColumnsRenamed({"para_id": "right_id", "pos": "rp"}), ["doc_id", "right_id"])
    wrong = F.when(F.col("left_first"), F.col("lp") > F.col("rp")).otherwise(F.col("lp") < F.col("rp"))
    d = both.groupBy("doc_id").agg(F.count("*").alias("n"), F.count_if(wrong).alias("k"))
    mixed = columns.groupBy("doc_id").agg(F.count("*").alias("pages"), F.count_if("interleaved").alias("mixed"))
    value, interleave = _ratio(F.col("k"), F.col("n")), _ratio(F.coalesce("mixed", F.lit(0)), F.col("pages"))
    return _gate(d.join(mixed, "doc_id", "left"), "paragraph_inversion_rate", value, (value <= 0.02) & (interleave <= 0.01))


def citation_coverage(truth: DataFrame, mapped: DataFrame) -> DataFrame:
    """truth (doc_id, anchor_id, expected), mapped (doc_id, anchor_id, ref_key): coverage of the true markers and the
    precision of DOI and PMID keys; a missing key is wrong, keys outside the truth don't count."""
    m = mapped.groupBy("doc_id", "anchor_id").agg(F.collect_set("ref_key").alias("keys"))
    t = truth.join(m, ["doc_id", "anchor_id"], "left").withColumn("hit", F.coalesce(F.array_contains("keys", F.col("expected")), F.lit(False)))
    ident = F.col("expected").rlike("^(doi|pmid):")
    d = t.groupBy("doc_id").agg(F.count("*").alias("n"), F.count_if(F.coalesce(F.size("keys"), F.lit(0)) > 0).alias("k"), F.count_if(ident).alias("di"), F.count_if(ident & F.col("hit")).alias("dk"))
    value = _ratio(F.col("k"), F.col("n"))
    return _gate(d, "citation_mapping_coverage", value, (value >= 0.98) & (_ratio(F.col("dk"), F.col("di")) >= 0.99))


def figure_captions(assets: DataFrame, truth: DataFrame) -> DataFrame:
    """truth (doc_id, asset_id, expected_caption): precision of figures' captions and share of figures with one."""
    f = assets.where("asset_type = 'figure'").join(truth, ["doc_id", "asset_id"], "left")
    known = F.col("expected_caption").isNotNull()
    d = f.groupBy("doc_id").agg(F.count_if(known).alias("n"), F.count_if(known & (F.coalesce("caption_id", F.lit("")) == F.col("expected_caption"))).alias("k"), F.count("*").alias("f"), F.count("caption_id").alias("c"))
    value = _ratio(F.col("k"), F.col("n"))
    return _gate(d, "figure_caption_precision", value, (value >= 0.9) & (_ratio(F.col("c"), F.col("f")) >= 0.95), "DEGRADED")


def silent_truncation(facts: DataFrame) -> DataFrame:
    """Quotes cut without being marked so."""
    d = facts.groupBy("doc_id").agg(F.count_if(F.col("quote").endswith(" ...") & ~F.col("quote_truncated")).cast("double").alias("v"))
    return _gate(d, "silent_truncation_count", F.col("v"), F.col("v") == 0, "DEGRADED")


def reference_quality(references: DataFrame, merged: DataFrame) -> DataFrame:
    """Share of merged records with an identifier; passes with a dedupe rate of .05, measured on identifiers, else on
    comparable PDF records, else on all."""
    ident = (F.coalesce("doi", F.lit("")) != "") | (F.coalesce("pmid", F.lit("")) != "")
    api, pdf = F.col("kind") == "api", F.col("kind") == "pdf"
    raw = references.groupBy("doc_id").agg(F.count_if(api).alias("a"), F.count_if(pdf).alias("p"), F.count_if(api & ident).alias("ai"), F.count_if(pdf & ident).alias("pi"), F.count_if(pdf & (ident | (F.col("year") > 0))).alias("pc"))
    m = merged.groupBy("doc_id").agg(F.count("*").alias("m"), F.count_if(ident).alias("mi"))
    d = raw.join(m, "doc_id", "left").fillna(0)
    part = lambda over, cap: F.when(cap > 0, F.least(F.lit(1.0), F.greatest(F.lit(0), over) / cap))
    rate = F.coalesce(part(F.col("ai") + F.col("pi") - F.col("mi"), F.least("ai", "pi")), part(F.col("a") + F.col("p") - F.col("m"), F.least("a", "pc")), F.greatest(F.lit(0.0), 1 - F.col("m") / (F.col("a") + F.col("p"))))
    value = _ratio(F.col("mi"), F.col("m"))
    return _gate(d, "reference_pipeline_quality", value, (value >= 0.5) & (rate >= 0.05), "DEGRADED")


def report(*gates: DataFrame) -> DataFrame:
    """doc_id, gates, failed, degraded, status: FAIL if a hard gate fails, DEGRADED if another degrades or a hard one
    wasn't evaluated, else PASS. The reference gate is information only."""
    g = reduce(DataFrame.union, gates)
    d = g.groupBy("doc_id").agg(F.count("*").alias("gates"), F.count_if(F.col("status") == "FAIL").alias("failed"), F.count_if((F.col("status") == "DEGRADED") & (F.col("gate") != "reference_pipeline_quality")).alias("degraded"), F.count_if(F.col("gate").isin(*HARD)).alias("hard"))
    return d.select("doc_id", "gates", "failed", "degraded", F.when(F.col("failed") > 0, "FAIL").when((F.col("degraded") > 0) | (F.col("hard") < len(HARD)), "DEGRADED").otherwise("PASS").alias("status"))


def missing_artifacts(expected: DataFrame, observed: DataFrame) -> DataFrame:
    """Expected (doc_id, artifact, key) that weren't observed."""
    return expected.join(observed, ["doc_id", "artifact", "key"], "left_anti")
