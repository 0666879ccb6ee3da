"""Fault events: classification, de-duplicated summary, KPI roll-up and comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .reading import any_of


def enrich(events: DataFrame) -> DataFrame:
    """events (stage, fault, error_type, http_status, success, status, fallback_used) with category, root_cause_class,
    retryability, retryable, degraded_output_used. The first rule that holds decides."""
    e, f, s = F.lower(F.coalesce("error_type", F.lit(""))), F.lower(F.coalesce("fault", F.lit(""))), F.col("http_status")
    auth = ("config/auth", "missing_credentials", "non_retryable")
    slow = ("timeout/retry", "transient_timeout_or_network", "retryable")
    parse = ("parse/validation", "parse_or_validation", "non_retryable")
    rules = (
        (F.coalesce("success", F.lit(False)) & e.isin("", "none"), ("none", "none", "not_applicable")),
        (any_of(e, ("missing_api_key", "credential", "auth", "token")), auth),
        (any_of(e, ("invalid_endpoint",)), ("config/auth", "invalid_configuration", "non_retryable")),
        (any_of(f, ("missing-api-key", "auth")), auth),
        (F.coalesce(s == 400, F.lit(False)) | any_of(e, ("request_contract",)), ("request-contract", "request_contract", "non_retryable")),
        (F.coalesce(s.isin(408, 429, 500, 502, 503, 504), F.lit(False)) | any_of(e, ("transient_http_error",)), slow),
        (any_of(e, ("timeout", "url_error", "network_error")) | any_of(f, ("timeout",)), slow),
        (any_of(e, ("parse", "schema", "validation")) | any_of(f, ("parse", "invalid-model-output")), parse),
    )
    of = lambda x: F.struct(*(F.lit(v).alias(n) for v, n in zip(x, ("category", "root_cause_class", "retryability"), strict=True)))
    out = of(("parse/validation", "unknown", "unknown"))
    for test, x in reversed(rules):
        out = F.when(test, of(x)).otherwise(out)
    degraded = F.coalesce("fallback_used", F.lit(False)) | (F.lower(F.coalesce("status", F.lit(""))) == "degraded")
    return events.withColumn("_c", out).select(*events.columns, "_c.*").withColumn("retryable", F.col("retryability") == "retryable").withColumn("degraded_output_used", degraded)


def failures(enriched: DataFrame) -> DataFrame:
    return enriched.where((F.lower(F.coalesce("status", F.lit(""))) == "degraded") | ~F.coalesce("success", F.lit(True)) | ~F.lower(F.trim(F.coalesce("error_type", F.lit("")))).isin("", "none"))


DEDUPE = ("stage", "fault", "page", "error_type", "http_status", "category", "root_cause_class", "retryability")


def fault_summary(enriched: DataFrame) -> DataFrame:
    """attempt_id, dimension, value, n_raw, n_deduped, first_at, last_at by category, root cause and retryability: one
    pass over the de-duplicated failures with grouping sets."""
    f = failures(enriched).groupBy("attempt_id", *DEDUPE).agg(F.count("*").alias("n"), F.min("observed_at").alias("a"), F.max("observed_at").alias("b"))
    dims = F.explode(F.array(*(F.struct(F.lit(c).alias("dimension"), F.col(c).alias("value")) for c in ("category", "root_cause_class", "retryability"))))
    return f.select("attempt_id", dims.alias("d"), "n", "a", "b").groupBy("attempt_id", "d.dimension", "d.value").agg(F.sum("n").alias("n_raw"), F.count("*").alias("n_deduped"), F.min("a").alias("first_at"), F.max("b").alias("last_at"))


def kpis(enriched: DataFrame, run: str = "run") -> DataFrame:
    """run, n_attempts, failures, timeout_rate, degraded_rate (share of attempts with a failure)."""
    f = failures(enriched)
    by = f.groupBy(run).agg(F.count("*").alias("failures"), F.count_if(F.col("category") == "timeout/retry").alias("timeouts"), F.countDistinct("attempt_id").alias("bad"))
    n = enriched.groupBy(run).agg(F.countDistinct("attempt_id").alias("n_attempts"))
    return n.join(by, run, "left").fillna(0).select(run, "n_attempts", "failures", F.when(F.col("failures") > 0, F.round(F.col("timeouts") / F.col("failures"), 6)).otherwise(0.0).alias("timeout_rate"), F.round(F.col("bad") / F.col("n_attempts"), 6).alias("degraded_rate"))


def kpi_delta(k: DataFrame, before: str, after: str) -> DataFrame:
    """after minus before, one row for each measure."""
    long = k.select("run", F.explode(F.array(*(F.struct(F.lit(c).alias("kpi"), F.col(c).cast("double").alias("v")) for c in ("failures", "timeout_rate", "degraded_rate")))).alias("x")).select("run", "x.*")
    side = lambda r: F.sum(F.when(F.col("run") == r, F.col("v")))
    return long.groupBy("kpi").agg(F.round(side(after) - side(before), 6).alias("delta"))


def budgeted(requests: DataFrame, key: str, order: str, budget: int) -> DataFrame:
    """The first `budget` requests of each key: what a bounded external call may see."""
    return requests.withColumn("_n", F.row_number().over(W.partitionBy(key).orderBy(order))).where(F.col("_n") <= budget).drop("_n")
