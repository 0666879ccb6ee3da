"""Fault events as a stream: an addition to the batch summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.telemetry import DEDUPE, enrich, failures


def fault_counts(events: DataFrame, delay: str = "10 minutes", window: str = "1 hour") -> DataFrame:
    """Failures by window and category, repeated ones within the delay counted once. Works on streams and tables."""
    f = failures(enrich(events)).withColumn("observed_at", F.col("observed_at").cast("timestamp")).withWatermark("observed_at", delay)
    once = f.dropDuplicatesWithinWatermark(["attempt_id", *DEDUPE]) if f.isStreaming else f.dropDuplicates(["attempt_id", *DEDUPE])
    return once.groupBy(F.window("observed_at", window), "category").agg(F.count("*").alias("n"))
