"""JSON-lines artifacts, tolerant and strict, keyed reads, and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_tolerant(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Rows that parse; malformed lines are dropped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def read_strict(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Fails on the first malformed line."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_documents(spark: SparkSession, glob: str, schema: StructType) -> DataFrame:
    """One JSON document for each file, with the file's name; where two files hold one page the later name wins (schemas
    without a page keep all)."""
    rows = spark.read.schema(schema).option("multiLine", True).json(glob).withColumn("file", F.input_file_name())
    return last_wins(rows, *[c for c in ("doc_id", "page") if c in schema.names], order="file") if "page" in schema.names else rows


def last_wins(rows: DataFrame, *keys: str, order: str) -> DataFrame:
    return rows.withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(F.desc(order)))).where("_n = 1").drop("_n")


def write_lines(df: DataFrame, path: str, append: bool = False) -> None:
    df.write.mode("append" if append else "overwrite").json(path)


def write_notes(notes: DataFrame, path: str) -> None:
    """notes (text): one text file row for each note."""
    notes.select("text").write.mode("overwrite").text(path)


def with_hook(rows: DataFrame, key: str, hook=None, fallback=None) -> DataFrame:
    """rows with the answers of an external call, made once for each different key, or the fallback's without one.
    hook and fallback take and give a DataFrame keyed by `key`."""
    asked = rows.select(key).distinct()
    answered = (hook or fallback)(asked)
    return rows.join(answered, key, "left")
