"""Shared pieces of the training-data operators: tables, durable cuts of lineage, connected components."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Where that is unset a temporary one is made in local mode
    (tests), where there are no other machines; elsewhere that is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = getattr(shared_dir, "own", None) or tempfile.mkdtemp(prefix="foliospark-")
        shared_dir.own = root
    return root.rstrip("/")


#: Spark deletes an execution's shuffle files when it ends, not when the driver happens to collect garbage.
_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame, compression: str = "zstd") -> DataFrame:
    """Writes df as Parquet to the shared folder and reads it again: lineage ends there, lost executors cost nothing.
    The plan isn't run again, so its shuffle files go once the table is whole. The files stay as long as a later plan
    may read them: drop_cut() deletes one table, drop_cuts() all of this application's when its job is done."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cut-{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"
    before = spark.conf.get(_TIDY, None)
    spark.conf.set(_TIDY, "true")
    try:
        df.write.option("compression", compression).parquet(path)
    finally:
        spark.conf.set(_TIDY, before) if before else spark.conf.unset(_TIDY)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def _delete(spark: SparkSession, pattern: str) -> None:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(pattern)
    files = p.getFileSystem(spark._jsc.hadoopConfiguration())
    for found in files.globStatus(p) or []:
        files.delete(found.getPath(), True)


def drop_cut(df: DataFrame) -> None:
    """Deletes the files of a cut that no later plan reads."""
    if path := getattr(df, "_cut_path", None):
        _delete(df.sparkSession, path)


def drop_cuts(spark: SparkSession) -> None:
    """Deletes what this application's cuts have left; for the end of a job, when its results are written."""
    _delete(spark, f"{shared_dir(spark)}/cut-{spark.sparkContext.applicationId}-*")


def free(df: DataFrame, name: str) -> str:
    """name, with underscores before it until no column of df has it, upper and lower case alike."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def let(value: Column, body) -> Column:
    """body(value) with value evaluated once, also where body uses it many times."""
    return F.transform(F.array(value), body)[0]


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected edges (u, v: long): rows (node, component), component the smallest node.

    Alternating large-star and small-star rounds (Kiveris et al., 2014). Every round is two aggregations with partial
    sums and two equi joins whose hot side adaptive execution can split; edges never reach the driver, only a count and
    a checksum do. Self loops and nulls are dropped; nodes without a proper edge are absent; no edges give no rows.
    """
    hi, lo = F.greatest("u", "v"), F.least("u", "v")
    now = cut(edges.where("u is not null and v is not null and u <> v").select(hi.alias("u"), lo.alias("v")).distinct())
    sign = lambda df: tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    last = sign(now)
    while last[0]:
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        below = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(below, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        nxt = cut(small.union(below.select("u", F.col("m").alias("v"))).distinct())
        mark = sign(nxt)
        drop_cut(now)
        now = nxt
        if mark == last:
            break
        last = mark
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
