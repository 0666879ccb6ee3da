"""Concatenate and cut: documents' tokens, one after another, cut into fixed windows.

Pass 1 tokenizes each input partition in order, notes every document's offset in its partition, and writes the tokens
once to the shared folder. The partitions' totals (one row each) give the partitions' global offsets by a prefix sum;
pass 2 adds them to the documents' offsets and cuts every document at the windows it crosses. Sequences are full but
for the last one.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import give_back, steps, texts
from .common import cut, table

LENGTH = 2048
END_ID = 1
#: Global offsets, one 12-byte row for each input partition, are broadcast up to this many; more are joined by shuffle.
MAX_BROADCAST_PARTS = 1_000_000


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def tokenize(docs: DataFrame, path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """part, start, doc_id, n, ids: each document's packed ids with end_id after them; start counts the tokens before
    it in its partition. Null texts are empty: end_id alone."""
    path = path or default_tokenizer()
    schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("n", T.LongType()), T.StructField("ids", T.BinaryType())])

    def run(batches):
        from pyspark import TaskContext

        from .tokens import encoder as encoder_of

        part, at, encoder, end = TaskContext.get().partitionId(), 0, encoder_of(path), int(end_id).to_bytes(4, "little")
        for batch in batches:
            for step in steps(batch, 1):
                ids = [encoder.encode(t.decode()) + end for t in step.column(1).to_pylist()]
                sizes = [len(x) // 4 for x in ids]
                starts = []
                for n in sizes:
                    starts.append(at)
                    at += n
                yield pa.RecordBatch.from_arrays([pa.array([part] * len(ids), pa.int32()), pa.array(starts, pa.int64()), step.column(0), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary())], schema.names)
        give_back()

    return texts(docs).mapInArrow(run, schema)


def pack(docs: DataFrame, path: str | None = None, length: int = LENGTH, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """One row per piece of a document: doc_id, start (its document's ids before it), length, ids_crc32, doc_tokens,
    sequence_id, offset (in the sequence); with keep_ids also the packed ids.

    Documents keep the order of their partitions. Empty input gives no rows; repeated rows are packed as often as they
    occur; only doc_id and text are read.
    """
    tokens = cut(tokenize(docs, path, end_id))
    totals = tokens.groupBy("part").agg(F.sum("n").alias("total"))
    before = F.sum("total").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    bases = totals.select("part", F.coalesce(before, F.lit(0)).alias("base"))
    bases = cut(bases)
    if bases.count() <= MAX_BROADCAST_PARTS:
        bases = F.broadcast(bases)
    placed = tokens.join(bases, "part").withColumn("first", F.col("base") + F.col("start"))
    windows = F.sequence(F.expr(f"first div {length}"), F.expr(f"(first + n - 1) div {length}"))
    cutting = placed.select("doc_id", "n", "ids", "first", F.explode(windows).alias("sequence_id"))
    begin = F.greatest(F.col("first"), F.col("sequence_id") * length)
    end = F.least(F.col("first") + F.col("n"), (F.col("sequence_id") + 1) * length)
    pieces = cutting.select("doc_id", (begin - F.col("first")).alias("start"), (end - begin).alias("length"), F.col("n").alias("doc_tokens"), "sequence_id", (begin - F.col("sequence_id") * length).alias("offset"), "ids")
    piece = F.expr("substring(ids, cast(start * 4 + 1 as int), cast(length * 4 as int))")
    out = pieces.withColumn("ids", piece).withColumn("ids_crc32", F.crc32("ids"))
    cols = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return out.select(*cols, *(["ids"] if keep_ids else []))


def op8_concatenate_and_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
