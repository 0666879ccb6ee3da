"""Arrow helpers for operators that work on batches in Python."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Bytes of text that one step of a batch operator holds at most, beside one single longer text.
STEP_BYTES = 4 << 20


def give_back() -> None:
    """Returns free memory to the system; at the end of a task, as workers live on and others need it."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def steps(batch: pa.RecordBatch, column: int, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """batch in slices whose binary column holds at most limit bytes (a longer value stands alone)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if batch.num_rows > start:
        yield batch.slice(start)


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], list[pa.Array]]], schema: StructType, column: int = 1, limit: int = STEP_BYTES) -> DataFrame:
    """df.mapInArrow with bounded steps. make() is called once in each task, so that state is built there."""
    names = schema.names

    def run(batches):
        f = make()
        for batch in batches:
            for step in steps(batch, column, limit):
                arrays = f(step)
                if arrays and len(arrays[0]):
                    yield pa.RecordBatch.from_arrays(arrays, names)
        give_back()

    return df.mapInArrow(run, schema)


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, text as UTF-8 bytes (null: empty) and further columns."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"), *more)
