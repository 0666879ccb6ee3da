"""Measures of pictures."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, StructField, StructType

WHITE = 245


def histogram_measures(images: DataFrame, key: str = "image_id", gray: str = "gray") -> DataFrame:
    """key, white_ratio (pixels of WHITE or more), entropy (bits) of pictures given as bytes, one for each gray pixel.
    Empty and null pictures have 0 for both."""

    def run(batches):
        for batch in batches:
            out = []
            for data in batch.column(1):
                n = np.bincount(np.frombuffer(data.as_py() or b"", np.uint8), minlength=256)
                p = n[n > 0] / max(1, n.sum())
                out.append((float(n[WHITE:].sum() / max(1, n.sum())), float(-(p * np.log2(p)).sum() + 0.0)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([a for a, _ in out], pa.float64()), pa.array([b for _, b in out], pa.float64())], [key, "white_ratio", "entropy"])

    schema = StructType([images.schema[key], StructField("white_ratio", DoubleType()), StructField("entropy", DoubleType())])
    return images.select(key, gray).mapInArrow(run, schema)
