"""Boxes x0, y0, x1, y1 as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def overlap(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(a1, b1) - F.greatest(a0, b0))


def x_overlap_ratio(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    """Of the narrower of two boxes, at least one point wide."""
    return overlap(a0, a1, b0, b1) / F.greatest(F.lit(1.0), F.least(a1 - a0, b1 - b0))


def inside(x: Column, y: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return (x >= x0) & (x <= x1) & (y >= y0) & (y <= y1)


def to_pixels(v: Column, dpi: int, scale: float) -> Column:
    """Points to pixels, truncating."""
    return (v * F.lit(dpi / 72.0 * scale)).cast("int")
