"""Figures, tables and their captions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.geometry import overlap


def dedupe_assets(assets: DataFrame) -> DataFrame:
    """Per asset_id the entry with a caption id, then a caption text, then the higher confidence (ties: the later);
    then the same per (type, page, caption), where the earlier of two equals stays."""
    strength = lambda order: [F.col("caption_id").isNotNull().desc(), (F.coalesce("caption_text", F.lit("")) != "").desc(), F.desc("confidence"), order]
    one = assets.withColumn("n", F.row_number().over(W.partitionBy("doc_id", "asset_id").orderBy(*strength(F.desc("ord"))))).where("n = 1")
    caption = F.coalesce(F.lower(F.trim("caption_id")), F.lower(F.trim(F.substring(F.coalesce("caption_text", F.lit("")), 1, 160))))
    w = W.partitionBy("doc_id", "asset_type", "page", caption).orderBy(*strength(F.asc("asset_id")))
    return one.withColumn("n", F.row_number().over(w)).where("n = 1").drop("n")


def image_captions(images: DataFrame, captions: DataFrame) -> DataFrame:
    """image_id, caption_id: on the image's page the caption whose top is from 50 above to 220 below the image's
    bottom, with an x overlap of at least .15 of the image, nearest first (ties: the first caption)."""
    d = F.col("cy0") - F.col("iy1")
    share = overlap(F.col("ix0"), F.col("ix1"), F.col("cx0"), F.col("cx1")) / F.greatest(F.lit(1.0), F.col("ix1") - F.col("ix0"))
    near = images.join(captions, ["doc_id", "page"]).where((d >= -50) & (d < 220) & (share >= 0.15))
    return near.groupBy("doc_id", "image_id").agg(F.min_by("caption_id", F.struct(F.abs(d), "c_ord")).alias("caption_id"))


def missing_assets(captions: DataFrame, assets: DataFrame) -> DataFrame:
    """Captions that no asset carries."""
    return captions.join(assets.where("caption_id is not null").select("doc_id", "caption_id"), ["doc_id", "caption_id"], "left_anti")


def caption_tails(bodies: DataFrame, captions: DataFrame) -> DataFrame:
    """doc_id, para_id, caption_id, score: the caption on its page that a body may continue. It starts no more than 20
    above the caption's top and 120 below its bottom; little x overlap (under .1) needs a place right of the caption or
    a gap of at most 40. Least gap - 40 * overlap counts, ties to the caption read first."""
    gap = F.greatest(F.lit(0.0), F.col("y0") - F.col("cy1"))
    share = overlap(F.col("x0"), F.col("x1"), F.col("cx0"), F.col("cx1")) / F.greatest(F.lit(1.0), F.least(F.col("x1") - F.col("x0"), F.col("cx1") - F.col("cx0")))
    fits = (F.col("y0") >= F.col("cy0") - 20) & (gap <= 120) & ((share >= 0.1) | (F.col("x0") >= F.col("cx1") - 20) | (gap <= 40))
    near = bodies.join(captions, ["doc_id", "page"]).where(fits).withColumn("score", gap - share * 40)
    best = near.groupBy("doc_id", "para_id").agg(F.min_by(F.struct("caption_id", F.round("score", 6).alias("score")), F.struct("score", "c_ord")).alias("_best"))
    return best.select("doc_id", "para_id", "_best.*")


def caption_reviews(bodies: DataFrame, captions: DataFrame, most: int = 3) -> DataFrame:
    """The `most` bodies of each page that most look like a caption's continuation: gap at most 260, x overlap of .05
    or a place right of the caption; ordered by gap - 80 * overlap, then reading order."""
    gap = F.greatest(F.lit(0.0), F.col("y0") - F.col("cy1"))
    share = overlap(F.col("x0"), F.col("x1"), F.col("cx0"), F.col("cx1")) / F.greatest(F.lit(1.0), F.least(F.col("x1") - F.col("x0"), F.col("cx1") - F.col("cx0")))
    near = bodies.join(captions, ["doc_id", "page"]).where((gap <= 260) & ((share >= 0.05) | (F.col("x0") >= F.col("cx1") - 24))).withColumn("score", gap - share * 80)
    best = near.groupBy("doc_id", "page", "para_id", "ord").agg(F.min_by(F.struct("caption_id", F.round("score", 6).alias("score")), F.struct("score", "c_ord")).alias("_best"))
    ranked = best.select("doc_id", "page", "para_id", "ord", "_best.*").withColumn("rank", F.row_number().over(W.partitionBy("doc_id", "page").orderBy("score", "ord")))
    return ranked.where(F.col("rank") <= most).drop("ord")
