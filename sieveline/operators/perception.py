"""Operators over model outputs: image-text alignment, aesthetics, text in images."""

from __future__ import annotations

import os

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.context import Context
from sieveline.functions.scalar import dot, polygon_area
from sieveline.operators.base import ScoreFilter
from sieveline.registry import register_op
from sieveline.sources.embeddings import TEXT_PREFIX, with_vectors


@register_op("clip_score_filter")
class ClipScoreFilter(ScoreFilter):
    """Drops pairs whose image and text vectors do not point the same way."""

    stage, kind, score_key = "perception", "model", "clip_score"

    def __init__(self, model_name: str = "ViT-L-14", threshold: float = 0.20, batch_size: int = 256, max_text_len: int = 77):
        self.model_name, self.threshold, self.batch_size, self.max_text_len = model_name, threshold, batch_size, max_text_len
        self.min_score = threshold

    def score_column(self, df: DataFrame, ctx: Context) -> tuple[DataFrame, Column]:
        df = with_vectors(df, ctx, "_img", "", "image_encoder")
        df = with_vectors(df, ctx, "_txt", TEXT_PREFIX, "text_encoder")
        return df, F.when(F.col("_img").isNotNull() & F.col("_txt").isNotNull(), dot(F.col("_img"), F.col("_txt")))


def collapsed(layers: list[tuple[np.ndarray, np.ndarray]]) -> tuple[list[float], float]:
    """One weight vector and constant that do what a chain of linear layers (weight, bias) without activations does."""
    weight, bias = np.eye(layers[0][0].shape[1]), np.zeros(layers[0][0].shape[1])
    for w, b in layers:
        weight, bias = w @ weight, w @ bias + b
    return [float(v) for v in weight.ravel()], float(bias.ravel()[0])


@register_op("aesthetic_score_filter")
class AestheticScoreFilter(ScoreFilter):
    """Drops images that a linear head over their vectors rates low."""

    stage, kind, score_key = "perception", "model", "aesthetic"

    def __init__(self, weights_path: str | None = None, min_score: float = 4.5, model_name: str = "ViT-L-14", batch_size: int = 512):
        self.weights_path, self.min_score, self.model_name, self.batch_size = weights_path, min_score, model_name, batch_size

    def head(self, ctx: Context):
        """vec Column -> score Column.  The provider aesthetic_head, or an .npz of weights w0, b0, w1, b1, ..."""
        given = ctx.providers.get("aesthetic_head")
        if given is not None:
            return given
        if not self.weights_path or not os.path.exists(self.weights_path):
            raise FileNotFoundError(f"no aesthetic weights at {self.weights_path!r}")
        stored = np.load(self.weights_path)
        weight, bias = collapsed([(stored[f"w{i}"], stored[f"b{i}"]) for i in range(len(stored.files) // 2)])
        return lambda vec: dot(vec, F.lit(weight)) + bias

    def score_column(self, df: DataFrame, ctx: Context) -> tuple[DataFrame, Column]:
        head = self.head(ctx)
        df = with_vectors(df, ctx, "_img", "", "image_encoder")
        return df, F.when(F.col("_img").isNotNull(), head(F.col("_img")))


def text_share(polygons: Column, width: Column, height: Column) -> Column:
    """Share of an image that polygons of text cover: areas added, overlaps twice, 1 at most; 0 without polygons."""
    usable = F.filter(F.coalesce(polygons, F.array().cast("array<array<array<double>>>")), lambda p: F.coalesce(F.forall(p, lambda q: F.coalesce(F.size(q) >= 2, F.lit(False))), F.lit(False)))
    total = F.aggregate(F.transform(usable, polygon_area), F.lit(0.0), lambda acc, a: acc + a)
    return F.when((width > 0) & (height > 0), F.least(F.lit(1.0), total / F.nullif(width.cast("double") * height, F.lit(0.0))))


@register_op("ocr_density_filter")
class OcrDensityFilter(ScoreFilter):
    """Drops images that are mostly text."""

    stage, kind, score_key = "perception", "model", "text_area_ratio"

    def __init__(self, max_text_ratio: float = 0.25, lang: str = "en", batch_size: int = 32, det_only: bool = True):
        self.max_text_ratio, self.lang, self.batch_size, self.det_only = max_text_ratio, lang, batch_size, det_only
        self.max_score = max_text_ratio

    def score_column(self, df: DataFrame, ctx: Context) -> tuple[DataFrame, Column]:
        """The provider text_detector gets the rows alive and gives (row_idx, polygons, width, height, failed)."""
        detector = ctx.providers.get("text_detector")
        if detector is None:
            raise RuntimeError("ocr_density_filter needs a provider text_detector")
        found = detector(df.filter("keep")).select("row_idx", F.col("polygons").alias("_polygons"), F.col("width").alias("_w"), F.col("height").alias("_h"), F.col("failed").alias("_failed"))
        df = df.join(found, "row_idx", "left")
        return df, F.when(~F.coalesce(F.col("_failed"), F.lit(True)), text_share(F.col("_polygons"), F.col("_w"), F.col("_h")))
