"""Samples from raw annotations, and synthetic ones."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.plans.order import first_rows, order_key, renumbered
from sieveline.plans.sft import extract_text
from sieveline.schema import as_samples
from sieveline.sources.images import PICTURES_AT_ONCE


def prepared(raw: DataFrame, n: int, seed: int = 42, source: str = "raw", existing: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The first ``n`` usable rows of (row_idx, id, image, conversations) in shuffled order as samples, and (status, n) of all rows.

    Rows without image, with an image that ``existing`` (image_path) lacks, or without text are left out.
    """
    rows = raw.withColumn("text", extract_text(F.col("conversations")))
    there = F.lit(True)
    if existing is not None:
        rows = rows.join(existing.select(F.col("image_path").alias("_there")).distinct(), F.col("image") == F.col("_there"), "left")
        there = F.col("_there").isNotNull()
    status = F.when(F.coalesce(F.col("image"), F.lit("")) == "", F.lit("no_image")).when(~there, F.lit("missing_file")).when(F.col("text") == "", F.lit("no_text")).otherwise(F.lit("ok"))
    rows = rows.withColumn("status", status).withColumn("_order", order_key(seed))
    good = first_rows(rows.filter("status = 'ok'"), n, "_order", "row_idx")
    meta = F.create_map(F.lit("source"), F.to_json(F.array(F.lit(source))).substr(F.lit(2), F.length(F.to_json(F.array(F.lit(source)))) - 2), F.lit("is_noise"), F.lit("false"))
    made = good.select("row_idx", F.col("id").cast("string").alias("id"), F.col("image").alias("image_path"), "text", "conversations", meta.alias("meta"), "_order", F.lit(0).alias("_part"))
    return as_samples(renumbered(made)), rows.groupBy("status").agg(F.count("*").alias("n"))


def distinct_images(samples: DataFrame) -> DataFrame:
    """(image_path, row_idx) of the images that are referred to, with the row of first mention."""
    return samples.filter("coalesce(image_path, '') <> ''").groupBy("image_path").agg(F.min("row_idx").alias("row_idx"))


#: What synthetic images show: regular polygons and stars by their number of corners, in hues a twelfth of a circle apart, on grounds from dark to light.
CORNERS = {"triangle": (3, 1.0), "diamond": (4, 1.0), "pentagon": (5, 1.0), "hexagon": (6, 1.0), "five-pointed star": (5, 0.45), "eight-pointed star": (8, 0.6)}
HUES = tuple(f"{30 * i}-degree" for i in range(12))
GROUNDS = ("dark", "dim", "pale", "light")


def hue_rgb(degrees: float, value: float = 0.9, chroma: float = 0.7) -> tuple[int, int, int]:
    """The colour of a hue, from the usual hexagon of hues."""
    import colorsys

    return tuple(round(255 * c) for c in colorsys.hsv_to_rgb(degrees / 360, chroma, value))


def drawing(shape: str, hue: str, ground: str, size: int, cx: float, cy: float, radius: float, turn: float = 0.0) -> np.ndarray:
    """A shape on a shaded ground with a faint texture, so that no part of the picture is without detail."""
    y, x = np.mgrid[0:size, 0:size].astype(float)
    n, inner = CORNERS[shape]
    angle = np.mod(np.arctan2(y - cy, x - cx) - turn, 2 * np.pi / n)
    # between a corner at the radius and the next notch (of a star) or side's middle (of a polygon)
    half, low = np.pi / n, inner * np.cos(np.pi / n) if inner == 1.0 else inner
    a = np.minimum(angle, 2 * half - angle)
    edge = radius * low * np.sin(half) / (np.sin(half - a) * low + np.sin(a))
    inside = np.hypot(x - cx, y - cy) <= edge
    level = 40 + 60 * GROUNDS.index(ground)
    shade = level + 20 * (x + y) / (2 * size)
    texture = 12 * np.sin(x * 1.9) * np.cos(y * 2.3)
    out = np.repeat((shade + texture)[:, :, None], 3, axis=2)
    out[inside] = np.array(hue_rgb(float(hue.split("-")[0]))) + texture[inside][:, None]
    return np.clip(np.rint(out), 0, 255).astype(np.uint8)


def synthetic(spark: SparkSession, n: int, seed: int = 0) -> DataFrame:
    """``n`` samples of one coloured shape each, with captions; image files are made by :func:`synthetic_images`."""
    pick = lambda names, salt: F.get(F.array(*map(F.lit, names)), F.pmod(F.floor(order_key(seed, "id") / salt), F.lit(len(names))).cast("int"))
    rows = spark.range(n).select("id", pick(HUES, 1).alias("color"), pick(list(CORNERS), 13).alias("shape"), pick(GROUNDS, 101).alias("ground"))
    text = F.format_string("On %s ground there is a %s of %s hue, the one with number %d.", "ground", "shape", "color", "id")
    name = F.format_string("shape_%07d", F.col("id"))
    turns = F.array(F.struct(F.lit("human").alias("from"), F.lit("Describe this picture.").alias("value")), F.struct(F.lit("gpt").alias("from"), text.alias("value")))
    quoted = lambda c: F.concat(F.lit('"'), F.col(c), F.lit('"'))
    meta = F.create_map(F.lit("shape"), quoted("shape"), F.lit("color"), quoted("color"), F.lit("ground"), quoted("ground"))
    return as_samples(rows.select(F.col("id").alias("row_idx"), name.alias("id"), F.concat(name, F.lit(".png")).alias("image_path"), text.alias("text"), turns.alias("conversations"), meta.alias("meta")))


def synthetic_images(samples: DataFrame, size: int = 256) -> DataFrame:
    """(name, width, height, rgb) of synthetic samples, for the PNG writer."""

    def draw(batches):
        import json

        import pandas as pd

        for b in (whole.iloc[at : at + PICTURES_AT_ONCE] for whole in batches for at in range(0, len(whole), PICTURES_AT_ONCE)):
            rgb = []
            for i, m in zip(b["row_idx"], b["meta"], strict=True):
                m = {k: json.loads(v) for k, v in dict(m).items()}
                dice = np.random.default_rng(int(i))
                cx, cy, r, turn = dice.uniform((0.3, 0.3, 0.15, 0.0), (0.7, 0.7, 0.3, 1.5))
                rgb.append(drawing(m["shape"], m["color"], m["ground"], size, size * cx, size * cy, size * r, turn).tobytes())
            yield pd.DataFrame({"name": b["image_path"], "width": size, "height": size, "rgb": rgb})

    return samples.select("row_idx", "image_path", "meta").mapInPandas(draw, "name string, width int, height int, rgb binary")
