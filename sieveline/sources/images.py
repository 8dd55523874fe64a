"""Images as DataFrames: header sizes, pixels, measures over pixels, PNG writing."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.context import Context
from sieveline.plans.order import order_key
from sieveline.storage import bound_batches, written

#: Fixed value: files below this size are no images.
LEAST_BYTES = 1024
#: Rows with pixels that are made, or decoded from a table of our own, at a time.
PICTURES_AT_ONCE = 64


def header_size(data: bytes) -> tuple[int, int] | None:
    """(width, height) from the first bytes of a PNG, GIF, BMP, WebP or JPEG file; None if they say nothing."""
    try:
        if data[:8] == b"\x89PNG\r\n\x1a\n":
            return struct.unpack(">II", data[16:24])
        if data[:6] in (b"GIF87a", b"GIF89a"):
            return struct.unpack("<HH", data[6:10])
        if data[:2] == b"BM":
            w, h = struct.unpack("<ii", data[18:26])
            return w, abs(h)
        if data[:4] == b"RIFF" and data[8:12] == b"WEBP":
            kind = data[12:16]
            if kind == b"VP8X":
                return int.from_bytes(data[24:27], "little") + 1, int.from_bytes(data[27:30], "little") + 1
            if kind == b"VP8L":
                bits = int.from_bytes(data[21:25], "little")
                return (bits & 0x3FFF) + 1, (bits >> 14 & 0x3FFF) + 1
            w, h = struct.unpack("<HH", data[26:30])
            return w & 0x3FFF, h & 0x3FFF
        if data[:2] == b"\xff\xd8":
            at = 2
            while at + 9 < len(data):
                if data[at] != 0xFF:
                    return None
                mark = data[at + 1]
                if mark == 0xFF or 0xD0 <= mark <= 0xD9 or mark == 1:
                    at += 1 if mark == 0xFF else 2
                elif 0xC0 <= mark <= 0xCF and mark not in (0xC4, 0xC8, 0xCC):
                    h, w = struct.unpack(">HH", data[at + 5 : at + 9])
                    return w, h
                else:
                    at += 2 + int.from_bytes(data[at + 2 : at + 4], "big")
    except struct.error:
        pass
    return None


def _sizes(content: pd.Series) -> pd.DataFrame:
    found = [header_size(bytes(c)) if c is not None else None for c in content]
    return pd.DataFrame({"width": pd.array([f[0] if f else None for f in found], "Int32"), "height": pd.array([f[1] if f else None for f in found], "Int32")})


def header_sizes(content: Column) -> Column:
    """A struct (width, height) from the first bytes of image files; nulls where they say nothing."""
    return F.pandas_udf(_sizes, "struct<width:int,height:int>")(content)


def _as_path(column):
    """The file part of a URI as Spark's file sources give it, for local and absolute paths alike."""
    return F.regexp_replace(column, "^file:/+", "/")


def size_table(ctx: Context, folder: str) -> DataFrame:
    """(image_file, width, height) of all files below ``folder``, by their headers; null for unreadable ones."""
    files = ctx.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    sized = files.select(_as_path(F.col("path")).alias("image_file"), header_sizes(F.col("content")).alias("s"))
    return sized.select("image_file", "s.width", "s.height")


def pixel_table(ctx: Context, folder: str) -> DataFrame:
    """(image_file, width, height, n_channels, data) of all images below ``folder``; width and height null where decoding fails."""
    images = ctx.spark.read.format("image").option("dropInvalid", "false").option("recursiveFileLookup", "true").load(folder).select("image.*")
    good = F.col("width") > 0
    return images.select(_as_path(F.col("origin")).alias("image_file"), F.when(good, F.col("width")).alias("width"), F.when(good, F.col("height")).alias("height"), F.col("nChannels").alias("n_channels"), "data")


def with_sizes(df: DataFrame, ctx: Context) -> DataFrame:
    """``df`` with _width and _height of its images (null: no path, no file or unreadable)."""
    table = ctx.images.select("image_file", "width", "height") if ctx.images is not None else size_table(ctx, ctx.image_root)
    sizes = table.select(F.col("image_file").alias("_file"), F.col("width").alias("_width"), F.col("height").alias("_height"))
    return df.join(sizes, ctx.resolve_image() == F.col("_file"), "left").drop("_file")


def picked(table: DataFrame, names: DataFrame, at_once: int = 500_000) -> DataFrame:
    """The inner join of ``table`` with ``names`` by image_file, whatever the pixels in ``table`` weigh: they stay where they are.

    ``names`` is broadcast, at most about ``at_once`` rows at a time; with more, ``table`` is read as often as that takes.
    """
    bound_batches(table.sparkSession)
    names = written(names.filter("image_file is not null"), "names")
    parts = max(1, -(-names.count() // at_once))
    out = None
    for i in range(parts):
        own = names.filter(F.pmod(F.xxhash64(*names.columns), F.lit(parts)) == i) if parts > 1 else names
        part = table.join(F.broadcast(own), "image_file")
        out = part if out is None else out.unionByName(part)
    return out


def with_measure(df: DataFrame, ctx: Context, name: str, measure: Callable, kind: str) -> DataFrame:
    """``df`` with ``measure`` over the pixels of its image, null without readable image.

    Only images of rows alive are measured, each image once.  Files are decoded by Spark's image source, which opens
    every image below the folder; where a run looks at few of them, give their pixels in the context instead.
    """
    table = ctx.images if ctx.images is not None else pixel_table(ctx, ctx.image_root)
    df = written(df, "measured")  # both sides of the join read it
    wanted = df.filter("keep").select(ctx.resolve_image().alias("image_file")).distinct()
    run = F.pandas_udf(measure, kind)
    found = picked(table.filter("width > 0"), wanted)
    found = written(found.select(F.col("image_file").alias("_file"), run("width", "height", "n_channels", "data").alias(name)), "measures")
    return df.join(found, ctx.resolve_image() == F.col("_file"), "left").drop("_file")


# ---------------------------------------------------------------- pixels


def gray(width: int, height: int, channels: int, data: bytes) -> np.ndarray:
    """Luma of rows of gray, BGR or BGRA bytes, rounded to whole values."""
    pixels = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    if channels == 1:
        return pixels[:, :, 0].astype(np.int64)
    b, g, r = (pixels[:, :, i].astype(np.int64) for i in range(3))
    return (r * 299 + g * 587 + b * 114 + 500) // 1000


def _cubic(x: np.ndarray) -> np.ndarray:
    a, x = -0.5, np.abs(x)
    return np.where(x < 1, ((a + 2) * x - (a + 3)) * x * x + 1, np.where(x < 2, (((x - 5) * x + 8) * x - 4) * a, 0.0))


def _lanczos(x: np.ndarray) -> np.ndarray:
    return np.where(np.abs(x) < 3, np.sinc(x) * np.sinc(x / 3), 0.0)


#: Kernels and how far they reach.
KERNELS = {"cubic": (_cubic, 2.0), "lanczos": (_lanczos, 3.0)}


def _weights(old: int, new: int, kernel: str) -> np.ndarray:
    """Row i: the shares of the old positions in new position i; the kernel widens when shrinking."""
    shape, reach = KERNELS[kernel]
    scale = max(1.0, old / new)
    centre = (np.arange(new) + 0.5) * old / new
    at = np.arange(old) + 0.5
    far = np.abs(at[None, :] - centre[:, None])
    w = np.where(far < reach * scale, shape((at[None, :] - centre[:, None]) / scale), 0.0)
    return w / w.sum(axis=1, keepdims=True)


def resized(pixels: np.ndarray, width: int, height: int, kernel: str) -> np.ndarray:
    """Rows and columns resampled, rounded to 0..255."""
    out = np.rint(np.clip(pixels @ _weights(pixels.shape[1], width, kernel).T, 0, 255))
    return np.rint(np.clip(_weights(pixels.shape[0], height, kernel) @ out, 0, 255))


def laplacian_variance(pixels: np.ndarray) -> float:
    """Population variance of the 4-neighbour Laplacian over inner pixels; 0 under three pixels a side."""
    if min(pixels.shape) < 3:
        return 0.0
    p = pixels.astype(float)
    return float((p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * p[1:-1, 1:-1]).var())


def blur_measure(resize_to: int) -> Callable:
    def measure(width: pd.Series, height: pd.Series, channels: pd.Series, data: pd.Series) -> pd.Series:
        out = []
        for w, h, c, d in zip(width, height, channels, data, strict=True):
            p = gray(w, h, c, d)
            if max(w, h) > resize_to:
                k = resize_to / max(w, h)
                p = resized(p, max(1, int(w * k)), max(1, int(h * k)), "cubic")
            out.append(laplacian_variance(p))
        return pd.Series(out)

    return measure


def perceptual_hash(pixels: np.ndarray, hash_size: int = 8) -> int:
    """Bits of the low frequencies of a 4 * hash_size thumbnail above their median, row by row, high bit first."""
    n = 4 * hash_size
    small = resized(pixels, n, n, "lanczos")
    k = np.arange(n)
    cosines = 2 * np.cos(np.pi * k[:, None] * (2 * k[None, :] + 1) / (2 * n))
    low = (cosines @ small @ cosines.T)[:hash_size, :hash_size]
    return int("".join("1" if b else "0" for b in (low > np.median(low)).ravel()), 2)


def hash_measure(hash_size: int = 8) -> Callable:
    def measure(width: pd.Series, height: pd.Series, channels: pd.Series, data: pd.Series) -> pd.Series:
        found = [perceptual_hash(gray(w, h, c, d), hash_size) & (1 << 64) - 1 for w, h, c, d in zip(width, height, channels, data, strict=True)]
        return pd.Series(np.array(found, np.uint64).view(np.int64))

    return measure


def png(pixels: np.ndarray) -> bytes:
    """An RGB array (height, width, 3) as a PNG file."""
    h, w, _ = pixels.shape
    rows = np.concatenate([np.zeros((h, 1), np.uint8), pixels.astype(np.uint8).reshape(h, w * 3)], axis=1).tobytes()
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


def valid_images(ctx: Context, folder: str) -> DataFrame:
    """Files below ``folder`` that are large enough and decode: (image_file)."""
    sizes = ctx.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).filter(F.col("length") >= LEAST_BYTES)
    return sizes.select(_as_path(F.col("path")).alias("image_file")).join(pixel_table(ctx, folder).filter("width > 0").select("image_file"), "image_file", "left_semi")


def write_pngs(images: DataFrame, folder: str) -> DataFrame:
    """Write rows (name, width, height, rgb) as files ``folder``/name on a file system that all executors mount; (name, bytes) of each."""
    import os

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sizes = []
            for name, w, h, rgb in zip(b["name"], b["width"], b["height"], b["rgb"], strict=True):
                data = png(np.frombuffer(rgb, np.uint8).reshape(h, w, 3))
                path = os.path.join(folder, name)
                os.makedirs(os.path.dirname(path), exist_ok=True)
                with open(f"{path}.part", "wb") as f:
                    f.write(data)
                os.replace(f"{path}.part", path)
                sizes.append(len(data))
            yield pd.DataFrame({"name": b["name"], "bytes": sizes})

    return images.select("name", "width", "height", "rgb").mapInPandas(write, "name string, bytes long")


# ---------------------------------------------------------------- noise


def blurred(pixels: np.ndarray, sigma: float) -> np.ndarray:
    """An array (height, width, channels) under a Gaussian, edges repeated."""
    reach = max(1, int(3 * sigma))
    at = np.arange(-reach, reach + 1)
    w = np.exp(-(at**2) / (2 * sigma**2))
    w /= w.sum()
    out = pixels.astype(float)
    for axis in (0, 1):
        padded = np.pad(out, [(reach, reach) if a == axis else (0, 0) for a in range(3)], mode="edge")
        out = sum(k * np.take(padded, np.arange(i, i + out.shape[axis]), axis) for i, k in enumerate(w))
    return np.rint(out)


def rescaled(pixels: np.ndarray, factor: float) -> np.ndarray:
    """An array (height, width, channels) with sides times ``factor``, at least one."""
    h, w = (max(1, int(side * factor)) for side in pixels.shape[:2])
    return np.stack([resized(pixels[:, :, c].astype(float), w, h, "cubic") for c in range(pixels.shape[2])], axis=2)


def near_copy(pixels: np.ndarray, key: int) -> np.ndarray:
    """The same picture in other bytes: three quarters to nearly all of its size, every other one without 3 % at each edge."""
    out = rescaled(pixels, 0.75 + key % 21 / 100)
    if key // 21 % 2:
        dy, dx = (int(side * 0.03) for side in out.shape[:2])
        out = out[dy : out.shape[0] - dy, dx : out.shape[1] - dx]
    return out


def degraded(pixels: np.ndarray, key: int) -> tuple[np.ndarray, str]:
    """A picture that is too small, or blurred; and which of the two, by ``key``."""
    if key % 2:
        return rescaled(pixels, (64 + key // 2 % 137) / max(1, min(pixels.shape[:2]))), "downscale"
    return blurred(pixels, 4 + key // 2 % 51 / 10), "blur"


class NoisyImages:
    """The two classes of noise that change images: a hook for ``inject``, whose pictures join those of a context.

    Source pixels are those of ``ctx.images``, or decoded from its folder; rows without a readable image get no noisy
    row.  ``pixels`` has the context's pictures and all that were made.
    """

    def __init__(self, ctx: Context, folder: str = "noise"):
        self.ctx, self.folder = ctx, folder
        self.pixels = ctx.images if ctx.images is not None else pixel_table(ctx, ctx.image_root)

    def __call__(self, rows: DataFrame, kind: str, seed: int) -> DataFrame:
        names = rows.select(self.ctx.resolve_image().alias("image_file"), "row_idx", order_key(seed + len(kind)).alias("key"))
        source = picked(self.pixels.filter("width > 0"), names).select("row_idx", "width", "height", "n_channels", "data", "key")

        def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in (whole.iloc[at : at + PICTURES_AT_ONCE] for whole in batches for at in range(0, len(whole), PICTURES_AT_ONCE)):
                out = []
                for i, w, h, c, data, key in zip(b["row_idx"], b["width"], b["height"], b["n_channels"], b["data"], b["key"], strict=True):
                    p = np.frombuffer(data, np.uint8).reshape(h, w, c)
                    p, mode = (near_copy(p, key), None) if kind == "duplicate_near" else degraded(p, key)
                    out.append((i, p.shape[1], p.shape[0], c, p.astype(np.uint8).tobytes(), mode))
                yield pd.DataFrame(out, columns=["row_idx", "width", "height", "n_channels", "data", "_mode"])

        schema = "row_idx long, width int, height int, n_channels int, data binary, _mode string"
        made = written(source.mapInPandas(make, schema), "noisy_images", PICTURES_AT_ONCE)
        path = F.concat(F.lit(f"/{self.folder.strip('/')}/{kind}/"), F.col("row_idx").cast("string"), F.lit(".png"))
        self.pixels = self.pixels.unionByName(made.select(path.alias("image_file"), "width", "height", "n_channels", "data"))
        return rows.join(made.select("row_idx", "_mode"), "row_idx").withColumn("image_path", path).select(*rows.columns, "_mode")

    def context(self) -> Context:
        """The context with all pictures."""
        return replace(self.ctx, images=self.pixels)
