"""Vectors, bits, geometry, quantile rules and rates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sieveline.functions.text import stripped


def dot(a: Column, b: Column) -> Column:
    """Sum of products, in double precision."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: Column) -> Column:
    """The vector at length 1; a zero vector stays zero."""
    n = F.greatest(norm(a), F.lit(1e-12))
    return F.transform(a, lambda x: x.cast("double") / n)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (F.greatest(norm(a), F.lit(1e-12)) * F.greatest(norm(b), F.lit(1e-12)))


def band(h: Column, i: int, width: int = 16) -> Column:
    """Bits i*width up of a 64-bit hash."""
    return F.shiftrightunsigned(h, width * i).bitwiseAND(F.lit((1 << width) - 1))


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def first_shared_band(a: Column, b: Column, bands: int = 4) -> Column:
    """The least number of a band on which two hashes agree; null if there is none."""
    out = F.lit(None).cast("int")
    for i in reversed(range(bands)):
        out = F.when(band(a, i) == band(b, i), F.lit(i)).otherwise(out)
    return out


def polygon_area(points: Column) -> Column:
    """Area inside an array of (x, y) arrays, either way round; 0 for fewer than three points."""
    n = F.size(points)
    term = lambda p, i: p[0].cast("double") * F.get(points, (i + 1) % n)[1].cast("double") - F.get(points, (i + 1) % n)[0].cast("double") * p[1].cast("double")
    total = F.aggregate(F.transform(points, term), F.lit(0.0), lambda acc, x: acc + x)
    return F.when(n < 3, F.lit(0.0)).otherwise(F.abs(total) / 2)


def floor_quantile(ordered: Column, p: float) -> Column:
    """Report rule: the value at index min(n - 1, int(p * n)) of a sorted array."""
    return F.get(ordered, F.least(F.size(ordered) - 1, F.floor(F.lit(float(p)) * F.size(ordered)).cast("int")))


def step_quantile(ordered: Column, i: int, steps: int) -> Column:
    """Sweep rule: the value at index min(n - 1, int(i / steps * n))."""
    return floor_quantile(ordered, i / steps)


def rounded_quantile(ordered: Column, q: float) -> Column:
    """Latency rule: the value at index round(q * (n - 1)), halves to even."""
    return F.get(ordered, F.bround(F.lit(float(q)) * (F.size(ordered) - 1)).cast("int"))


def rate(part: Column, whole: Column) -> Column:
    """part / whole, 0 when there is no whole."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(part.cast("double") / whole)


def f1(precision: Column, recall: Column) -> Column:
    both = precision + recall
    return F.when(both == 0, F.lit(0.0)).otherwise(2 * precision * recall / both)


def prf(tp: Column, fp: Column, fn: Column, digits: int = 4) -> dict[str, Column]:
    """Precision, recall and F1, guarded against empty denominators."""
    p, r = rate(tp, tp + fp), rate(tp, tp + fn)
    return {"precision": F.bround(p, digits), "recall": F.bround(r, digits), "f1": F.bround(f1(p, r), digits)}


def op_of(reason: Column) -> Column:
    """The operator that a drop reason names: what stands before its first colon; 'kept' for none."""
    return F.when(F.coalesce(reason, F.lit("")) == "", F.lit("kept")).otherwise(F.split_part(reason, F.lit(":"), F.lit(1)))


def steps_for(n: Column, batch: int, accumulate: int, epochs: float) -> Column:
    return F.greatest(F.lit(1).cast("long"), F.floor(n.cast("double") * F.lit(float(epochs)) / (batch * accumulate)))


def or_text(value: Column, other: str) -> Column:
    """The value, or ``other`` where it is null or empty."""
    return F.when(F.coalesce(value, F.lit("")) == "", F.lit(other)).otherwise(value)


__all__ = [n for n in dir() if not n.startswith("_") and n not in ("Column", "F", "annotations", "stripped")]
