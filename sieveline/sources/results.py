"""Benchmark results: harvested from CSV files, compared between models."""

from __future__ import annotations

import csv
import glob
import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def harvest(folder: str, model: str, dataset: str, column: str = "Overall") -> float | None:
    """The headline number of a model's result file below ``folder``; None if there is none.

    Files of the model's own folder, and files anywhere that name model and dataset, are looked at together: acc or
    score ones first, then those of the shortest path.  The first that holds a number in the column gives it.  A file
    of another model never does.
    """
    m, d = glob.escape(model), glob.escape(dataset)
    found = {p for pattern in (f"{m}/*{d}*.csv", f"{m}*{d}*.csv", f"**/*{m}*{d}*.csv") for p in glob.glob(os.path.join(folder, pattern), recursive=True)}
    for path in sorted(found, key=lambda p: (not any(k in p for k in ("acc", "score")), len(p), p)):
        try:
            with open(path, newline="", encoding="utf-8") as f:
                rows = list(csv.DictReader(f))
        except (OSError, UnicodeDecodeError, csv.Error):
            continue
        for row in rows:
            cell = next((v for k, v in row.items() if k and k.strip().lower() == column.lower()), None)
            try:
                return float(cell)
            except (TypeError, ValueError):
                continue
    return None


def delta_table(results: DataFrame, models: tuple[str, ...] = ("base", "a_dirty", "b_cleaned", "c_random")) -> DataFrame:
    """(dataset, one column per model, b_minus_c, b_minus_a) of rows (model, dataset, score); missing results stay null."""
    wide = results.groupBy("dataset").pivot("model", list(models)).agg(F.max("score"))
    diff = lambda x, y: F.bround(F.col(x) - F.col(y), 2)
    return wide.select("dataset", *models, diff("b_cleaned", "c_random").alias("b_minus_c"), diff("b_cleaned", "a_dirty").alias("b_minus_a"))
