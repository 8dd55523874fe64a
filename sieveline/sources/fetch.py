"""Fetching images over HTTP: each distinct path once, retried, never half a file."""

from __future__ import annotations

import os
import random
import time
import urllib.error
import urllib.request
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.plans.prepare import distinct_images
from sieveline.sources.images import LEAST_BYTES, header_size


def is_valid(path: str) -> bool:
    """Whether a file is large enough and starts as an image does."""
    try:
        if os.path.getsize(path) < LEAST_BYTES:
            return False
        with open(path, "rb") as f:
            return header_size(f.read(1 << 16)) is not None
    except OSError:
        return False


def fetch_one(url: str, path: str, retries: int = 3, timeout: float = 20.0, wait: float = 0.5) -> str:
    """ok, skipped (a valid file is there), missing (404, not tried again) or failed.  Written beside and moved in place."""
    if is_valid(path):
        return "skipped"
    part = f"{path}.part"
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    for attempt in range(retries):
        try:
            with urllib.request.urlopen(url, timeout=timeout) as response, open(part, "wb") as f:
                f.write(response.read())
            if is_valid(part):
                os.replace(part, path)
                return "ok"
        except urllib.error.HTTPError as e:
            if e.code == 404:
                return "missing"
        except OSError:
            pass
        finally:
            if os.path.exists(part):
                os.remove(part)
        if attempt + 1 < retries:
            time.sleep(wait * 2**attempt * (1 + random.random()))
    return "failed"


def fetch(samples: DataFrame, base_url: str, folder: str, threads: int = 16, limit: int | None = None, **options) -> DataFrame:
    """(image_path, status) of every image that ``samples`` refer to, fetched to ``folder`` (mounted by all executors).

    With ``limit`` only the images mentioned first, for a trial.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(threads) as pool:
            for b in batches:
                todo = list(b["image_path"])
                status = list(pool.map(lambda p: fetch_one(f"{base_url.rstrip('/')}/{p}", os.path.join(folder, p), **options), todo))
                yield pd.DataFrame({"image_path": todo, "status": status})

    wanted = distinct_images(samples)
    if limit is not None:
        wanted = wanted.orderBy("row_idx", "image_path").limit(limit)
    return wanted.select("image_path").mapInPandas(run, "image_path string, status string")


def summary(fetched: DataFrame, first: int = 5) -> tuple[dict[str, int], list[str]]:
    """How many images have each status, and the first few that are not there, by path; ``fetched`` should be written."""
    counts = {r["status"]: r["n"] for r in fetched.groupBy("status").agg(F.count("*").alias("n")).collect()}
    gone = fetched.filter("status in ('missing', 'failed')").orderBy("image_path").limit(first)
    return counts, [r["image_path"] for r in gone.collect()]
