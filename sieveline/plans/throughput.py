"""How many samples a second operators take, by the median of several runs, and how that grows with cores."""

from __future__ import annotations

import statistics
import time

from pyspark.sql import DataFrame

from sieveline.context import Context
from sieveline.registry import build_op


def rates(samples: DataFrame, ctx: Context, steps: list[dict], repeats: int = 3, warm: bool = True) -> dict[str, float]:
    """Samples a second of each step alone over ``samples``, which should be written or cached; the median of ``repeats`` runs."""
    n, out = samples.count(), {}
    for i, step in enumerate(steps):
        op, took = build_op(step["name"], step.get("params", {})), []
        for k in range(repeats + warm):
            begun = time.perf_counter()
            op.apply(samples, ctx, i).write.format("noop").mode("overwrite").save()
            if k or not warm:
                took.append(time.perf_counter() - begun)
        out[step["name"]] = n / statistics.median(took)
    return out


def speed_up(by_cores: dict[int, dict[str, float]]) -> dict[str, dict[int, float]]:
    """Of each operator and number of cores: its rate over that of the least number of cores."""
    base = by_cores[min(by_cores)]
    return {name: {cores: found[name] / base[name] for cores, found in sorted(by_cores.items())} for name in base}
