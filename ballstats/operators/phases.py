"""Bowling by phase of an innings."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ballstats.functions import rates, wickets

# The first over of a phase, and the over it ends before.
PHASES: dict[str, tuple[int, int | None]] = {"powerplay": (0, 6), "middle": (6, 16), "death": (16, None)}


def in_phase(first: int, end: int | None) -> Column:
    """A ball of an unknown over is in no phase."""
    inside = F.col("over") >= first
    return inside if end is None else inside & (F.col("over") < end)


def phase_economy(deliveries: DataFrame, phases: Mapping[str, tuple[int, int | None]] = PHASES) -> DataFrame:
    """Balls, runs, wickets and runs per over of every bowler in each phase, 0 and null where there are none.

    All phases are conditional sums of one aggregate: one scan, combined before the one shuffle.
    """
    sums, rated = [], []
    for name, bounds in phases.items():
        inside = in_phase(*bounds)
        fell = wickets.real_wicket() & inside
        for what, amount in (("balls", F.when(inside, F.col("balls"))), ("runs", F.when(inside, F.col("total_runs")))):
            sums.append(F.coalesce(F.sum(amount), F.lit(0)).alias(f"{name}_{what}"))
        sums.append(F.count(F.when(fell, 1)).alias(f"{name}_wickets"))
        rated += [f"{name}_balls", f"{name}_runs", f"{name}_wickets"]
        rated.append(rates.per_over(f"{name}_runs", f"{name}_balls").alias(f"{name}_economy"))
    return deliveries.groupBy("bowler").agg(*sums).select("bowler", *rated)
