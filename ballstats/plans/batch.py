"""Several metrics from one reading of the deliveries."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ballstats import session
from ballstats.functions import wickets
from ballstats.operators.metrics import SCORE_KEYS
from ballstats.plans.catalog import METRICS, Metric

_SUMMED = ["runs_of_bat", "extras", "total_runs", "balls"]


def phase() -> Column:
    """0 for the powerplay and null for the rest, under the name of the over that it stands for."""
    return F.when(wickets.powerplay(), F.lit(0.0).cast("float")).alias("over")


def rollup(deliveries: DataFrame) -> DataFrame:
    """Deliveries summed per striker, innings and phase, under their own column names.

    Every run metric gives on the rollup what it gives on the deliveries, on a fraction of the
    rows. ``over`` is 0 for the powerplay and null for the rest.
    """
    summed = [name for name in _SUMMED if name in deliveries.columns]
    return deliveries.groupBy(*SCORE_KEYS, phase()).agg(*[F.sum(name).alias(name) for name in summed])


PHASE_SCORES = Metric("phase_scores", "rate", rollup, (*SCORE_KEYS, "over"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, and safe from lost executors."""
    path = session.fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def run(deliveries: DataFrame, names: Iterable[str]) -> dict[str, DataFrame]:
    """The named metrics; those on runs share one stored rollup if there is more than one."""
    names = list(names)
    on_runs = [name for name in names if METRICS[name].topic in ("runs", "rate")]
    shared = stored(rollup(deliveries), "rollup") if len(on_runs) > 1 else deliveries
    return {name: METRICS[name].batch(shared if name in on_runs else deliveries) for name in names}
