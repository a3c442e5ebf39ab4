"""Top scorers per innings, and top-n reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ballstats import schemas
from ballstats.operators import metrics

_SCORE_COLUMNS = [*schemas.INNINGS_KEYS, "striker", "total_runs"]


def known(names: list[str]) -> Column:
    return reduce(lambda a, b: a & b, (F.col(name).isNotNull() for name in names))


def top_scorers(scores: DataFrame) -> DataFrame:
    """Best striker of every innings, all of them on a tie.

    ``scores`` has one row per striker and innings. The rank is cut to 1 before the shuffle
    already (WindowGroupLimit), so each task sends on only its own best rows of an innings.
    Innings with a null key have no top scorer, as under an equi-join with the maximum.
    """
    per_innings = Window.partitionBy(*schemas.INNINGS_KEYS).orderBy(F.desc("total_runs"))
    ranked = scores.where(known([*schemas.INNINGS_KEYS, "total_runs"]))
    return ranked.withColumn("place", F.rank().over(per_innings)).where("place = 1").select(*_SCORE_COLUMNS)


def top_scorers_by_join(scores: DataFrame) -> DataFrame:
    """The same as scores joined to their maximum.

    Two uses of ``scores``, but no window: an innings with an unbounded number of strikers is
    split by AQE's skew join instead of being ranked in one task.
    """
    best = metrics.best_score_by_innings(scores).withColumnRenamed("max_runs", "total_runs")
    return scores.join(best, [*schemas.INNINGS_KEYS, "total_runs"]).select(*_SCORE_COLUMNS)


def top(df: DataFrame, measure: str, name: str, n: int) -> DataFrame:
    """The n largest, by name on ties; each task keeps n rows, nothing is sorted globally."""
    return df.orderBy(F.desc(measure), F.asc(name)).limit(n)


def top_positive(df: DataFrame, measure: str, name: str, n: int) -> DataFrame:
    return top(df.where(F.col(measure) > 0), measure, name, n)
