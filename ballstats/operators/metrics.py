"""Aggregates over typed deliveries. Each runs unchanged on static and on streaming input.

All are sums and counts, so Spark combines them on the map side: a key that holds a third of
the deliveries reaches the shuffle as one row per task. Nothing here sorts; the order of a
result belongs to its :class:`ballstats.plans.catalog.Metric`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ballstats import schemas
from ballstats.functions import rates, wickets

SCORE_KEYS = [*schemas.INNINGS_KEYS, "striker"]


def wickets_by_bowler(deliveries: DataFrame, credited_only: bool = False) -> DataFrame:
    fell = deliveries.where(wickets.real_wicket(credited_only))
    return fell.groupBy("bowler").agg(F.count("wicket_type").alias("wickets_taken"))


def dismissal_types(deliveries: DataFrame) -> DataFrame:
    return deliveries.where(wickets.real_wicket()).groupBy("wicket_type").agg(F.count("*").alias("count"))


def caught_batters(deliveries: DataFrame) -> DataFrame:
    """One row per catch; no shuffle."""
    return deliveries.where(wickets.caught()).select(F.col("player_dismissed").alias("batsman"))


def wicket_flags(deliveries: DataFrame) -> DataFrame:
    flagged = deliveries.withColumn("is_wicket", wickets.is_wicket())
    return flagged.groupBy("is_wicket").agg(F.count("*").alias("n"))


def runs_by_striker_and_team(deliveries: DataFrame) -> DataFrame:
    return deliveries.groupBy("striker", "batting_team").agg(F.sum("runs_of_bat").alias("total_runs"))


def scores_by_innings(deliveries: DataFrame) -> DataFrame:
    """Runs of every striker in every innings."""
    return deliveries.groupBy(*SCORE_KEYS).agg(F.sum("runs_of_bat").alias("total_runs"))


def best_score_by_innings(scores: DataFrame) -> DataFrame:
    return scores.groupBy(*schemas.INNINGS_KEYS).agg(F.max("total_runs").alias("max_runs"))


def run_rate(deliveries: DataFrame, keys: list[str], balls: str, rate: str) -> DataFrame:
    """Runs, balls and runs per over of each group.

    A delivery with unreadable runs adds a ball but no runs.
    """
    sums = deliveries.groupBy(*keys).agg(F.sum("total_runs").alias("total_runs"), F.sum("balls").alias(balls))
    return sums.withColumn(rate, rates.per_over("total_runs", balls))


def run_rate_match(deliveries: DataFrame) -> DataFrame:
    return run_rate(deliveries, ["match_id", "innings", "batting_team"], "total_balls", "run_rate")


def run_rate_team(deliveries: DataFrame) -> DataFrame:
    return run_rate(deliveries, ["batting_team"], "total_balls", "overall_run_rate")


def run_rate_striker(deliveries: DataFrame) -> DataFrame:
    return run_rate(deliveries, ["striker"], "balls_faced", "run_rate")


def run_rate_powerplay(deliveries: DataFrame) -> DataFrame:
    first_overs = deliveries.where(wickets.powerplay())
    return run_rate(first_overs, ["batting_team", "match_id", "innings"], "powerplay_balls", "powerplay_runrate")
