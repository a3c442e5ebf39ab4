"""How batters do over seasons: form and consistency."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ballstats.functions import rates

FORM_SEASONS = 3


def season_runs(deliveries: DataFrame) -> DataFrame:
    """Runs of every batter in every season, as a number: the first four digits of ``2020/21`` count.

    Deliveries without a readable season are left out. Also the aggregate of the live query: all else
    is computed from its few rows when a result is read.
    """
    season = F.substring(F.col("season").cast("string"), 1, 4).try_cast("int")
    known = deliveries.select(F.col("striker").alias("player_name"), season.alias("season"), "runs_of_bat")
    runs = F.coalesce(F.sum("runs_of_bat"), F.lit(0))
    return known.where("season is not null").groupBy("player_name", "season").agg(runs.alias("runs"))


def season_form(runs: DataFrame, seasons: int = FORM_SEASONS) -> DataFrame:
    """Per batter and season: runs over the last ``seasons`` seasons, and their average over those played.

    The frame is a range of season numbers and not of rows, so that a missed season counts as one of
    them. ``runs`` has one row per batter and season.
    """
    last = Window.partitionBy("player_name").orderBy("season").rangeBetween(1 - seasons, Window.currentRow)
    summed = runs.withColumn("form_runs", F.sum("runs").over(last)).withColumn("form_seasons", F.count("*").over(last))
    average = rates.exact_ratio("form_runs", "form_seasons")
    return summed.select("player_name", "season", "runs", "form_runs", "form_seasons", average.alias("form_average"))


def moments(runs: DataFrame) -> DataFrame:
    """Per batter the number of seasons, the sum of their runs and the sum of their squares.

    Whole numbers, so they can be added to others in any order and grouping with one result.
    """
    square = F.col("runs").cast("decimal(18,0)") * F.col("runs").cast("decimal(18,0)")
    return runs.groupBy("player_name").agg(
        F.count("*").alias("seasons"),
        F.sum("runs").alias("total"),
        F.sum(square).cast("decimal(38,0)").alias("squares"),
    )


def merged(parts: list[DataFrame]) -> DataFrame:
    """Moments of all seasons out of moments of some, no season being in two parts."""
    every = reduce(DataFrame.unionByName, parts)
    return every.groupBy("player_name").agg(
        F.sum("seasons").alias("seasons"),
        F.sum("total").alias("total"),
        F.sum("squares").cast("decimal(38,0)").alias("squares"),
    )


def consistency(summed: DataFrame) -> DataFrame:
    """Mean, standard deviation (divisor n) and coefficient of variation of a batter's runs per season.

    n * squares - total^2 is a whole number, so nothing cancels; the root is taken of it.
    """
    n = F.col("seasons").cast("decimal(9,0)")
    total = F.col("total").cast("decimal(18,0)")
    root = F.sqrt((n * F.col("squares") - total * total).cast("double"))
    return summed.select(
        "player_name",
        "seasons",
        F.col("total").alias("runs"),
        (F.col("total").cast("double") / F.col("seasons")).alias("mean_runs"),
        (root / F.col("seasons")).alias("deviation"),
        F.when(F.col("total") != 0, root / F.col("total")).alias("variation"),
    )


def batter_consistency(runs: DataFrame) -> DataFrame:
    return consistency(moments(runs))
