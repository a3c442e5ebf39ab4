"""Who won a match, batting first or second."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ballstats.functions import rates

DEFENDED, CHASED, TIE, NO_RESULT = "defended", "chased", "tie", "no result"


def match_outcomes(deliveries: DataFrame) -> DataFrame:
    """One row per match: both teams and totals in the order of innings, and what became of it.

    The innings of a match are folded in one aggregate over their totals: the one with the smaller
    number is the first. Innings past the second (super overs) do not count; a match with one innings,
    or with one whose runs cannot be read at all, has no result. Of an innings with several batting
    teams the first team by name stands for it.
    """
    innings = deliveries.where("match_id is not null and innings in (1, 2)")
    totals = innings.groupBy("match_id", "innings", "batting_team").agg(F.sum("total_runs").alias("total"))
    side = F.struct("innings", F.col("batting_team").alias("team"), "total")
    folded = totals.groupBy("match_id").agg(
        F.min_by(side, F.struct("innings", "batting_team")).alias("first"),
        F.min_by(side, F.struct(-F.col("innings"), F.col("batting_team"))).alias("second"),
    )
    both = F.col("first.innings") < F.col("second.innings")
    ahead = F.col("first.total") - F.col("second.total")
    outcome = (
        F.when(~both | ahead.isNull(), NO_RESULT)
        .when(ahead > 0, DEFENDED)
        .when(ahead < 0, CHASED)
        .otherwise(TIE)
    )
    return folded.select(
        "match_id",
        F.col("first.team").alias("first_team"),
        F.col("first.total").alias("first_total"),
        F.when(both, F.col("second.team")).alias("second_team"),
        F.when(both, F.col("second.total")).alias("second_total"),
        outcome.alias("outcome"),
    )


def chase_vs_defend(outcomes: DataFrame) -> DataFrame:
    """Per team: matches batted first (defending) and second (chasing), how many were won, and the shares.

    Ties and matches without a result are played but not won.
    """
    sides = F.array(
        F.struct(F.col("first_team").alias("team_name"), F.lit(True).alias("defending")),
        F.struct(F.col("second_team").alias("team_name"), F.lit(False).alias("defending")),
    )
    each = outcomes.select("outcome", F.inline(sides)).where("team_name is not null")

    def count(condition: str, name: str):
        return F.count(F.when(F.expr(condition), 1)).alias(name)

    counted = each.groupBy("team_name").agg(
        count("defending", "defending"),
        count(f"defending and outcome = '{DEFENDED}'", "defended"),
        count("not defending", "chasing"),
        count(f"not defending and outcome = '{CHASED}'", "chased"),
        count(f"outcome = '{TIE}'", "tied"),
        count(f"outcome = '{NO_RESULT}'", "without_result"),
    )
    return counted.select(
        "*",
        rates.percentage("defended", "defending").alias("defended_percentage"),
        rates.percentage("chased", "chasing").alias("chased_percentage"),
    )
