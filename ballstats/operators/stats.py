"""Player and team summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ballstats.functions import rates, wickets
from ballstats.operators import topk


def runs_by_player(deliveries: DataFrame) -> DataFrame:
    runs = deliveries.groupBy(F.col("striker").alias("player_name"))
    return runs.agg(F.sum("runs_of_bat").alias("runs_scored"))


def wickets_by_player(deliveries: DataFrame) -> DataFrame:
    fell = deliveries.where(wickets.real_wicket()).groupBy(F.col("bowler").alias("player_name"))
    return fell.agg(F.count("*").alias("wickets_taken"))


def player_totals(runs: DataFrame, taken: DataFrame) -> DataFrame:
    """Runs and wickets of a player in one row, 0 where there are none.

    Both sides are aggregates with one row per player, so the join has no hot key.
    """
    joined = runs.alias("r").join(taken.alias("w"), F.col("r.player_name").eqNullSafe(F.col("w.player_name")), "full_outer")
    return joined.select(
        F.coalesce("r.player_name", "w.player_name").alias("player_name"),
        F.coalesce("r.runs_scored", F.lit(0)).alias("runs_scored"),
        F.coalesce("w.wickets_taken", F.lit(0)).alias("wickets_taken"),
    )


_COUNTS = ["runs", "faced", "outs", "conceded", "bowled", "taken"]


def _role(player: str, condition: Column | None = None, seen: bool = True, **counts: Column) -> Column:
    """What one delivery adds to one player's counts; null where ``condition`` does not hold."""
    fields = [F.col(player).alias("player_name"), F.lit(seen).alias("seen")]
    fields += [counts.get(name, F.lit(None)).cast("bigint").alias(name) for name in _COUNTS]
    role = F.struct(*fields)
    return role if condition is None else F.when(condition, role)


def player_stats(deliveries: DataFrame) -> DataFrame:
    """Matches, runs, wickets, averages and rates of every player.

    One scan: a delivery is turned into what it means for its striker, its bowler and the
    batter who is out, summed per (player, match) and then per player. The first sum is
    combined on the map side, and counting its groups gives the distinct matches.
    """
    fell, balls = wickets.real_wicket(), F.col("balls")
    roles = [
        _role("striker", runs=F.col("runs_of_bat"), faced=balls),
        _role("bowler", conceded=F.col("total_runs"), bowled=balls, taken=fell.cast("int")),
        _role("player_dismissed", fell & wickets.present("player_dismissed"), seen=False, outs=F.lit(1)),
    ]
    if "non_striker" in deliveries.columns:
        roles.append(_role("non_striker", wickets.present("non_striker")))
    parts = deliveries.select("match_id", F.explode(F.array(*roles)).alias("role")).where("role is not null")
    per_match = parts.select("match_id", "role.*").groupBy("player_name", "match_id").agg(
        *[F.sum(name).alias(name) for name in _COUNTS], F.max("seen").alias("seen")
    )
    totals = per_match.groupBy("player_name").agg(
        F.count(F.when(F.col("seen"), F.col("match_id"))).alias("matches_played"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in _COUNTS],
    )

    def two_places(value: Column) -> Column:
        return value.cast("decimal(10,2)")

    return totals.select(
        "player_name",
        "matches_played",
        F.col("runs").alias("runs_scored"),
        F.col("taken").alias("wickets_taken"),
        two_places(rates.exact_ratio("runs", "outs")).alias("batting_average"),
        two_places(rates.exact_ratio("conceded", "taken")).alias("bowling_average"),
        two_places(rates.percentage("runs", "faced")).alias("strike_rate"),
        two_places(rates.per_over("conceded", "bowled")).alias("economy_rate"),
    )


def batters(deliveries: DataFrame) -> DataFrame:
    sums = deliveries.groupBy(F.col("striker").alias("player_name")).agg(
        F.sum("runs_of_bat").alias("runs_scored"), F.sum("balls").alias("faced")
    )
    return sums.select("player_name", "runs_scored", rates.percentage("runs_scored", "faced").alias("strike_rate"))


def bowlers(deliveries: DataFrame) -> DataFrame:
    sums = deliveries.groupBy(F.col("bowler").alias("player_name")).agg(
        F.sum(wickets.real_wicket().cast("int")).alias("wickets_taken"),
        F.sum("total_runs").alias("conceded"),
        F.sum("balls").alias("bowled"),
    )
    return sums.select("player_name", "wickets_taken", rates.per_over("conceded", "bowled").alias("economy_rate"))


def _team_matches(deliveries: DataFrame) -> DataFrame:
    """One row per team and match: runs and balls for and against.

    Innings totals are few, so both views of an innings are taken from them; a self-join on
    the match is not needed. A team that had no innings has null in ``scored``.
    """
    innings = deliveries.groupBy("match_id", "batting_team", "bowling_team").agg(
        F.sum("total_runs").alias("runs"), F.sum("balls").alias("balls")
    )
    none = F.lit(None).cast("bigint")

    def side(team: str, scored, faced, conceded, bowled) -> Column:
        return F.struct(
            F.col(team).alias("team_name"),
            scored.alias("scored"),
            faced.alias("faced"),
            conceded.alias("conceded"),
            bowled.alias("bowled"),
        )

    runs, balls = F.col("runs"), F.col("balls")
    sides = F.array(
        side("batting_team", runs, balls, none, none),
        side("bowling_team", none, none, runs, balls),
    )
    both = innings.select("match_id", F.inline(sides))
    return both.groupBy("match_id", "team_name").agg(
        *[F.sum(name).alias(name) for name in ("scored", "faced", "conceded", "bowled")]
    )


def team_stats(deliveries: DataFrame) -> DataFrame:
    """Matches played and won, runs for and against, net run rate of every team.

    The higher total of a match wins; a tie, or a match with one side's innings only, is
    nobody's win.
    """
    teams = _team_matches(deliveries).groupBy("team_name").agg(
        F.count("match_id").alias("matches_played"),
        F.count(F.when(F.col("scored") > F.col("conceded"), 1)).alias("matches_won"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in ("scored", "faced", "conceded", "bowled")],
    )
    return teams.select(
        "team_name",
        "matches_played",
        "matches_won",
        F.col("scored").alias("total_runs_scored"),
        F.col("conceded").alias("total_runs_conceded"),
        rates.net_run_rate("scored", "faced", "conceded", "bowled").alias("net_run_rate"),
    )


def team_wins(deliveries: DataFrame) -> DataFrame:
    won = team_stats(deliveries).withColumn("win_percentage", rates.percentage("matches_won", "matches_played"))
    return won.select("team_name", F.col("matches_won").alias("wins"), "win_percentage")


# The kinds of top performers, what each is computed by and ranked on.
PERFORMERS = {
    "batsmen": (batters, "runs_scored", "player_name"),
    "bowlers": (bowlers, "wickets_taken", "player_name"),
    "teams": (team_wins, "wins", "team_name"),
}


def top_performers(deliveries: DataFrame, kind: str, limit: int) -> DataFrame:
    """Name, measure and rate of the best ``limit`` batsmen, bowlers or teams."""
    compute, measure, name = PERFORMERS[kind]
    return topk.top(compute(deliveries), measure, name, limit)


def team_performance(teams: DataFrame) -> DataFrame:
    """Teams by runs scored."""
    shown = teams.select("team_name", "matches_played", "total_runs_scored")
    return shown.orderBy(F.desc("total_runs_scored"), "team_name")
