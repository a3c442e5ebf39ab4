"""The metrics by name: what they read, how they aggregate, how they are shown."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ballstats import schemas
from ballstats.operators import metrics, seasons, stats, topk

Step = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Metric:
    """``aggregate`` works on static and streaming input; ``finish`` and the order on static only.

    ``keys`` identify a row of the aggregate. ``order`` lists columns, ``-name`` for descending;
    it ends in the keys so that equal measures come out in one order. ``every`` is the trigger
    interval of the live query; None starts a batch as soon as the last one is done.
    """

    name: str
    topic: str
    aggregate: Step
    keys: tuple[str, ...] = ()
    order: tuple[str, ...] = ()
    finish: Step | None = None
    every: str | None = None

    def show(self, aggregated: DataFrame) -> DataFrame:
        """The result as presented, from the aggregate."""
        result = self.finish(aggregated) if self.finish else aggregated
        if not self.order:
            return result
        return result.orderBy(*[F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in self.order])

    def batch(self, deliveries: DataFrame) -> DataFrame:
        return self.show(self.aggregate(deliveries))


_INNINGS = tuple(schemas.INNINGS_KEYS)

METRICS: dict[str, Metric] = {
    metric.name: metric
    for metric in [
        Metric(
            "top_wicket_takers",
            "bowler",
            metrics.wickets_by_bowler,
            ("bowler",),
            ("-wickets_taken", "bowler"),
            every="5 seconds",
        ),
        Metric(
            "dismissal_types",
            "bowler",
            metrics.dismissal_types,
            ("wicket_type",),
            ("-count", "wicket_type"),
            every="5 seconds",
        ),
        Metric("caught_dismissals", "bowler", metrics.caught_batters),
        Metric(
            "highest_scorers",
            "runs",
            metrics.runs_by_striker_and_team,
            ("striker", "batting_team"),
            ("-total_runs", "striker", "batting_team"),
        ),
        Metric(
            "scores_match_innings",
            "runs",
            metrics.scores_by_innings,
            (*_INNINGS, "striker"),
            (*_INNINGS, "striker"),
        ),
        Metric(
            "max_score_match_innings",
            "runs",
            metrics.scores_by_innings,
            (*_INNINGS, "striker"),
            _INNINGS,
            metrics.best_score_by_innings,
        ),
        Metric(
            "top_scorer_match_innings",
            "runs",
            metrics.scores_by_innings,
            (*_INNINGS, "striker"),
            (*_INNINGS, "striker"),
            topk.top_scorers,
            every="5 seconds",
        ),
        Metric(
            "top_scorer_match_innings_join",
            "runs",
            metrics.scores_by_innings,
            (*_INNINGS, "striker"),
            (*_INNINGS, "striker"),
            topk.top_scorers_by_join,
        ),
        Metric(
            "run_rate_match",
            "rate",
            metrics.run_rate_match,
            ("match_id", "innings", "batting_team"),
            ("match_id", "innings", "batting_team"),
            every="5 seconds",
        ),
        Metric(
            "run_rate_team", "rate", metrics.run_rate_team, ("batting_team",), ("-overall_run_rate", "batting_team")
        ),
        Metric(
            "run_rate_striker",
            "rate",
            metrics.run_rate_striker,
            ("striker",),
            ("-run_rate", "striker"),
            every="5 seconds",
        ),
        Metric(
            "run_rate_powerplay",
            "rate",
            metrics.run_rate_powerplay,
            ("batting_team", "match_id", "innings"),
            ("match_id", "innings", "batting_team"),
        ),
        Metric(
            "batter_consistency",
            schemas.RAW_TOPIC,
            seasons.season_runs,
            ("player_name", "season"),
            ("player_name",),
            seasons.batter_consistency,
        ),
        Metric(
            "season_form",
            schemas.RAW_TOPIC,
            seasons.season_runs,
            ("player_name", "season"),
            ("player_name", "season"),
            seasons.season_form,
        ),
        Metric("player_runs_upsert", "runs", stats.runs_by_player, ("player_name",), ("player_name",)),
        Metric("player_wickets_upsert", "bowler", stats.wickets_by_player, ("player_name",), ("player_name",)),
    ]
}

# What one submitted job computes, and where its topics are read from at first.
JOBS: dict[str, tuple[str, ...]] = {
    "bowling": ("top_wicket_takers", "dismissal_types", "caught_dismissals"),
    "overall_scorers": ("highest_scorers",),
    "match_scorers": ("top_scorer_match_innings",),
    "run_rate": ("run_rate_match", "run_rate_team", "run_rate_striker", "run_rate_powerplay"),
}
STARTING: dict[str, str] = {
    "bowling": "latest",
    "overall_scorers": "earliest",
    "match_scorers": "earliest",
    "run_rate": "latest",
}
