"""The registered queries, each over the whole of the given tables, and their SQL checks."""

from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from ballstats import schemas, session  # noqa: E402
from ballstats.functions import parse  # noqa: E402
from ballstats.operators import (  # noqa: E402
    fanout, landing, metrics, milestones, outcomes, phases, reconcile, stats, topk,
)
from ballstats.plans import batch  # noqa: E402
from ballstats.plans.catalog import METRICS  # noqa: E402
from ballstats.sources import files, fixture, topics  # noqa: E402
from ballstats.streaming import routed, runner, stateful  # noqa: E402
from oracles import ORACLES  # noqa: E402

try:
    import corpus_pipeline  # noqa: E402
    from ballstats.llm import oracles as text_oracles  # noqa: E402
    from ballstats.llm import queries as text_queries  # noqa: E402
except ImportError:  # the library works without them
    corpus_pipeline = text_oracles = text_queries = None

Query = Callable[[SparkSession, str], DataFrame]

# Message files that a micro-batch reads, so that it is bounded however many there are.
FILES_PER_TRIGGER = 3
RECONCILED = ("top_wicket_takers", "highest_scorers", "run_rate_team")


def _deliveries(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    return fixture.deliveries(fixture.lineitem(spark, sf_dir), keep)


def _spread(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """The deliveries on all cores, for work that is costly per row (JSON, wide rows written)."""
    return fixture.deliveries(files.spread(fixture.lineitem(spark, sf_dir)), keep)


def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.typed(_deliveries(spark, sf_dir))


def _on_typed(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(_typed(spark, sf_dir))


def _message_stream(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    """The topic written out as messages and read back as a stream of several micro-batches."""
    path = session.fresh_path(spark, f"topic-{topic}")
    topics.write_topic_files(fanout.topic_messages(_spread(spark, sf_dir), topic), path)
    return topics.stream_topic_files(session.for_streams(spark), path, [topic], FILES_PER_TRIGGER)


def _start(spark: SparkSession, sf_dir: str, name: str, mode: str):
    """A metric over the messages of its topic, in several micro-batches; returns the query and its path."""
    metric, path = METRICS[name], session.fresh_path(spark, name)
    decoded = runner.decoded(_message_stream(spark, sf_dir, metric.topic), metric.topic)
    return runner.start_metric(decoded, metric, path, mode, runner.ONCE), path


def _streamed(name: str, mode: str = "complete") -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        running, path = _start(spark, sf_dir, name, mode)
        runner.finish(running)
        return runner.read_metric(spark, METRICS[name], path, mode)

    return query


# What comes in before a live query is stopped and started again.
FIRST_SEASONS, LATER_SEASONS = "season < 2022", "season >= 2022"


def _in_two_runs(spark: SparkSession, sf_dir: str, topic: str, name: str, start: Callable) -> str:
    """A query run over several micro-batches, ended, and continued from its checkpoint with what came since."""
    inbox, path = session.fresh_path(spark, f"topic-{topic}"), session.fresh_path(spark, name)
    for part in (FIRST_SEASONS, LATER_SEASONS):
        topics.write_topic_files(fanout.topic_messages(_spread(spark, sf_dir).where(part), topic), inbox)
        messages = topics.stream_topic_files(session.for_streams(spark), inbox, [topic], FILES_PER_TRIGGER)
        runner.finish(start(messages, path))
    return path


def stream_milestones(spark: SparkSession, sf_dir: str) -> DataFrame:
    def start(messages: DataFrame, path: str):
        return stateful.start_milestones(runner.decoded(messages, "runs"), path, runner.ONCE)

    path = _in_two_runs(spark, sf_dir, "runs", "live-milestones", start)
    return stateful.read_milestones(spark, path).select(*metrics.SCORE_KEYS, "milestone")


def stream_top_scorer_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    def start(messages: DataFrame, path: str):
        return stateful.start_top_scorers(runner.decoded(messages, "runs"), path, runner.ONCE)

    return stateful.read_top_scorers(spark, _in_two_runs(spark, sf_dir, "runs", "live-top-scorers", start))


def _with_faults(deliveries: DataFrame) -> DataFrame:
    """Messages of ``rate``: some lack a field, some end early, some are followed by more text."""
    whole = fanout.topic_messages(deliveries.drop("l_linenumber"), "rate")
    gappy = parse.encode("match_id", "batting_team", "innings", "over", "runs_of_bat", "extras")
    text = parse.encode(*schemas.TOPIC_FIELDS["rate"])
    line = F.col("l_linenumber")
    value = (
        F.when(line == 7, gappy)
        .when(line == 6, F.concat(text, F.lit(" "), text))
        .when(line == 5, F.substring(text, 1, 20))
        .otherwise(text)
    )
    return deliveries.select(F.lit("rate").alias("topic"), value.alias("value")).select(*whole.columns)


def _routed(spark: SparkSession, sf_dir: str) -> str:
    """Faulty messages routed by one query; gives its path."""
    inbox, path = session.fresh_path(spark, "topic-faulty"), session.fresh_path(spark, "routed")
    topics.write_topic_files(_with_faults(_spread(spark, sf_dir, keep=("l_linenumber",))), inbox)
    messages = topics.stream_topic_files(session.for_streams(spark), inbox, ["rate"], FILES_PER_TRIGGER)
    runner.finish(routed.start(messages, path, runner.ONCE))
    return path


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routed.problems(routed.read_rejected(spark, _routed(spark, sf_dir)))


def _routed_metric(name: str) -> Query:
    return lambda spark, sf_dir: routed.read_metric(spark, _routed(spark, sf_dir), name)


def _incomplete(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Batch scorers, and the streamed ones of a feed that lacks a season."""
    metric, path = METRICS["highest_scorers"], session.fresh_path(spark, "incomplete")
    deliveries = fixture.deliveries(fixture.lineitem_stream(session.for_streams(spark), sf_dir)).where("season <> 2022")
    messages = fanout.topic_messages(deliveries, metric.topic)
    runner.finish(runner.start_metric(runner.decoded(messages, metric.topic), metric, path, "update", runner.ONCE))
    streamed = batch.stored(runner.read_metric(spark, metric, path, "update"), "streamed")
    return batch.stored(metric.aggregate(_typed(spark, sf_dir)), "scorers"), streamed


def reconcile_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = reconcile.difference(*_incomplete(spark, sf_dir), METRICS["highest_scorers"].keys)
    values = [F.col(f"{side}.total_runs").alias(f"{side}_runs") for side in ("batch", "stream")]
    return found.select("striker", "batting_team", *values, "batch_rows", "stream_rows")


def reconcile_incomplete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.reconcile("highest_scorers", *_incomplete(spark, sf_dir))


def _odd_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries whose strikers have separators, quotes, blanks and line breaks in their names."""
    name = F.concat(F.col("striker"), F.lit(', "the '), F.col("bowler"), F.lit('"\n of '), F.col("venue"), F.lit(" "))
    return _spread(spark, sf_dir).select("match_id", name.alias("striker"), "over", "runs_of_bat", "wicket_type")


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = session.fresh_path(spark, "csv")
    files.write_csv(_odd_names(spark, sf_dir), path)
    return files.split_csv(spark, path, multi_line=True)[0]


def csv_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CSV in which rows of some line numbers lack a field and others have one too many."""
    path = session.fresh_path(spark, "csv-faults")
    line = F.col("l_linenumber")
    last = F.concat(F.lit(","), "runs_of_bat")
    last = F.when(line == 7, F.lit("")).when(line == 6, F.concat(last, F.lit(",9"))).otherwise(last)
    rows = _spread(spark, sf_dir, keep=("l_linenumber",)).select(F.concat("match_id", F.lit(","), "striker", last).alias("value"))
    rows.write.text(path)
    good, bad = files.split_csv(spark, path, names=["match_id", "striker", "runs_of_bat"])
    counted = good.select(F.lit("good").alias("kind"), F.length("runs_of_bat").alias("size")).unionByName(
        bad.select("problem", F.lit(None).cast("int").alias("size")).withColumnRenamed("problem", "kind")
    )
    return counted.groupBy("kind", "size").agg(F.count("*").alias("n"))


def _landed(topic: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = session.fresh_path(spark, f"land-{topic}")
        runner.finish(runner.start_landing(_message_stream(spark, sf_dir, topic), path, runner.ONCE))
        return runner.read_landed(spark, path, topic)

    return query


def typed_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _typed(spark, sf_dir).select(
        "match_id", "season", "batting_team", "bowling_team", "striker", "bowler", "wicket_type",
        "player_dismissed", "fielder", "innings", "over", "runs_of_bat", "extras", "total_runs", "balls",
    )


def json_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.decode(fanout.topic_messages(_spread(spark, sf_dir), "runs"), "runs")


def validate_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of ``rate`` that lack the striker where the line number is 7."""
    deliveries = _spread(spark, sf_dir, keep=("l_linenumber",))
    gappy = deliveries.withColumn("striker", F.when(F.col("l_linenumber") != 7, F.col("striker")))
    fields = F.struct("match_id", "batting_team", "innings", "over", "striker", "runs_of_bat", "extras")
    messages = gappy.select(F.lit("rate").alias("topic"), F.to_json(fields).alias("value"))
    return landing.validate(messages).groupBy("status").agg(F.count("*").alias("n"))


def matches_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension holds season 2020; the matches it lacks are inserted."""
    seen = batch.stored(landing.matches(_deliveries(spark, sf_dir)), "matches")
    existing = seen.where("season = 2020")
    return existing.unionByName(landing.absent_matches(seen, existing))


def deliveries_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, path = landing.facts(_spread(spark, sf_dir)), session.fresh_path(spark, "deliveries")
    landing.write_facts(rows, path)
    return spark.read.schema(rows.schema).parquet(path)


def orphan_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    deliveries = _deliveries(spark, sf_dir)
    return landing.orphan_counts(deliveries, landing.matches(deliveries).where("season > 2020"))


def player_totals(deliveries: DataFrame) -> DataFrame:
    return stats.player_totals(stats.runs_by_player(deliveries), stats.wickets_by_player(deliveries))


def reconcile_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streams run side by side, then each is compared with its batch twin."""
    started = {name: _start(spark, sf_dir, name, "complete") for name in RECONCILED}
    pairs = {}
    for name, (running, path) in started.items():
        runner.finish(running)
        streamed = runner.read_metric(spark, METRICS[name], path)
        pairs[name] = (METRICS[name].aggregate(_typed(spark, sf_dir)), streamed)
    return reconcile.report(pairs)


def entry(spark: SparkSession) -> DataFrame:
    """Top scorers of every innings."""
    return METRICS["top_scorer_match_innings"].batch(_typed(spark, "/root/testdata/sf0.001"))


_STREAMED = (
    "top_wicket_takers", "dismissal_types", "highest_scorers", "top_scorer_match_innings",
    "run_rate_match", "run_rate_team", "run_rate_striker", "run_rate_powerplay",
)


def _on_text() -> dict[str, Query]:
    """Queries of the subpackage for text, if it is there."""
    if text_queries is None:
        return {}
    return {**text_queries.queries(), "pipeline": corpus_pipeline.run}


def text_query_names() -> set[str]:
    return set(_on_text())


def queries() -> dict[str, Query]:
    upserts = ("player_runs_upsert", "player_wickets_upsert")
    rates = ("run_rate_match", "run_rate_team", "run_rate_striker", "run_rate_powerplay")
    order = ("l_orderkey", "l_linenumber")
    return {
        **{name: _on_typed(metric.batch) for name, metric in METRICS.items() if name not in upserts},
        "milestones": lambda spark, sf_dir: milestones.milestones(_deliveries(spark, sf_dir, order), order),
        "stream_milestones": stream_milestones,
        "stream_top_scorer_incremental": stream_top_scorer_incremental,
        "stream_quarantine": stream_quarantine,
        **{f"routed_{name}": _routed_metric(name) for name in rates},
        "reconcile_diff": reconcile_diff,
        "reconcile_incomplete": reconcile_incomplete,
        **{f"stream_{name}": _streamed(name, "update") for name in ("batter_consistency", "season_form")},
        "phase_economy": _on_typed(phases.phase_economy),
        "match_outcomes": _on_typed(outcomes.match_outcomes),
        "chase_vs_defend": _on_typed(lambda df: outcomes.chase_vs_defend(outcomes.match_outcomes(df))),
        "csv_roundtrip": csv_roundtrip,
        "csv_faults": csv_faults,
        **{f"stream_{name}": _streamed(name) for name in _STREAMED},
        "stream_caught_dismissals": _streamed("caught_dismissals", "append"),
        **{name: _streamed(name, "update") for name in upserts},
        **{f"land_{topic}": _landed(topic) for topic in ("runs", "rate", "bowler")},
        "typed_deliveries": typed_deliveries,
        "wicket_flag": _on_typed(metrics.wicket_flags),
        "topic_fanout": lambda spark, sf_dir: fanout.fan_out(_spread(spark, sf_dir)),
        "json_decode": json_decode,
        "validate_messages": validate_messages,
        "matches_dim": matches_dim,
        "deliveries_fact": deliveries_fact,
        "orphan_deliveries": orphan_deliveries,
        "player_totals": _on_typed(player_totals),
        "player_stats": _on_typed(stats.player_stats),
        "team_stats": _on_typed(stats.team_stats),
        "team_performance": _on_typed(lambda df: stats.team_performance(stats.team_stats(df))),
        "top10_run_scorers": _on_typed(
            lambda df: topk.top_positive(stats.runs_by_player(df), "runs_scored", "player_name", 10)
        ),
        "top10_wicket_takers": _on_typed(
            lambda df: topk.top_positive(stats.wickets_by_player(df), "wickets_taken", "player_name", 10)
        ),
        "top_batters": _on_typed(lambda df: stats.top_performers(df, "batsmen", 5)),
        "top_bowlers": _on_typed(lambda df: stats.top_performers(df, "bowlers", 5)),
        "top_teams": _on_typed(lambda df: stats.top_performers(df, "teams", 8)),
        "reconcile_accuracy": reconcile_accuracy,
        "reconcile_summary": lambda spark, sf_dir: reconcile.summary(reconcile_accuracy(spark, sf_dir)),
        **_on_text(),
    }


def oracle_sql() -> dict[str, str]:
    if text_oracles is None:
        return dict(ORACLES)
    return {**ORACLES, **text_oracles.ORACLES, **({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})}
