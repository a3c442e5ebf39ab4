"""``spark-submit``-able jobs: produce, land, store, stream, batch, compare."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession

from ballstats import schemas, session
from ballstats.functions import parse
from ballstats.operators import fanout, outcomes, phases, reconcile, seasons, stats
from ballstats.plans import batch
from ballstats.plans.catalog import JOBS, METRICS, STARTING
from ballstats.sources import files, tables, topics
from ballstats.streaming import jobs, routed, runner, stateful


MODES = ("update", "complete", "routed")
_MODE_HELP = "keep changed rows (update), whole results (complete), or sums of batches from one query (routed: run_rate only)"
LIVE = {
    "milestones": stateful.start_milestones,
    "top_scorers": stateful.start_top_scorers,
}
SUMMARIES = {
    "player_stats": stats.player_stats,
    "team_stats": stats.team_stats,
    "batsmen": lambda df: stats.top_performers(df, "batsmen", 5),
    "bowlers": lambda df: stats.top_performers(df, "bowlers", 5),
    "teams": lambda df: stats.top_performers(df, "teams", 8),
    "phase_economy": phases.phase_economy,
    "chase_vs_defend": lambda df: outcomes.chase_vs_defend(outcomes.match_outcomes(df)),
    "season_form": lambda df: seasons.season_form(seasons.season_runs(df)),
    "batter_consistency": lambda df: seasons.batter_consistency(seasons.season_runs(df)),
}


def _arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="ballstats", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, text: str, broker: bool = False) -> argparse.ArgumentParser:
        added = commands.add_parser(name, help=text)
        if broker:
            where = added.add_mutually_exclusive_group(required=True)
            where.add_argument("--servers", help="Kafka bootstrap servers")
            where.add_argument("--topics", help="directory with one topic=<name> folder per topic")
            if name != "produce":
                added.add_argument("--max-offsets", type=int, help="Kafka messages that a trigger takes in at most")
                added.add_argument("--max-files", type=int, default=1000, help="files that a trigger takes in at most")
        return added

    produce = command("produce", "send the rows of a CSV to all topics", broker=True)
    produce.add_argument("csv")
    produce.add_argument("--rejected", help="directory for rows with a wrong number of fields, which otherwise are sent as far as they go")
    for name, text in (("land", "land topics in tables"), ("store", "store raw deliveries")):
        added = command(name, text, broker=True)
        added.add_argument("path")
        added.add_argument("--once", action="store_true", help="take in what is there, and end")
        if name == "land":
            added.add_argument("--jdbc", help="land in a database: JSON file with the JDBC options")
    stream = command("stream", "run the queries of a job live", broker=True)
    stream.add_argument("job", choices=JOBS)
    stream.add_argument("path")
    stream.add_argument("--once", action="store_true", help="take in what is there, and end")
    stream.add_argument("--console", action="store_true", help="print results instead of storing them")
    stream.add_argument("--rows", type=int, default=50, help="rows that --console prints of a result")
    stream.add_argument("--mode", choices=MODES, default="update", help=_MODE_HELP)
    live = command("live", "tell milestones, or the top scorers of touched innings, as they come", broker=True)
    live.add_argument("what", choices=LIVE)
    live.add_argument("path")
    live.add_argument("--once", action="store_true", help="take in what is there, and end")
    players = command("players", "compute player, team and season summaries of a CSV")
    players.add_argument("csv")
    players.add_argument("what", choices=SUMMARIES)
    players.add_argument("--out", help="directory to write the result to; shown if left out")
    players.add_argument("--rows", type=int, default=50, help="rows that are shown")
    run = command("batch", "run the queries of a job over landed tables")
    run.add_argument("job", choices=JOBS)
    source = run.add_mutually_exclusive_group(required=True)
    source.add_argument("--landed", help="path given to 'land'")
    source.add_argument("--jdbc", help="JSON file with the JDBC options, without dbtable")
    run.add_argument("--out", help="directory to write results to; shown if left out")
    compare = command("compare", "how far stored stream results agree with batch over landed tables")
    compare.add_argument("job", choices=JOBS)
    compare.add_argument("stream_path")
    compare.add_argument("landed")
    compare.add_argument("--mode", choices=MODES, default="update", help="the one given to 'stream'")
    compare.add_argument("--differences", action="store_true", help="show the keys that differ, too")
    return parser


def _jdbc(path: str) -> dict[str, str]:
    with open(path) as options:
        return json.load(options)


def _landed(spark: SparkSession, args: argparse.Namespace, topic: str) -> DataFrame:
    if getattr(args, "jdbc", None):
        return parse.typed(tables.read_jdbc(spark, {**_jdbc(args.jdbc), "dbtable": topic}))
    return parse.typed(runner.read_landed(spark, args.landed, topic))


def _batch(spark: SparkSession, args: argparse.Namespace) -> dict[str, DataFrame]:
    by_topic: dict[str, list[str]] = {}
    for name in JOBS[args.job]:
        by_topic.setdefault(METRICS[name].topic, []).append(name)
    results: dict[str, DataFrame] = {}
    for topic, names in by_topic.items():
        results |= batch.run(_landed(spark, args, topic), names)
    return results


def main(argv: list[str] | None = None) -> None:
    args = _arguments().parse_args(argv)
    spark = session.build(f"ballstats-{args.command}")
    beside = session.for_streams(spark)
    once = runner.ONCE if getattr(args, "once", False) else None

    def messages(*names: str, starting: str = "earliest") -> DataFrame:
        if args.servers:
            limits = {"starting": starting, "max_offsets_per_trigger": args.max_offsets}
            return topics.stream_kafka(beside, args.servers, names, **limits)
        return topics.stream_topic_files(beside, args.topics, names, args.max_files)

    if args.command == "produce":
        if args.rejected:
            good, bad = files.split_csv(spark, args.csv)
            bad.write.mode("append").parquet(args.rejected)
        else:
            good = files.read_csv(spark, args.csv)
        sent = fanout.fan_out(good)
        if args.servers:
            topics.write_kafka(sent, args.servers)
        else:
            topics.write_topic_files(sent, args.topics)
    elif args.command == "land":
        source = messages(*schemas.TOPIC_FIELDS)
        if args.jdbc:
            query = runner.start_landing_jdbc(source, _jdbc(args.jdbc), args.path, once)
        else:
            query = runner.start_landing(source, args.path, once)
        query.awaitTermination()
    elif args.command == "store":
        runner.start_store(messages(schemas.RAW_TOPIC), args.path, once).awaitTermination()
    elif args.command == "stream":
        starting = STARTING[args.job]
        given = lambda topic: messages(topic, starting=starting)
        if args.console:
            running = jobs.start_job(given, args.job, args.path, once, rows=args.rows)
        else:
            running = jobs.start_job(given, args.job, args.path, once, mode=args.mode)
        if once:
            for query in running:
                query.awaitTermination()
        else:
            runner.wait_for_any(beside)
    elif args.command == "live":
        LIVE[args.what](runner.decoded(messages("runs"), "runs"), args.path, once).awaitTermination()
    elif args.command == "players":
        result = SUMMARIES[args.what](parse.typed(files.split_csv(spark, args.csv)[0]))
        if args.out:
            result.write.mode("overwrite").parquet(args.out)
        else:
            result.show(args.rows, truncate=False)
    elif args.command == "batch":
        for name, result in _batch(spark, args).items():
            if args.out:
                result.write.mode("overwrite").parquet(f"{args.out}/{name}")
            else:
                print(f"=== {name} ===")
                result.show(truncate=False)
    else:
        pairs = {}
        for name, result in _batch(spark, args).items():
            pairs[name] = (result, jobs.read_job(spark, args.job, name, args.stream_path, args.mode))
        details = batch.stored(reconcile.report(pairs), "report")
        details.show(truncate=False)
        reconcile.summary(details).show(truncate=False)
        if args.differences:
            for name, both in pairs.items():
                ours, theirs = (batch.stored(result, name) for result in both)
                print(f"=== {name}: keys that differ ===")
                reconcile.difference(ours, theirs, METRICS[name].keys or tuple(ours.columns)).show(50, truncate=False)


if __name__ == "__main__":
    main()
