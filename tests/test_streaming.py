"""Streams against their batch twins, over several micro-batches and across restarts."""

from random import Random

import pytest
from pyspark.sql import functions as F

from ballstats import __main__ as app
from ballstats.functions import parse
from ballstats.operators import fanout, landing
from ballstats.plans.catalog import JOBS, METRICS
from ballstats.sources import topics
from ballstats.streaming import jobs, runner, sinks, stateful
from tests.helpers import FIELDS, deliveries, message, messages, plan, rows

NAMES = [*dict.fromkeys(name for names in JOBS.values() for name in names), "player_runs_upsert", "player_wickets_upsert"]


def _random_changes(seed, n=300):
    random = Random(seed)
    return [
        {
            "match_id": random.choice(["M1", "M2", "M3"]),
            "batting_team": random.choice("AB"),
            "innings": random.choice("12"),
            "over": random.choice(["0.1", "5.6", "6.1", None]),
            "striker": random.choice("abcde"),
            "bowler": random.choice("vwxyz"),
            "runs_of_bat": random.choice(["0", "1", "4", "6", ""]),
            "wicket_type": random.choice(["", "", "caught", "bowled", "run out"]),
            "player_dismissed": random.choice(["", "a", "b"]),
        }
        for _ in range(n)
    ]


@pytest.fixture(scope="module")
def published(spark, tmp_path_factory):
    """Topic files written in four goes, so that a topic has four files and more."""
    path = str(tmp_path_factory.mktemp("topics"))
    parts = [_random_changes(seed) for seed in range(4)]
    for part in parts:
        topics.write_topic_files(fanout.fan_out(deliveries(spark, *part).coalesce(1)), path)
    typed = parse.typed(deliveries(spark, *[change for part in parts for change in part]))
    return path, typed


def _read(spark, path, topic, files=1):
    return runner.decoded(topics.stream_topic_files(spark, path, [topic], files), topic)


@pytest.mark.parametrize("mode", ["complete", "update"])
@pytest.mark.parametrize("name", NAMES)
def test_stream_equals_batch(spark, published, tmp_path, name, mode):
    path, typed = published
    metric = METRICS[name]
    mode = mode if metric.keys else "append"
    query = runner.start_metric(_read(spark, path, metric.topic), metric, str(tmp_path), mode, runner.ONCE)
    runner.finish(query, 120)
    assert len(query.recentProgress) >= 4
    got = runner.read_metric(spark, metric, str(tmp_path), mode)
    assert rows(got) == rows(metric.batch(typed)) != []


@pytest.mark.parametrize(("name", "mode"), [("run_rate_match", "complete"), ("player_runs_upsert", "update")])
def test_restart_continues_from_the_checkpoint(spark, tmp_path, name, mode):
    metric, inbox, out = METRICS[name], str(tmp_path / "topics"), str(tmp_path / "out")
    parts = [_random_changes(seed, 100) for seed in (10, 11, 12)]
    for part in parts:
        topics.write_topic_files(fanout.fan_out(deliveries(spark, *part).coalesce(1)), inbox)
        runner.finish(runner.start_metric(_read(spark, inbox, metric.topic), metric, out, mode, runner.ONCE), 120)
    typed = parse.typed(deliveries(spark, *[change for part in parts for change in part]))
    assert rows(runner.read_metric(spark, metric, out, mode)) == rows(metric.batch(typed))


def test_replayed_batch_replaces_itself(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "k string, n bigint")
    change, snapshot = sinks.change_writer(str(tmp_path / "c"), ("k",)), sinks.snapshot_writer(str(tmp_path / "s"))
    for batch_id, factor in ((0, 1), (1, 5), (1, 5)):
        change(df.withColumn("n", F.col("n") * factor), batch_id)
        snapshot(df.withColumn("n", F.col("n") * factor), batch_id)
    assert rows(sinks.read_changes(spark, str(tmp_path / "c"), ("k",))) == [("a", 5)]
    assert rows(sinks.read_snapshot(spark, str(tmp_path / "s"))) == [("a", 5)]


def test_changes_are_folded(spark, tmp_path):
    """Ten triggers, folded after every second one; every trigger is repeated, as after a failure."""
    path, random, want = str(tmp_path), Random(5), {}
    write = sinks.change_writer(path, ("k", "m"), fold_every=2)
    for batch_id in range(10):
        changed = {(random.choice(["a", "b", None]), random.randrange(3)): random.choice([None, batch_id]) for _ in range(3)}
        want |= changed
        batch = spark.createDataFrame([(*key, n) for key, n in changed.items()], "k string, m int, n bigint")
        write(batch, batch_id)
        write(batch, batch_id)
        got = rows(sinks.read_changes(spark, path, ("k", "m")))
        assert got == sorted(((*key, n) for key, n in want.items()), key=repr), batch_id
    assert {p.name for p in (tmp_path / "kind=fold").iterdir()} == {"batch_id=7", "batch_id=9"}
    assert {p.name for p in (tmp_path / "kind=change").iterdir()} == {"batch_id=8", "batch_id=9"}
    write(batch, 10)
    current = sinks.read_changes(spark, path, ("k", "m"))
    assert "SortAggregate" not in plan(current)
    # Only the last fold and the changes since are read.
    assert {file.rsplit("/", 2)[1] for file in current.inputFiles()} == {"batch_id=9", "batch_id=10"}
    assert {file.rsplit("/", 3)[1] for file in current.inputFiles() if "batch_id=9" in file} == {"kind=fold"}


def test_old_snapshots_are_removed(spark, tmp_path):
    write = sinks.snapshot_writer(str(tmp_path), kept=2)
    for batch_id in range(5):
        write(spark.createDataFrame([("a", batch_id)], "k string, n int"), batch_id)
    assert {p.name for p in tmp_path.iterdir()} == {"batch_id=3", "batch_id=4"}
    assert rows(sinks.read_snapshot(spark, str(tmp_path))) == [("a", 4)]


def test_malformed_messages_change_no_aggregate(spark, tmp_path):
    path = str(tmp_path / "topics")
    topics.write_topic_files(messages(spark, message("rate"), ("rate", "bad"), ("rate", "")), path)
    metric = METRICS["run_rate_striker"]
    runner.finish(runner.start_metric(_read(spark, path, "rate"), metric, str(tmp_path / "o"), trigger=runner.ONCE), 60)
    assert rows(runner.read_metric(spark, metric, str(tmp_path / "o"))) == [("a", 1, 1, 6.0)]


def test_shared_query_serves_all_metrics_on_runs(spark, published, tmp_path):
    path, typed = published
    query = jobs.start_shared(
        lambda topic: topics.stream_topic_files(spark, path, [topic], 1), str(tmp_path), runner.ONCE
    )
    runner.finish(query, 120)
    for name in (*JOBS["run_rate"], *JOBS["overall_scorers"], *JOBS["match_scorers"]):
        assert rows(jobs.read_shared(spark, str(tmp_path), name)) == rows(METRICS[name].batch(typed)), name


def test_landing_routes_by_topic(spark, tmp_path):
    inbox, out = str(tmp_path / "topics"), str(tmp_path / "out")
    first = messages(spark, message("runs"), message("rate"), message("bowler"), message("runs", drop=["striker"]))
    second = messages(spark, message("runs", runs_of_bat="", striker=None), ("rate", "bad"), message("rate", extras=7))
    for part in (first, second):
        topics.write_topic_files(part, inbox)
        stream = topics.stream_topic_files(spark, inbox, ["runs", "rate", "bowler"])
        runner.finish(runner.start_landing(stream, out, runner.ONCE), 60)
    tables = {table: runner.read_landed(spark, out, table) for table in landing.TABLES}
    assert tables["runs"].dtypes[2:4] == [("innings", "int"), ("over", "float")]
    assert [row[4:] for row in rows(tables["runs"])] == [("a", 1), (None, None)]
    assert sorted(row.extras for row in tables["rate"].collect()) == [0, 7]
    assert tables["bowler"].count() == 1
    assert sorted(row.problem for row in tables["quarantine"].collect()) == ["missing field", "not a JSON object"]
    landing.land(second, f"{out}/data", 1)  # the same batch once more
    assert runner.read_landed(spark, out, "rate").count() == 2


def test_unknown_topic_is_quarantined(spark, tmp_path):
    landing.land(messages(spark, ("x", "{}"), message("runs")), str(tmp_path), 0)
    assert rows(landing.read_landed(spark, str(tmp_path), "quarantine")) == [("x", "{}", "unknown topic")]
    assert landing.read_landed(spark, str(tmp_path), "runs").count() == 1


def test_landing_in_a_database(spark, tmp_path, monkeypatch):
    written = {}
    monkeypatch.setattr(
        runner.tables, "append_jdbc", lambda df, options: written.update({options["dbtable"]: (df.columns, rows(df))})
    )
    inbox, out = str(tmp_path / "topics"), str(tmp_path / "out")
    topics.write_topic_files(messages(spark, message("runs"), message("rate"), ("bowler", "bad")), inbox)
    stream = topics.stream_topic_files(spark, inbox, ["runs", "rate", "bowler"])
    runner.finish(runner.start_landing_jdbc(stream, {"url": "u"}, out, runner.ONCE), 60)
    assert {table: len(found) for table, (_, found) in written.items()} == {"runs": 1, "rate": 1, "bowler": 0}
    assert written["rate"][0] == ["match_id", "batting_team", "innings", "over", "striker", "runs_of_bat", "extras"]
    assert [row.value for row in spark.read.parquet(f"{out}/quarantine").collect()] == ["bad"]


def test_store_inserts_each_match_once(spark, tmp_path):
    inbox, out = str(tmp_path / "topics"), str(tmp_path / "out")
    for part in ([{}, {"match_id": "M2"}], [{"venue": "elsewhere"}, {"match_id": "M3", "season": "2023"}]):
        topics.write_topic_files(fanout.fan_out(deliveries(spark, *part), ["deliveries_raw"]), inbox)
        stream = topics.stream_topic_files(spark, inbox, ["deliveries_raw"])
        runner.finish(runner.start_store(stream, out, runner.ONCE), 60)
    dimension = landing.read_matches(spark, f"{out}/matches")
    assert rows(dimension.select("match_id", "season", "venue")) == [
        ("M1", "2022", "V1"), ("M2", "2022", "V1"), ("M3", "2023", "V1"),
    ]
    facts = spark.read.parquet(f"{out}/deliveries")
    assert facts.count() == 4
    assert landing.orphan_counts(facts, dimension).count() == 0


def test_raw_messages_with_other_names(spark):
    value = '{"match_id":"M1","over":"7","ball":"2","runs_off_bat":"3","wide_runs":"1","noball_runs":2}'
    row = landing.facts(parse.decode_raw(messages(spark, ("deliveries_raw", value)))).first()
    assert (row.over_num, row.ball_num, row.runs_of_bat, row.wides, row.noballs) == (7, 2, 3, 1, 2)


@pytest.mark.parametrize("name", ["run_rate_team", "top_scorer_match_innings", "caught_dismissals"])
def test_console(spark, published, tmp_path, capsys, name):
    path, typed = published
    metric = METRICS[name]
    runner.finish(runner.start_console(_read(spark, path, metric.topic, 100), metric, str(tmp_path), runner.ONCE, 50), 60)
    cells = [str(value) for value in metric.batch(typed).first()]
    lines = capsys.readouterr().out.splitlines()
    assert any([cell.strip() for cell in line.strip("|").split("|")] == cells for line in lines)


def test_metrics_sort_a_stream_in_complete_mode(spark, published, tmp_path):
    path, typed = published
    metric = METRICS["highest_scorers"]
    stream = metric.batch(_read(spark, path, "runs", 100))
    writer = stream.writeStream.outputMode("complete").format("memory").queryName("sorted_scorers")
    runner.finish(writer.option("checkpointLocation", str(tmp_path)).trigger(availableNow=True).start(), 60)
    assert spark.table("sorted_scorers").collect() == metric.batch(typed).collect()


def test_live_queries_until_one_ends(spark, published, tmp_path):
    path, typed = published
    running = jobs.start_job(lambda topic: topics.stream_topic_files(spark, path, [topic]), "bowling", str(tmp_path))
    try:
        assert {query.name for query in running} == set(JOBS["bowling"])
        for query in running:
            query.processAllAvailable()
        running[0].stop()
        runner.wait_for_any(spark, 30)
    finally:
        for query in running:
            query.stop()
        spark.streams.resetTerminated()
    got = jobs.read_job(spark, "bowling", "dismissal_types", str(tmp_path))
    assert rows(got) == rows(METRICS["dismissal_types"].batch(typed))


def test_application(spark, tmp_path, capsys):
    """CSV to topics to tables and stream results, and the comparison of the two."""
    csv = tmp_path / "d.csv"
    lines = [",".join(FIELDS), *(",".join({**FIELDS, "striker": s, "runs_of_bat": r}.values()) for s, r in ("a1", "b4"))]
    csv.write_text("\n".join(lines) + "\n")
    inbox, landed, live = (str(tmp_path / name) for name in ("topics", "landed", "live"))
    app.main(["produce", "--topics", inbox, str(csv)])
    app.main(["land", "--topics", inbox, landed, "--once"])
    app.main(["store", "--topics", inbox, str(tmp_path / "store"), "--once"])
    app.main(["stream", "--topics", inbox, "run_rate", live, "--once"])
    app.main(["batch", "run_rate", "--landed", landed, "--out", str(tmp_path / "out")])
    app.main(["batch", "match_scorers", "--landed", landed])
    app.main(["compare", "run_rate", live, landed, "--differences"])
    out = capsys.readouterr().out
    assert "100.0" in out and "run_rate_team: keys that differ" in out
    assert rows(spark.read.parquet(str(tmp_path / "out" / "run_rate_team"))) == [("A", 5, 2, 15.0)]


def test_application_live_and_routed(spark, tmp_path, capsys):
    csv = tmp_path / "d.csv"
    lines = [",".join(FIELDS), *(",".join({**FIELDS, "striker": s, "runs_of_bat": r}.values()) for s, r in (("a", "52"), ("b", "4"))), "M1,short"]
    csv.write_text("\n".join(lines) + "\n")
    inbox, routed_path, bad = (str(tmp_path / name) for name in ("topics", "routed", "bad"))
    app.main(["produce", "--topics", inbox, str(csv), "--rejected", bad])
    assert [r.value for r in spark.read.parquet(bad).collect()] == ["M1,short"]
    app.main(["stream", "--topics", inbox, "run_rate", routed_path, "--once", "--mode", "routed", "--max-files", "1"])
    assert rows(jobs.read_job(spark, "run_rate", "run_rate_team", routed_path, "routed")) == [("A", 56, 2, 168.0)]
    with pytest.raises(ValueError, match="bowling"):
        jobs.start_job(lambda topic: None, "bowling", routed_path, mode="routed")
    for what, read in (("milestones", stateful.read_milestones), ("top_scorers", stateful.read_top_scorers)):
        app.main(["live", "--topics", inbox, what, str(tmp_path / what), "--once"])
        assert [r.striker for r in read(spark, str(tmp_path / what)).collect()] == ["a"]
    app.main(["players", str(csv), "batsmen", "--rows", "1"])
    app.main(["players", str(csv), "phase_economy", "--out", str(tmp_path / "phases")])
    assert "only showing top 1 row" in capsys.readouterr().out
    assert spark.read.parquet(str(tmp_path / "phases")).count() == 1
