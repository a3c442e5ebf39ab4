"""Live queries with state of their own, routed batches, uncommitted batches."""

import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ballstats import session
from ballstats.functions import parse
from ballstats.operators import fanout, metrics
from ballstats.plans.catalog import JOBS, METRICS
from ballstats.sources import topics
from ballstats.streaming import routed, runner, sinks, stateful
from tests.helpers import deliveries, message, messages, plan, rows
from tests.test_streaming import _random_changes


def send(spark, path, topic, *changes):
    topics.write_topic_files(fanout.topic_messages(deliveries(spark, *changes).coalesce(1), topic), path)


def stream(spark, path, topic):
    return topics.stream_topic_files(session.for_streams(spark), path, [topic], 1)


def test_milestones_over_batches_and_a_restart(spark, tmp_path):
    inbox, out = str(tmp_path / "topics"), str(tmp_path / "out")
    parts = [_random_changes(seed, 120) for seed in range(5)]
    told = []
    for group in (parts[:3], parts[3:]):
        for part in group:
            send(spark, inbox, "runs", *part)
        query = stateful.start_milestones(runner.decoded(stream(spark, inbox, "runs"), "runs"), out, runner.ONCE, (20, 60, 10**6))
        runner.finish(query, 120)
        told.append(stateful.read_milestones(spark, out).count())
    assert len(sinks.committed(spark, f"{out}/data")) == 5 and 0 < told[0] < told[1]
    scores = metrics.scores_by_innings(parse.typed(deliveries(spark, *[c for part in parts for c in part])))
    want = [(*r[:4], mark) for r in scores.where("total_runs is not null").collect() for mark in (20, 60) if r.total_runs >= mark]
    assert rows(stateful.read_milestones(spark, out).select(*metrics.SCORE_KEYS, "milestone")) == sorted(want, key=repr)


def test_repeated_batch_of_milestones_replaces_itself(spark, tmp_path):
    write, out = sinks.part_writer(str(tmp_path)), spark.createDataFrame([("M", "A", 1, "a", 50, 51)], stateful.MILESTONE)
    for batch_id in (0, 1, 1):
        write(out, batch_id)
    assert sinks.read_parts(spark, str(tmp_path), stateful.MILESTONE).count() == 2
    assert sinks.read_parts(spark, str(tmp_path / "none"), stateful.MILESTONE).count() == 0


def test_state_goes_when_an_innings_is_over(spark, tmp_path):
    inbox, out = str(tmp_path / "topics"), str(tmp_path / "out")
    for _ in range(3):  # each is a batch of its own, long after the one before
        send(spark, inbox, "runs", {"runs_of_bat": "30"})
        query = stateful.start_milestones(runner.decoded(stream(spark, inbox, "runs"), "runs"), out, runner.ONCE, idle_ms=1)
        runner.finish(query, 120)
        send(spark, inbox, "runs", {"striker": "other", "runs_of_bat": "1"})
        runner.finish(stateful.start_milestones(runner.decoded(stream(spark, inbox, "runs"), "runs"), out, runner.ONCE, idle_ms=1), 120)
    assert stateful.read_milestones(spark, out).count() == 0


def test_top_scorers_write_touched_innings_only(spark, tmp_path):
    inbox, out = str(tmp_path / "topics"), str(tmp_path / "out")
    parts = [
        [{"match_id": f"M{k}", "striker": s, "runs_of_bat": r} for k in range(20) for s, r in (("a", "4"), ("b", "4"), (None, "1"))],
        [{"match_id": "M3", "striker": "b", "runs_of_bat": "2"}, {"match_id": "M4", "striker": None, "runs_of_bat": "3"}],
        [{"match_id": "M5", "striker": "c", "runs_of_bat": "x"}, {"match_id": None, "striker": "c"}],
    ]
    for part in parts:
        send(spark, inbox, "runs", *part)
        runner.finish(stateful.start_top_scorers(runner.decoded(stream(spark, inbox, "runs"), "runs"), out, runner.ONCE), 120)
    typed = parse.typed(deliveries(spark, *[c for part in parts for c in part]))
    assert rows(stateful.read_top_scorers(spark, out)) == rows(METRICS["top_scorer_match_innings"].batch(typed))
    written = [spark.read.parquet(f"{out}/data/kind=change/batch_id={n}").count() for n in range(3)]
    assert written == [20, 2, 0]


def test_partial_runs_are_summed_before_the_shuffle(spark):
    typed = parse.typed(deliveries(spark, *[{"runs_of_bat": "1"}] * 500).coalesce(1))
    assert [r.runs for r in stateful.partial_runs(typed).collect()] == [500]


BAD = [("rate", '{"match_id": "M1"}'), ("rate", "no JSON"), ("rate", "no JSON"), ("rate", None), ("other", "{}"), (None, "{}")]


def test_routed_metrics_and_quarantine(spark, tmp_path):
    inbox, out = str(tmp_path / "topics"), str(tmp_path / "out")
    changes = _random_changes(5, 200)
    good = [message("rate", **change) for change in changes]
    more = [("rate", good[0][1] + good[1][1]), ("rate", good[0][1] + " x")]
    source = [good[:100] + BAD[:3], good[100:] + more, BAD[3:4]]
    for part in source:
        topics.write_topic_files(messages(spark, *part).coalesce(1), inbox)
    query = routed.start(stream(spark, inbox, "rate"), out, runner.ONCE)
    runner.finish(query, 120)
    assert sorted(routed.counts(query).values()) == [(1, 1), (102, 2), (103, 3)]
    typed = parse.typed(deliveries(spark, *changes))
    for name in JOBS["run_rate"]:
        assert rows(routed.read_metric(spark, out, name)) == rows(METRICS[name].batch(typed)) != []
    assert rows(routed.problems(routed.read_rejected(spark, out))) == [("rate", "missing field", 1), ("rate", "not a JSON object", 5)]
    assert {(r.value, r.n) for r in routed.read_rejected(spark, out).collect()} >= {("no JSON", 2), (None, 1), (more[0][1], 1)}


def test_routed_messages_are_parsed_once(spark):
    checked = parse.checked(messages(spark, *BAD)).observe("seen", F.count("*"), F.count("problem"))
    found = plan(routed.routed(checked))
    assert found.count("from_json") == 1
    assert found.count("Exchange") == 1


def test_text_after_an_object_is_refused(spark):
    topic, good = message("runs")
    texts = [good, f" {good}\n", good + good, f"{good} junk", f"{good}]", f"{good}}}", f"{good},", f"{good},{good}", "[]", "5", "null", '"x"', good.replace('"', "'"), good[:-1]]
    texts += [f'{good},{{"_end":0}}', f'{good},{{"_end":0}}]', f'{good},"_end":1']
    given = messages(spark, *[(topic, text) for text in texts])
    assert parse.decode(given, topic).count() == 2
    assert [r.value for r in parse.malformed(given, topic).collect()] == texts[2:]
    told = parse.checked(given).select("value", "problem").collect()
    assert [r.value for r in told if r.problem is None] == texts[:2]
    assert {r.problem for r in told[2:]} == {"not a JSON object"}


def test_changes_that_are_not_committed_are_not_read(spark, tmp_path):
    path = str(tmp_path)
    write = sinks.change_writer(path, ("k",), fold_every=3)
    for batch_id in range(5):
        write(spark.createDataFrame([("a", batch_id), (f"k{batch_id}", 1)], "k string, n bigint"), batch_id)
    whole = {("a", 4), *((f"k{n}", 1) for n in range(5))}
    assert set(rows(sinks.read_changes(spark, path, ("k",)))) == whole
    Path(f"{path}/kind=change/batch_id=4/_SUCCESS").unlink()
    assert set(rows(sinks.read_changes(spark, path, ("k",)))) == {("a", 3), *((f"k{n}", 1) for n in range(4))}
    Path(f"{path}/kind=fold/batch_id=2/_SUCCESS").unlink()  # the changes are still there
    assert set(rows(sinks.read_changes(spark, path, ("k",)))) == {("a", 3), *((f"k{n}", 1) for n in range(4))}
    write(spark.createDataFrame([("a", 7)], "k string, n bigint"), 2)  # the batch is repeated, and folds again
    assert ("a", 3) in rows(sinks.read_changes(spark, path, ("k",)))
    assert spark.read.parquet(f"{path}/kind=fold/batch_id=2").where("k = 'a'").first().n == 7
    shutil.rmtree(path)
    with pytest.raises(ValueError, match="no result"):
        sinks.read_changes(spark, path, ("k",))
