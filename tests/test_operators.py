from random import Random

import pytest
from pyspark.sql import functions as F

from ballstats.functions import parse
from ballstats.operators import fanout, landing, metrics, reconcile, stats, topk
from ballstats.plans import batch
from ballstats.plans.catalog import JOBS, METRICS
from tests.helpers import deliveries, plan, rows

SCORES = "match_id string, batting_team string, innings int, striker string, total_runs bigint"


def test_tied_top_scorers_are_all_returned(spark):
    df = spark.createDataFrame(
        [
            ("M1", "A", 1, "a", 5), ("M1", "A", 1, "b", 5), ("M1", "A", 1, "c", 4), ("M1", "B", 2, "d", 0),
            (None, "A", 1, "e", 9), ("M2", None, 1, "f", 9), ("M2", "A", None, "g", 9), ("M2", "A", 1, "h", None),
        ],
        SCORES,
    )
    want = [("M1", "A", 1, "a", 5), ("M1", "A", 1, "b", 5), ("M1", "B", 2, "d", 0)]
    assert rows(topk.top_scorers(df)) == want
    assert rows(topk.top_scorers_by_join(df)) == want


def test_rank_form_equals_join_form(spark):
    random = Random(2)

    def pick(values):
        return None if random.random() < 0.05 else random.choice(values)

    data = [
        (pick(["M1", "M2", "M3"]), pick(["A", "B"]), pick([1, 2]), pick("abcdefgh"), pick([0, 1, 2, 4, 6]))
        for _ in range(3000)
    ]
    df = spark.createDataFrame(data, SCORES.replace("total_runs bigint", "runs_of_bat int"))
    scores = metrics.scores_by_innings(df)
    assert rows(topk.top_scorers(scores)) == rows(topk.top_scorers_by_join(scores)) != []


def test_rank_is_cut_before_the_shuffle(spark, tmp_path):
    deliveries(spark, {}).write.parquet(str(tmp_path / "d"))
    df = METRICS["top_scorer_match_innings"].aggregate(parse.typed(spark.read.parquet(str(tmp_path / "d"))))
    text = plan(topk.top_scorers(df))
    assert text.count("FileScan") == 1
    assert text.count("Exchange hashpartitioning") == 2
    assert text.count("WindowGroupLimit") == 2


def test_one_match_with_most_deliveries(spark):
    """A third and more of all rows under one key; sums are exact, and few rows are shuffled."""
    base = spark.range(200_000).selectExpr(
        "if(id % 3 < 2, 'HOT', concat('M', id % 97)) match_id", "'A' batting_team", "'B' bowling_team",
        "'1' innings", "'3.1' over", "if(id % 3 < 2, 'hot', concat('p', id % 11)) striker", "'b' bowler",
        "cast(id % 7 as string) runs_of_bat", "'0' extras", "'' wicket_type", "'' player_dismissed",
    )
    typed = parse.typed(base)
    got = {row.striker: row.total_runs for row in metrics.runs_by_striker_and_team(typed).collect()}
    assert got["hot"] == sum(i % 7 for i in range(200_000) if i % 3 < 2)
    best = {row.match_id: row for row in METRICS["top_scorer_match_innings"].batch(typed).collect()}
    assert best["HOT"].total_runs == got["hot"]
    assert len(best) == 98
    players = {row.player_name: row for row in stats.player_stats(typed).collect()}
    assert players["hot"].runs_scored == got["hot"] and players["hot"].matches_played == 1
    assert players["b"].matches_played == 98


def test_rollup_gives_the_same_metrics(spark):
    random = Random(3)
    changes = [
        {
            "match_id": random.choice(["M1", "M2", None]),
            "batting_team": random.choice("AB"),
            "innings": random.choice("12"),
            "over": random.choice(["0.1", "5.6", "6.1", "19.2", None, "?"]),
            "striker": random.choice("abcd"),
            "runs_of_bat": random.choice(["0", "1", "4", "", None]),
            "extras": random.choice(["0", "1", ""]),
        }
        for _ in range(800)
    ]
    typed = parse.typed(deliveries(spark, *changes))
    names = [name for names in JOBS.values() for name in names]
    shared = batch.run(typed, names)
    for name in names:
        assert rows(shared[name]) == rows(METRICS[name].batch(typed)), name


def test_results_are_ordered(spark):
    typed = parse.typed(
        deliveries(
            spark,
            {"striker": "b", "runs_of_bat": "4"}, {"striker": "c", "runs_of_bat": "6"},
            {"striker": "a", "runs_of_bat": "4"}, {"striker": "d", "match_id": "M0"},
        )
    )
    assert [r.striker for r in METRICS["highest_scorers"].batch(typed).collect()] == ["c", "a", "b", "d"]
    assert [r.match_id for r in METRICS["run_rate_match"].batch(typed).collect()] == ["M0", "M1"]


def test_top_is_not_a_global_sort(spark):
    df = spark.range(100).selectExpr("cast(id as string) name", "id % 10 n")
    top = topk.top_positive(df, "n", "name", 3)
    assert [row.name for row in top.collect()] == ["19", "29", "39"]
    assert "TakeOrderedAndProject" in plan(top) and "rangepartitioning" not in plan(top)
    assert topk.top_positive(df.where("n = 0"), "n", "name", 3).count() == 0


def test_player_totals_and_stats_agree(spark):
    typed = parse.typed(
        deliveries(
            spark,
            {"striker": "a", "bowler": "b", "runs_of_bat": "4"},
            {"striker": "a", "bowler": "b", "runs_of_bat": "2", "match_id": "M2"},
            {"striker": "b", "bowler": "a", "wicket_type": "bowled", "player_dismissed": "b"},
            {"striker": "c", "bowler": "a", "wicket_type": "run out", "player_dismissed": "z"},
            {"striker": None, "bowler": "d", "runs_of_bat": "3"},
        )
    )
    joined = stats.player_totals(stats.runs_by_player(typed), stats.wickets_by_player(typed))
    assert rows(joined) == [("a", 6, 2), ("b", 1, 0), ("c", 1, 0), (None, 3, 0)]
    full = {row.player_name: row for row in stats.player_stats(typed).collect()}
    a = full["a"]
    assert (a.matches_played, a.runs_scored, a.wickets_taken) == (2, 6, 2)
    assert (a.batting_average, str(a.bowling_average), str(a.strike_rate), str(a.economy_rate)) == (
        None, "1.00", "300.00", "6.00",
    )
    assert str(full["b"].batting_average) == "1.00"
    # Only ever named as out: a player, but not seen in a match.
    assert (full["z"].matches_played, full["z"].runs_scored, str(full["z"].batting_average)) == (0, 0, "0.00")
    assert full[None].runs_scored == 3
    for name, runs, taken in joined.collect():
        assert (full[name].runs_scored, full[name].wickets_taken) == (runs, taken)


def test_non_striker_has_played(spark):
    typed = parse.typed(deliveries(spark, {}).withColumn("non_striker", F.lit("n")))
    played = {row.player_name: row.matches_played for row in stats.player_stats(typed).collect()}
    assert played == {"a": 1, "b": 1, "n": 1}


def test_player_and_team_stats_scan_once(spark, tmp_path):
    deliveries(spark, {}).write.parquet(str(tmp_path / "d"))
    typed = parse.typed(spark.read.parquet(str(tmp_path / "d")))
    for df in (stats.player_stats(typed), stats.team_stats(typed)):
        assert plan(df).count("FileScan") == 1
        assert "Join" not in plan(df)


def test_team_stats(spark):
    def innings(match, team, other, runs):
        return {"match_id": match, "batting_team": team, "bowling_team": other, "runs_of_bat": runs}

    typed = parse.typed(
        deliveries(
            spark,
            innings("M1", "A", "B", "6"), innings("M1", "B", "A", "4"),  # A wins
            innings("M2", "A", "B", "2"), innings("M2", "B", "A", "2"),  # tie
            innings("M3", "A", "C", "1"),  # no second innings
        )
    )
    got = {row.team_name: row for row in stats.team_stats(typed).collect()}
    assert tuple(got["A"])[1:5] == (3, 1, 9, 6) and str(got["A"].net_run_rate) == "0.000"
    assert tuple(got["B"])[1:5] == (2, 0, 6, 8) and str(got["B"].net_run_rate) == "-6.000"
    assert tuple(got["C"])[1:5] == (1, 0, 0, 1) and got["C"].net_run_rate is None
    assert rows(stats.team_wins(typed)) == [("A", 1, 33.33), ("B", 0, 0.0), ("C", 0, 0.0)]
    assert [r.team_name for r in stats.team_performance(stats.team_stats(typed)).collect()] == ["A", "B", "C"]


def test_matches_are_inserted_if_absent(spark):
    df = deliveries(
        spark,
        {"venue": "W"}, {"venue": "V"},
        {"match_id": "M2"}, {"match_id": "M2", "venue": "A"}, {"match_id": "M2"},
        {"match_id": None},
    )
    found = landing.matches(df)
    assert rows(found) == [("M1", "2022", "V"), ("M2", "2022", "V1")]
    existing = spark.createDataFrame([("M1", "old")], "match_id string, venue string")
    assert [row.match_id for row in landing.absent_matches(found, existing).collect()] == ["M2"]
    today = spark.range(1).select(F.current_date()).first()[0]
    assert landing.with_ingest_date(found).first().ingest_date == today


def test_matches_do_not_sort_the_deliveries(spark, tmp_path):
    deliveries(spark, {}).write.parquet(str(tmp_path / "d"))
    text = plan(landing.matches(spark.read.parquet(str(tmp_path / "d"))))
    steps = [line for line in text.splitlines() if "Aggregate(" in line]
    assert "HashAggregate(keys=[match_id" in steps[-1] and "partial_count" in steps[-1]


def test_facts_take_defaults(spark):
    df = deliveries(spark, {"over": "12.4"}, {"extras": None, "over": "7"}, {"extras": "x", "over": None})
    got = landing.facts(df.drop("wides")).collect()
    assert [(r.over_num, r.ball_num, r.extras, r.wides, r.penalty_runs, r.non_striker) for r in got] == [
        (12, 4, 0, 0, 0, None), (7, None, 0, 0, 0, None), (None, None, None, 0, 0, None),
    ]
    assert len(got[0]) == 18  # 17 columns and the season to partition by


def test_facts_are_appended_by_season(spark, tmp_path):
    path = str(tmp_path / "facts")
    for season in ("2021", "2022"):
        landing.write_facts(landing.facts(deliveries(spark, {"season": season})), path)
    facts = spark.read.parquet(path)
    assert facts.count() == 2
    assert "PartitionFilters: [isnotnull(season" in plan(facts.where("season = 2022"))


def test_landed_tables_are_pruned_and_filtered_in_the_scan(spark, tmp_path):
    landing.land(fanout.fan_out(deliveries(spark, {"over": "5.6"}, {"over": "6.1"})), str(tmp_path), 0)
    rate = METRICS["run_rate_powerplay"].batch(parse.typed(landing.read_landed(spark, str(tmp_path), "rate")))
    scan = next(line for line in plan(rate).splitlines() if "FileScan" in line)
    assert "table" in scan.split("PartitionFilters: ")[1].split("]")[0]
    assert rows(rate) == [("A", "M1", 1, 1, 1, 6.0)]
    detail = rate._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "LessThan(over,6.0)" in detail
    assert "struct<match_id:string,batting_team:string,innings:int,over:float,runs_of_bat:int,extras:int>" in detail


def test_orphans(spark):
    df = deliveries(spark, {}, {}, {"match_id": "M2"}, {"match_id": None})
    known = spark.createDataFrame([("M2",)], "match_id string")
    assert rows(landing.orphan_counts(df, known)) == [("M1", 2), (None, 1)]
    assert landing.orphans(df, known).count() == 3


@pytest.mark.parametrize(
    ("left", "right", "want"),
    [
        ([("a", 1), ("b", 2)], [("b", 2), ("a", 1)], (2, 2, 2, 100.0)),
        ([("a", 1), ("b", 2), ("b", 2)], [("b", 2)], (3, 1, 1, 100 / 3)),
        ([("a", 1), (None, None)], [("a", 2), (None, None)], (2, 2, 1, 50.0)),
        ([("a", 1)], [], (1, 0, 0, 0.0)),
        ([], [("a", 1)], (0, 1, 0, 0.0)),
        ([], [], (0, 0, 0, 0.0)),
    ],
)
def test_reconcile(spark, left, right, want):
    a, b = (spark.createDataFrame(side, "k string, n int") for side in (left, right))
    row = reconcile.reconcile("x", a, b.select("n", "k")).first()
    assert row.analysis_type == "x"
    assert tuple(row)[1:4] == want[:3] and row.accuracy == pytest.approx(want[3])
    assert a.intersectAll(b).count() == want[2]


def test_reconcile_different_columns_and_summary(spark):
    a = spark.createDataFrame([(1,), (2,)], "n int")
    b = a.withColumnRenamed("n", "m")
    report = reconcile.report({"same": (a, a), "other": (a, b), "empty": (a, a.where("false"))})
    got = {row.analysis_type: row for row in report.collect()}
    assert got["other"].accuracy == 0.0 and got["other"].matching_records == 0
    assert tuple(reconcile.summary(report).first()) == (2, 4, 4, 50.0)


def _scores(spark, *given):
    return spark.createDataFrame(list(given), "striker string, team string, runs bigint")


def test_difference_of_results(spark):
    same = [(f"p{k}", "A", k) for k in range(200)]
    ours = _scores(spark, *same, ("x", "A", 1), ("y", None, 2), ("z", "A", None), ("twice", "A", 3), ("twice", "A", 3))
    theirs = _scores(spark, *reversed(same), ("x", "A", 5), ("y", None, 2), ("z", "A", 0), ("twice", "A", 3), (None, "A", 9))
    found = reconcile.difference(ours, theirs.select("runs", "team", "striker"), ["striker", "team"])
    assert rows(found.select("striker", "batch.runs", "stream.runs", "batch_rows", "stream_rows")) == [
        ("twice", 3, None, 1, 0), ("x", 1, 5, 1, 1), ("z", None, 0, 1, 1), (None, None, 9, 0, 1),
    ]
    assert reconcile.difference(ours, ours, ["striker", "team"]).count() == 0
    assert reconcile.difference(ours.where("false"), ours.where("false"), ["striker"]).count() == 0
    with pytest.raises(ValueError):
        reconcile.difference(ours, theirs.drop("runs"), ["striker"])


def test_only_unequal_buckets_are_compared(spark):
    ours = _scores(spark, *((f"p{k}", "A", k) for k in range(500)))
    theirs = ours.where("striker <> 'p7'")
    buckets = reconcile.unequal_buckets(ours, theirs, ["striker"], 64)
    assert buckets.count() == 1
    # Null and absent values, or values that change places, are no equal rows.
    for left, right in (((None, "a"), ("a", None)), (("a", "b"), ("b", "a"))):
        both = [spark.createDataFrame([(*pair, 1)], "striker string, team string, runs bigint") for pair in (left, right)]
        assert reconcile.difference(*both, ["runs"]).count() == 1
