import json

import pytest
from pyspark.sql import functions as F

from ballstats import schemas
from ballstats.functions import parse, wickets
from ballstats.operators import fanout, landing, metrics
from ballstats.streaming import routed
from tests.helpers import FIELDS, deliveries, message, messages, plan, rows


def test_blank_wicket_is_a_flag_but_no_wicket(spark):
    df = deliveries(spark, {}, {"wicket_type": None}, {"wicket_type": "bowled"})
    assert rows(metrics.wicket_flags(df)) == [(0, 1), (1, 2)]
    assert rows(metrics.wickets_by_bowler(df)) == [("b", 1)]


def test_run_outs_count_for_the_bowler_by_default(spark):
    df = deliveries(spark, {"wicket_type": "run out"}, {"wicket_type": "lbw"})
    assert rows(metrics.wickets_by_bowler(df)) == [("b", 2)]
    assert rows(metrics.wickets_by_bowler(df, credited_only=True)) == [("b", 1)]


def test_caught_needs_a_known_batter(spark):
    df = deliveries(
        spark,
        {"wicket_type": "caught", "player_dismissed": "x"},
        {"wicket_type": "caught", "player_dismissed": ""},
        {"wicket_type": "caught", "player_dismissed": None},
        {"wicket_type": "bowled", "player_dismissed": "y"},
    )
    assert rows(metrics.caught_batters(df)) == [("x",)]
    assert rows(metrics.dismissal_types(df)) == [("bowled", 1), ("caught", 3)]


def test_unreadable_runs_leave_the_ball(spark):
    df = parse.typed(deliveries(spark, {"runs_of_bat": ""}, {"runs_of_bat": "4"}, {"runs_of_bat": "x"}))
    assert rows(metrics.run_rate_striker(df)) == [("a", 4, 3, 8.0)]


def test_powerplay_boundary_and_unknown_over(spark):
    df = parse.typed(deliveries(spark, {"over": "5.6"}, {"over": "6.1"}, {"over": None}, {"over": "?"}))
    assert [row[4] for row in rows(metrics.run_rate_powerplay(df))] == [1]
    assert [row[4] for row in rows(metrics.run_rate_match(df))] == [4]


def test_wides_are_balls_unless_left_out(spark):
    df = deliveries(spark, {"extras": "1", "wides": "1"}, {"extras": "1", "noballs": "1"}, {})
    assert parse.typed(df).agg(F.sum("balls")).first()[0] == 3
    assert parse.typed(df, legal_only=True).agg(F.sum("balls")).first()[0] == 1


def test_null_key_is_a_group_of_its_own(spark):
    df = parse.typed(deliveries(spark, {"striker": None}, {"striker": None, "runs_of_bat": "3"}, {}))
    assert rows(metrics.runs_by_striker_and_team(df)) == [("a", "A", 1), (None, "A", 4)]


def test_field_names_of_other_feeds(spark):
    df = deliveries(spark, {"over": "7"}).withColumnsRenamed({"runs_of_bat": "runs_off_bat", "wides": "wide_runs"})
    df = df.drop("noballs").withColumns({"ball": F.lit("3"), "noball_runs": F.lit("1")})
    row = parse.typed(parse.canonical(df)).first()
    assert (row.runs_of_bat, row.wides, row.noballs, round(row.over, 1)) == (1, 0, 1, 7.3)


def test_decode_keeps_readable_messages_only(spark):
    raw = messages(
        spark,
        message("rate"),
        message("rate", striker=None),
        message("rate", drop=["striker"]),
        ("rate", '{"match_id": 7, "unknown": 1}'),
        ("rate", "bad"),
        ("rate", '{"match_id": "M1", "inn'),
        ("rate", " "),
        ("rate", None),
    )
    got = parse.decode(raw, "rate")
    assert got.columns == schemas.TOPIC_FIELDS["rate"]
    assert [row.match_id for row in got.collect()] == ["M1", "M1", "M1", "7"]
    assert rows(parse.malformed(raw, "rate")) == [("bad",), ('{"match_id": "M1", "inn',)]


def test_decode_takes_bytes(spark):
    raw = messages(spark, message("runs")).withColumn("value", F.col("value").cast("binary"))
    assert parse.decode(raw, "runs").count() == 1


def test_messages_are_parsed_once(spark):
    raw = messages(spark, message("bowler"))
    df = metrics.caught_batters(parse.typed(parse.decode(raw, "bowler")))
    assert plan(df).count("from_json") == 1


def test_fan_out_gives_every_topic_its_fields(spark):
    sent = fanout.fan_out(deliveries(spark, {"wicket_type": None}))
    got = {topic: json.loads(value) for topic, value in sent.collect()}
    assert set(got) == {"deliveries_raw", "runs", "rate", "bowler"}
    assert got["deliveries_raw"] == {**FIELDS, "wicket_type": None}
    for topic, fields in schemas.TOPIC_FIELDS.items():
        assert list(got[topic]) == fields
        assert rows(fanout.topic_messages(deliveries(spark, {"wicket_type": None}), topic)) == [
            (topic, sent.where(F.col("topic") == topic).first().value)
        ]


def test_fan_out_skips_absent_columns_but_not_extras(spark):
    df = deliveries(spark, {}).drop("fielder")
    assert "fielder" not in json.loads(fanout.topic_messages(df, "bowler").first().value)
    try:
        fanout.topic_messages(df.drop("extras"), "rate").collect()
    except Exception as error:
        assert "extras" in str(error)
    else:
        raise AssertionError("extras may not be missing")


def test_fan_out_reads_once_and_does_not_shuffle(spark, tmp_path):
    deliveries(spark, {}).write.parquet(str(tmp_path / "d"))
    text = plan(fanout.fan_out(spark.read.parquet(str(tmp_path / "d"))))
    assert text.count("FileScan") == 1
    assert "Exchange" not in text


def test_validation(spark):
    raw = messages(
        spark,
        message("runs"),
        message("runs", striker=None),
        message("runs", drop=["striker"]),
        message("rate", drop=["extras"]),
        message("bowler"),
        ("x", "{}"),
        (None, "{}"),
        ("runs", "bad"),
        ("runs", None),
        ("runs", "[1]"),
    )
    got = [tuple(row) for row in landing.validate(raw).select("status", "problem").collect()]
    assert got == [
        ("valid", None),
        ("valid", None),
        ("quarantine", "missing field"),
        ("quarantine", "missing field"),
        ("valid", None),
        ("quarantine", "unknown topic"),
        ("quarantine", "unknown topic"),
        ("quarantine", "not a JSON object"),
        ("quarantine", "not a JSON object"),
        ("quarantine", "not a JSON object"),
    ]


@pytest.mark.parametrize("step", [landing.route, routed.routed])
def test_code_of_checked_messages_is_short_enough_to_be_compiled(spark, tmp_path, step):
    """The JVM interprets methods of more than 8000 bytes for ever."""
    path = str(tmp_path / "m")
    messages(spark, message("rate")).write.parquet(path)
    static = spark.newSession()
    static.conf.set("spark.sql.adaptive.enabled", "false")
    checked = static.read.parquet(path)
    checked = checked if step is landing.route else parse.checked(checked)
    codes = step(checked)._jdf.queryExecution().debug().codegenToSeq()
    sizes = [codes.apply(k)._3().maxMethodCodeSize() for k in range(codes.size())]
    assert 0 < max(sizes) < 8000, sizes


def test_presence(spark):
    df = spark.createDataFrame([(None,), ("",), ("x",)], "c string")
    assert [row[0] for row in df.select(wickets.present("c")).collect()] == [False, False, True]


def test_texts_are_one_object_and_nothing_else(spark):
    good = [
        '{"match_id":"M1"}', ' {"match_id":"M1"} \t\r\n', '{"match_id":"M]1"}', '{"match_id":["M1"],"over":"1]"}', "{}", '{"_end":1}',
        '{"match_id":"M1","over":[]}\n',
    ]
    bad = [
        "", " ", "null", "1", '"{}"', "[]", '[{"match_id":"M1"}]', '{"match_id":"M1"', '{"match_id":"M]1', '{"match_id":"M1"},', ',{"match_id":"M1"}',
        '{"match_id":"M1"} {"match_id":"M1"}', '{"match_id":"M1"},{"match_id":"M1"}', '{"match_id":"M1"}] x', '{"match_id":"M1"}] {}',
        '{"match_id":"M1"},{"_end":1}', '{"match_id":"M1"}]', '{"match_id":"]"}]}', '{"match_id":"M1"}x', '{"match_id":"M1"}}', None,
    ]
    texts = spark.createDataFrame([(text,) for text in good + bad], "value string")
    found = texts.select("value", F.size(parse.objects(F.col("value"), ["match_id", "over"])).alias("n")).collect()
    assert {row.value for row in found if row.n == 1} == set(good)
    assert {row.value for row in found if row.n == 0} == set(bad)


def test_texts_without_brackets_are_parsed_without_a_mark(spark):
    """Marking costs a hash, a copy and a second object per message."""
    texts = spark.createDataFrame([('{"match_id":"M1"}',)], "value string")
    made = plan(texts.select(parse.objects(F.col("value"), ["match_id"])))
    assert "CASE WHEN Contains(value" in made or "CASE WHEN contains(value" in made
    assert "EndsWith(" in made or "endswith(" in made
