import pyarrow.parquet as pq
import pytest

from ballstats import session
from ballstats.functions import parse
from ballstats.operators import fanout, metrics
from ballstats.plans.catalog import METRICS
from ballstats.sources import files, tables, topics
from tests.helpers import FIELDS, deliveries, rows

HEADER = ",".join(FIELDS)


def test_csv_is_text_with_blanks(spark, tmp_path):
    (tmp_path / "d.csv").write_text(f"{HEADER}\n{','.join(FIELDS.values())}\n")
    df = files.read_csv(spark, str(tmp_path / "d.csv"))
    assert {kind for _, kind in df.dtypes} == {"string"}
    assert df.first().asDict() == FIELDS
    assert rows(metrics.wicket_flags(df)) == [(1, 1)]


def test_csv_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "d.csv").write_text(f"{HEADER}\n{','.join(FIELDS.values())}\n")
    stream = files.stream_csv(spark, str(tmp_path / "in"), list(FIELDS))
    writer = stream.writeStream.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True)
    writer.format("parquet").start(str(tmp_path / "out")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).first().asDict() == FIELDS


def test_kafka_options():
    assert topics.kafka_options("h:9092", ["runs", "rate"]) == {
        "kafka.bootstrap.servers": "h:9092",
        "subscribe": "runs,rate",
        "startingOffsets": "latest",
    }
    limited = topics.kafka_options("h:9092", ["runs"], "earliest", 10, 4)
    assert limited["startingOffsets"] == "earliest"
    assert (limited["maxOffsetsPerTrigger"], limited["minPartitions"]) == ("10", "4")


def test_jdbc_options():
    options = tables.jdbc_options("jdbc:x://h/db", "rate", "u", "p", driver="d")
    assert options["dbtable"] == "rate" and options["driver"] == "d" and int(options["fetchsize"]) > 1
    assert tables.split_options("id", 1, 9, 4) == {
        "partitionColumn": "id", "lowerBound": "1", "upperBound": "9", "numPartitions": "4",
    }


def test_topic_files(spark, tmp_path):
    path = str(tmp_path / "topics")
    sent = fanout.fan_out(deliveries(spark, {}, {"striker": "z"}))
    topics.write_topic_files(sent, path)
    assert rows(topics.read_topic_files(spark, path, ["runs", "rate"])) == rows(
        sent.where("topic in ('runs', 'rate')")
    )


def test_a_topic_file_can_be_read_by_several_tasks(spark, tmp_path):
    path = str(tmp_path / "topics")
    sent = spark.range(0, 60_000, 1, 1).selectExpr("'runs' as topic", "concat(sha2(cast(id as string), 256), id) as value")
    topics.write_topic_files(sent, path)
    (file,) = (tmp_path / "topics" / "topic=runs").glob("*.parquet")
    assert pq.ParquetFile(file).metadata.num_row_groups > 1
    assert rows(topics.read_topic_files(spark, path, ["runs"])) == rows(sent)


def test_spread_leaves_large_inputs_alone(spark):
    cores = spark.sparkContext.defaultParallelism
    assert files.spread(spark.range(0, 100, 1, 1)).rdd.getNumPartitions() == cores
    many = spark.range(0, 100, 1, cores)
    assert files.spread(many) is many


def test_metrics_over_a_view(spark):
    tables.as_view(parse.typed(deliveries(spark, {"runs_of_bat": "4"}, {})), "runs_data")
    sql = spark.sql("select striker, batting_team, sum(runs_of_bat) total_runs from runs_data group by all")
    assert rows(sql) == rows(METRICS["highest_scorers"].batch(spark.table("runs_data"))) == [("a", "A", 5)]


def test_shared_folder_is_the_one_the_session_names(spark):
    assert session.fresh_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert session.fresh_path(spark, "x") != session.fresh_path(spark, "x")


def test_stream_session_leaves_the_callers_settings(spark):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    other = session.for_streams(spark)
    assert "RocksDB" in other.conf.get("spark.sql.streaming.stateStore.providerClass")
    assert other.conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions")
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before


def _file(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)
    return str(folder)


def test_csv_rows_with_a_wrong_number_of_fields(spark, tmp_path):
    path = _file(tmp_path / "in", "a.csv", 'match_id,striker,runs\nM1,a,1\nM2,b\nM3,c,2,9\n"M,4","d ""x""",3\nM5,,\n')
    good, bad = files.split_csv(spark, path)
    assert rows(good) == [("M,4", 'd "x"', "3"), ("M1", "a", "1"), ("M5", "", "")]
    assert rows(bad) == [("M2,b", files.WRONG_FIELDS), ("M3,c,2,9", files.WRONG_FIELDS)]
    assert (good.count(), bad.count()) == (3, 2)
    assert [r.match_id for r in good.select("match_id").where("runs = '1'").collect()] == ["M1"]


def test_csv_values_come_back_as_written(spark, tmp_path):
    names = ["plain", 'a "quoted" one', "with, comma", "two\nlines", " blanks ", '"', "'", "\\"]
    given = spark.createDataFrame([(f"M{k}", name) for k, name in enumerate(names)], "match_id string, striker string")
    files.write_csv(given, str(tmp_path / "out"))
    good, bad = files.split_csv(spark, str(tmp_path / "out"), multi_line=True)
    assert rows(good) == rows(given) and bad.count() == 0


def test_csv_with_another_header_fails(spark, tmp_path):
    _file(tmp_path / "in", "a.csv", "match_id,striker\nM1,a\n")
    path = _file(tmp_path / "in", "b.csv", "striker,match_id\nb,M2\n")
    with pytest.raises(Exception, match="CSV header"):
        files.split_csv(spark, path)[0].collect()


def test_csv_without_a_header(spark, tmp_path):
    path = _file(tmp_path / "in", "a.csv", "M1,a\nM2\n")
    good, bad = files.split_csv(spark, path, names=["match_id", "striker"])
    assert rows(good) == [("M1", "a")] and rows(bad) == [("M2", files.WRONG_FIELDS)]
