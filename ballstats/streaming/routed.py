"""One query for all metrics of a job and for the messages it rejects.

A micro-batch is parsed once. Good messages are summed as far as the job's metrics need it, bad ones are
counted per text and problem; both come out of one aggregate and are written together, partitioned by
table, under the batch's number. There is no state to keep: what a batch adds is summed when it is read.
Numbers of messages read and rejected come with the query's progress.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ballstats import schemas
from ballstats.functions import parse
from ballstats.operators.landing import QUARANTINE
from ballstats.plans.batch import PHASE_SCORES, phase, rollup
from ballstats.plans.catalog import METRICS
from ballstats.streaming import runner, sinks

SCORES = "scores"
COUNTS = "messages"
_SUMS = ("runs_of_bat", "extras", "total_runs", "balls")
_SCHEMA = (
    "match_id string, batting_team string, innings int, striker string, over float, topic string, value string, problem string, "
    "runs_of_bat long, extras long, total_runs long, balls long, n long, table string, batch_id long"
)


def routed(checked: DataFrame) -> DataFrame:
    """Sums of good messages and counts of bad ones, told apart by ``table``; ``checked`` as by ``parse.checked``."""
    good = F.col("problem").isNull()
    names = schemas.TOPIC_FIELDS[PHASE_SCORES.topic]
    rows = checked.select(
        F.when(good, SCORES).otherwise(QUARANTINE).alias("table"),
        *[F.when(good, F.col("fields")[name]).alias(name) for name in names],
        F.when(~good, F.col("topic")).alias("topic"),
        F.when(~good, F.col("value").cast("string")).alias("value"),
        "problem",
    )
    keys = [name for name in PHASE_SCORES.keys if name != "over"]
    summed = parse.typed(rows).groupBy("table", *keys, phase(), "topic", "value", "problem")
    return summed.agg(*[F.sum(name).alias(name) for name in _SUMS], F.count("*").alias("n"))


def start(messages: DataFrame, path: str, trigger: runner.Trigger | None = None) -> StreamingQuery:
    """Take in messages of the topic that run metrics are made of."""
    checked = parse.checked(messages).observe(COUNTS, F.count("*").alias("read"), F.count("problem").alias("rejected"))
    write = sinks.part_writer(f"{path}/data", "table")
    writer = runner.writer(checked, "routed", path, "append", trigger)
    return writer.foreachBatch(lambda batch, batch_id: write(routed(batch), batch_id)).start()


def counts(query: StreamingQuery) -> dict[int, tuple[int, int]]:
    """Messages read and rejected by batch number, of the triggers that the query's progress still tells of."""
    told = {p["batchId"]: p.get("observedMetrics", {}).get(COUNTS) for p in query.recentProgress}
    return {batch_id: (row["read"], row["rejected"]) for batch_id, row in told.items() if row}


def read_metric(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A metric on runs, from the sums of all batches."""
    kept = sinks.read_parts(spark, f"{path}/data", _SCHEMA).where(F.col("table") == SCORES)
    return METRICS[name].batch(rollup(kept))


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    """``topic``, ``value``, ``problem`` and how often, of every rejected message."""
    kept = sinks.read_parts(spark, f"{path}/data", _SCHEMA).where(F.col("table") == QUARANTINE)
    return kept.groupBy("topic", "value", "problem").agg(F.sum("n").alias("n"))


def problems(rejected: DataFrame) -> DataFrame:
    return rejected.groupBy("topic", "problem").agg(F.sum("n").alias("n"))
