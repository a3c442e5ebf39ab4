"""Start, wait for and read streaming queries.

Every query keeps its checkpoint under its own path, so it continues where it stopped, and
names itself. ``trigger`` is what ``DataStreamWriter.trigger`` takes, e.g.
``{"processingTime": "5 seconds"}`` or ``ONCE``; an empty one runs batch after batch.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ballstats import schemas
from ballstats.functions import parse
from ballstats.operators import landing
from ballstats.plans.catalog import Metric
from ballstats.sources import tables
from ballstats.streaming import sinks

Trigger = dict[str, str | bool]
# Take in what is there by now, and end.
ONCE: Trigger = {"availableNow": True}


def live(metric: Metric) -> Trigger:
    return {"processingTime": metric.every} if metric.every else {}


def decoded(messages: DataFrame, topic: str) -> DataFrame:
    """Typed deliveries out of a topic's messages."""
    raw = topic == schemas.RAW_TOPIC
    return parse.typed(parse.decode_raw(messages) if raw else parse.decode(messages, topic))


def writer(df: DataFrame, name: str, path: str | None, mode: str, trigger: Trigger | None) -> DataStreamWriter:
    """A named query that keeps its checkpoint under ``path``."""
    named = df.writeStream.queryName(name).outputMode(mode)
    if path:
        named = named.option("checkpointLocation", f"{path}/checkpoint")
    return named.trigger(**trigger) if trigger else named


def start_metric(
    deliveries: DataFrame, metric: Metric, path: str, mode: str = "complete", trigger: Trigger | None = None
) -> StreamingQuery:
    """Keep a metric's result under ``path``.

    ``complete`` stores the full result at each trigger. ``update`` stores changed rows, folded now
    and then, which is the one to take when there are many keys. ``append`` is for metrics without an
    aggregate. The trigger is the metric's own unless another is given.
    """
    data = f"{path}/data"
    trigger = live(metric) if trigger is None else trigger
    stream = writer(metric.aggregate(deliveries), metric.name, path, mode, trigger)
    if mode == "append":
        return stream.format("parquet").option("path", data).start()
    if mode == "update":
        return stream.foreachBatch(sinks.change_writer(data, metric.keys)).start()
    return stream.foreachBatch(sinks.snapshot_writer(data, metric.finish)).start()


def read_metric(spark: SparkSession, metric: Metric, path: str, mode: str = "complete") -> DataFrame:
    """The current result of a query of :func:`start_metric`, in the metric's order."""
    data = f"{path}/data"
    if mode == "append":
        return metric.show(spark.read.parquet(data))
    if mode == "update":
        return metric.show(sinks.read_changes(spark, data, metric.keys))
    finished = sinks.read_snapshot(spark, data)
    return replace(metric, finish=None).show(finished)


def start_console(
    deliveries: DataFrame,
    metric: Metric,
    path: str | None = None,
    trigger: Trigger | None = None,
    rows: int = 20,
) -> StreamingQuery:
    """Print the first rows at each trigger: of the whole result if it is an aggregate, else of the new rows.

    The console format would collect the result in the driver and sort all of it; showing the
    batch takes the first rows only.
    """
    mode = "complete" if metric.keys else "append"
    trigger = live(metric) if trigger is None else trigger

    def show(batch: DataFrame, batch_id: int) -> None:
        print(f"=== {metric.name}, batch {batch_id} ===")
        metric.show(batch).show(rows, truncate=False)

    aggregated = metric.aggregate(deliveries)
    return writer(aggregated, metric.name, path, mode, trigger).foreachBatch(show).start()


def start_landing(messages: DataFrame, path: str, trigger: Trigger | None = None) -> StreamingQuery:
    """Land the messages of any number of topics in their tables, bad ones in quarantine."""

    def write(batch: DataFrame, batch_id: int) -> None:
        landing.land(batch, f"{path}/data", batch_id)

    return writer(messages, "landing", path, "append", trigger).foreachBatch(write).start()


def read_landed(spark: SparkSession, path: str, table: str) -> DataFrame:
    return landing.read_landed(spark, f"{path}/data", table)


def start_landing_jdbc(
    messages: DataFrame, options: dict[str, str], path: str, trigger: Trigger | None = None
) -> StreamingQuery:
    """Land topics in database tables of the same names; ``path`` keeps the checkpoint and quarantine.

    A batch that is repeated after a failure is appended again, as a plain insert is. Use
    :func:`start_landing` where that matters.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        routed = landing.route(batch).persist()
        try:
            for topic, names in schemas.TOPIC_FIELDS.items():
                rows = routed.where(F.col("table") == topic).select(*names)
                tables.append_jdbc(rows, {**options, "dbtable": topic})
            rejected = routed.where(F.col("table") == landing.QUARANTINE).select("topic", "value", "problem")
            rejected.write.mode("overwrite").parquet(f"{path}/quarantine/batch_id={batch_id}")
        finally:
            routed.unpersist()

    return writer(messages, "landing", path, "append", trigger).foreachBatch(write).start()


def start_store(messages: DataFrame, path: str, trigger: Trigger | None = None) -> StreamingQuery:
    """Store raw deliveries: new matches in the dimension, every delivery in the fact table."""
    landing.create_matches(messages.sparkSession, f"{path}/matches")

    def write(batch: DataFrame, batch_id: int) -> None:
        deliveries = parse.decode_raw(batch).persist()
        try:
            landing.insert_matches(deliveries, f"{path}/matches", batch_id)
            landing.write_facts(landing.facts(deliveries), f"{path}/deliveries/batch_id={batch_id}", "overwrite")
        finally:
            deliveries.unpersist()

    return writer(messages, "store", path, "append", trigger).foreachBatch(write).start()


def finish(query: StreamingQuery, timeout: int | None = None) -> None:
    """Wait for a query that ends by itself, as long as it takes unless a ``timeout`` in seconds is given."""
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"{query.name} did not end within {timeout} s")


def wait_for_any(spark: SparkSession, timeout: int | None = None) -> None:
    """Block until one of the running queries ends or fails."""
    spark.streams.awaitAnyTermination(timeout)
