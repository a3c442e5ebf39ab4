"""Message topics: a Kafka cluster, or Parquet directories ``topic=<name>`` with a ``value`` column.

Both give ``topic`` and ``value``; a directory read as a stream starts with what is there
(``earliest``), Kafka where ``starting`` says.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ballstats import schemas

#: Bytes of messages in memory per row group of a topic file.
ROW_GROUP = 2 << 20


def kafka_options(
    servers: str,
    topics: Sequence[str],
    starting: str = "latest",
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting,
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def stream_kafka(spark: SparkSession, servers: str, topics: Sequence[str], **limits) -> DataFrame:
    reader = spark.readStream.format("kafka").options(**kafka_options(servers, topics, **limits))
    return reader.load().select("topic", F.col("value").cast("string").alias("value"))


def write_kafka(messages: DataFrame, servers: str) -> None:
    messages.select("topic", "value").write.format("kafka").option("kafka.bootstrap.servers", servers).save()


def write_topic_files(messages: DataFrame, path: str) -> None:
    """Append messages to their topics' directories.

    Row groups are small, so that a micro-batch of a few files is shared by all cores: a row group is one task's.
    """
    writer = messages.select("topic", "value").write.mode("append").option("parquet.block.size", ROW_GROUP)
    writer.partitionBy("topic").parquet(path)


def read_topic_files(spark: SparkSession, path: str, topics: Sequence[str]) -> DataFrame:
    reader = spark.read.schema(schemas.MESSAGE_SCHEMA)
    return reader.parquet(path).where(F.col("topic").isin(*topics)).select("topic", "value")


def stream_topic_files(
    spark: SparkSession, path: str, topics: Sequence[str], max_files_per_trigger: int = 1000
) -> DataFrame:
    """Several topics as one stream; only their directories are listed."""
    reader = spark.readStream.schema(schemas.MESSAGE_SCHEMA).option("basePath", path)
    reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(f"{path}/topic={{{','.join(topics)}}}").select("topic", "value")
