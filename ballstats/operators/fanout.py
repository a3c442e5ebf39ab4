"""One delivery to the messages of several topics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ballstats import schemas
from ballstats.functions.parse import encode


def _message(columns: list[str], topic: str) -> Column:
    if topic == schemas.RAW_TOPIC:
        return encode(*(F.col(name).cast("string").alias(name) for name in columns))
    mandatory = schemas.MANDATORY_FIELDS.get(topic, [])
    # A mandatory column that is missing is left in, so that the analysis fails on it.
    return encode(*(name for name in schemas.TOPIC_FIELDS[topic] if name in columns or name in mandatory))


def topic_messages(deliveries: DataFrame, topic: str) -> DataFrame:
    """``topic`` and ``value`` of one topic; only its columns are read."""
    return deliveries.select(F.lit(topic).alias("topic"), _message(deliveries.columns, topic).alias("value"))


def fan_out(
    deliveries: DataFrame, topics: Sequence[str] = (schemas.RAW_TOPIC, *schemas.TOPIC_FIELDS)
) -> DataFrame:
    """``topic`` and ``value`` of all topics from one scan, without a shuffle."""
    columns = deliveries.columns
    messages = [F.struct(F.lit(topic).alias("topic"), _message(columns, topic).alias("value")) for topic in topics]
    return deliveries.select(F.inline(F.array(*messages)))
