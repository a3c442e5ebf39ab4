"""Validated messages to typed tables, the match dimension and the deliveries fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ballstats import schemas
from ballstats.functions import parse

QUARANTINE = "quarantine"
TABLES = [*schemas.TOPIC_FIELDS, QUARANTINE]


def validate(messages: DataFrame) -> DataFrame:
    """``topic``, ``value``, ``status`` (valid or quarantine) and ``problem`` of each message."""
    status = F.when(F.col("problem").isNull(), "valid").otherwise(QUARANTINE)
    return parse.checked(messages).select("topic", "value", status.alias("status"), "problem")


def route(messages: DataFrame) -> DataFrame:
    """Each message with the table it belongs to and the typed columns of all tables.

    One pass over the messages serves every table: they are written together, partitioned by
    ``table``, and columns a table does not have stay null, which Parquet stores for nothing.
    """
    checked = parse.checked(messages)
    good = F.col("problem").isNull()
    return checked.select(
        F.when(good, F.col("topic")).otherwise(QUARANTINE).alias("table"),
        *[F.when(good, parse.table_column(name)).alias(name) for name in schemas.ALL_FIELDS],
        F.when(~good, F.col("topic")).alias("topic"),
        F.when(~good, F.col("value").cast("string")).alias("value"),
        "problem",
    )


def land(messages: DataFrame, path: str, batch_id: int) -> None:
    """Write one batch of messages; writing the same batch again replaces it."""
    routed = route(messages).write.mode("overwrite")
    routed.partitionBy("table").parquet(f"{path}/batch_id={batch_id}")


def _landed_schema() -> str:
    kinds = {name: schemas.NUMERIC_FIELDS.get(name, "string") for name in schemas.ALL_FIELDS}
    kinds |= dict.fromkeys(("topic", "value", "problem", "table"), "string")
    return ", ".join(f"`{name}` {kind}" for name, kind in kinds.items()) + ", batch_id bigint"


def read_landed(spark: SparkSession, path: str, table: str) -> DataFrame:
    """One landed table; the other tables' directories are not read."""
    columns = schemas.TOPIC_FIELDS.get(table, ["topic", "value", "problem"])
    landed = spark.read.schema(_landed_schema()).parquet(path)
    return landed.where(F.col("table") == table).select(*columns)


def matches(deliveries: DataFrame) -> DataFrame:
    """The match dimension: one row per ``match_id``.

    Of contradicting attributes those that most deliveries carry are taken, the smallest ones if
    equal, so that a retry gives the same row. The deliveries are counted per attribute set,
    which is a hash aggregate combined on the map side; an aggregate that picks text values
    (``dropDuplicates``, or ``min`` of a struct) would sort all of them. It only sees the counts.
    """
    attributes = [name for name in schemas.MATCH_FIELDS if name in deliveries.columns and name != "match_id"]
    known = deliveries.where("match_id is not null").groupBy("match_id", *attributes)
    counted = known.agg((-F.count("*")).alias("rarity"))
    one = counted.groupBy("match_id").agg(F.min(F.struct("rarity", *attributes)).alias("m"))
    return one.select("match_id", *(f"m.{name}" for name in attributes))


def absent_matches(candidates: DataFrame, existing: DataFrame) -> DataFrame:
    """Candidates whose match is not in the dimension yet: what insert-if-absent inserts."""
    return candidates.join(existing.select("match_id"), "match_id", "left_anti")


def create_matches(spark: SparkSession, path: str) -> None:
    """An empty dimension, unless there is one."""
    columns = ", ".join(f"`{name}` string" for name in schemas.MATCH_FIELDS) + ", ingest_date date"
    spark.createDataFrame([], columns).write.mode("ignore").parquet(f"{path}/batch_id=-1")


def insert_matches(deliveries: DataFrame, path: str, batch_id: int) -> None:
    """Add the matches the dimension lacks; the same batch again replaces its own rows only."""
    others = read_matches(deliveries.sparkSession, path).where(F.col("batch_id") != batch_id)
    new = with_ingest_date(absent_matches(matches(deliveries), others))
    new.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_matches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def with_ingest_date(df: DataFrame) -> DataFrame:
    """The day the rows were taken in."""
    return df.withColumn("ingest_date", F.current_date())


def facts(deliveries: DataFrame) -> DataFrame:
    """The deliveries fact table, typed; counts of extras default to 0, other gaps to null.

    ``over`` may come split in two columns or as ``o.b``.
    """
    columns = deliveries.columns
    over = F.col("over").cast("string")
    pieces = {
        "over_num": F.substring_index(over, ".", 1),
        "ball_num": F.when(F.contains(over, F.lit(".")), F.substring_index(over, ".", -1)),
    }
    sources: dict[str, Column] = {}
    for name, kind in schemas.FACT_TYPES.items():
        if name in columns:
            value = F.col(name)
        elif name in pieces and "over" in columns:
            value = pieces[name]
        else:
            value = F.lit(None)
        value = value.try_cast(kind)
        if name in ("extras", "wides", "noballs", "penalty_runs"):
            # Absent means 0; a value that is there but unreadable stays null.
            value = F.when(F.col(name).isNull(), 0).otherwise(value) if name in columns else F.lit(0)
        sources[name] = value.alias(name)
    kept = [name for name in ("season",) if name in columns]
    return deliveries.select(*sources.values(), *kept)


def write_facts(rows: DataFrame, path: str, mode: str = "append") -> None:
    """Append facts, by season where there is one, so that seasons can be read alone."""
    writer = rows.write.mode(mode)
    if "season" in rows.columns:
        writer = writer.partitionBy("season")
    writer.parquet(path)


def orphans(deliveries: DataFrame, dimension: DataFrame) -> DataFrame:
    """Deliveries whose match is not in the dimension, a null match included."""
    return deliveries.join(dimension.select("match_id"), "match_id", "left_anti")


def orphan_counts(deliveries: DataFrame, dimension: DataFrame) -> DataFrame:
    """Orphans per match. Counted before the join, which then has one row per match on each side."""
    counts = deliveries.groupBy("match_id").agg(F.count("*").alias("n"))
    return orphans(counts, dimension)
