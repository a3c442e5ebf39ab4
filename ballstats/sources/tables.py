"""Landed tables in a relational database, and named views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str, table: str, user: str, password: str, driver: str | None = None, fetchsize: int = 10_000
) -> dict[str, str]:
    options = {"url": url, "dbtable": table, "user": user, "password": password, "fetchsize": str(fetchsize)}
    if driver:
        options["driver"] = driver
    return options


def split_options(column: str, lower: int, upper: int, partitions: int) -> dict[str, str]:
    """Read in ``partitions`` ranges of ``column``, each by its own task and connection."""
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def read_jdbc(
    spark: SparkSession, options: dict[str, str], column: str = "id", partitions: int = 64
) -> DataFrame:
    """A table in parallel ranges of its surrogate key; the bounds are asked of the database."""
    asked = {**options, "dbtable": f"(select min({column}) lo, max({column}) hi from {options['dbtable']}) b"}
    low, high = spark.read.format("jdbc").options(**asked).load().first()
    reader = spark.read.format("jdbc").options(**options)
    if low is not None and high > low:
        reader = reader.options(**split_options(column, int(low), int(high) + 1, partitions))
    return reader.load()


def append_jdbc(df: DataFrame, options: dict[str, str], connections: int = 16, batchsize: int = 10_000) -> None:
    """Append rows in bulk, over at most ``connections`` connections."""
    writer = df.write.format("jdbc").options(**options).mode("append")
    writer.option("numPartitions", connections).option("batchsize", batchsize).save()


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Register ``df`` for SQL under ``name`` in its session."""
    df.createOrReplaceTempView(name)
    return df
