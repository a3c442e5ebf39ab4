"""Deliveries derived from the ``lineitem`` table of the test data, batch or stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LINEITEM = (
    "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
    "l_linestatus string, l_shipdate timestamp"
)


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(LINEITEM).parquet(f"{sf_dir}/lineitem.parquet")


def lineitem_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int = 1000) -> DataFrame:
    # As a pattern, which matches this name only, the path may be one file as well as a directory of files.
    reader = spark.readStream.schema(LINEITEM).option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(f"{sf_dir}/lineitem.parque[t]")


def deliveries(items: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One delivery per line item: all text but ``season``; ``keep`` passes input columns on."""
    match = F.col("l_orderkey") % 200
    home, away = match % 10, (match + 1 + match % 9) % 10
    first = F.col("inn") == 1
    batting = F.when(first, F.col("t1")).otherwise(F.col("t2"))
    bowling = F.when(first, F.col("t2")).otherwise(F.col("t1"))

    def name(prefix: str, number: Column) -> Column:
        return F.concat(F.lit(prefix), number.cast("string"))

    def flag(condition: Column) -> Column:
        return F.when(condition, "1").otherwise("0")

    striker = name("P", batting * 11 + F.col("l_partkey") % 11)
    fielder = name("P", bowling * 11 + F.col("l_orderkey") % 11)
    how = F.col("l_suppkey") % 5
    wicket_type = (
        F.when(how == 0, "caught").when(how == 1, "bowled").when(how == 2, "lbw").when(how == 3, "run out")
    ).otherwise("stumped")
    extra = F.col("l_discount") > 0.085

    base = items.withColumns(
        {
            "m": match,
            "inn": F.col("l_linenumber") % 2 + 1,
            "t1": home,
            "t2": away,
            "w": (F.col("l_orderkey") + F.col("l_partkey") + F.col("l_suppkey")) % 20 == 0,
        }
    )
    return base.select(
        name("M", F.col("m")).alias("match_id"),
        (F.col("m") % 5 + 2020).alias("season"),
        name("V", F.col("m") % 12).alias("venue"),
        F.col("inn").cast("string").alias("innings"),
        F.concat_ws(".", F.col("l_partkey") % 20, F.col("l_linenumber") % 6 + 1).alias("over"),
        name("T", batting).alias("batting_team"),
        name("T", bowling).alias("bowling_team"),
        striker.alias("striker"),
        name("P", bowling * 11 + F.col("l_suppkey") % 11).alias("bowler"),
        (F.col("l_quantity").cast("int") % 7).cast("string").alias("runs_of_bat"),
        flag(extra).alias("extras"),
        flag(extra & (F.col("l_tax") > 0.045)).alias("wides"),
        F.when(F.col("w"), wicket_type).otherwise("").alias("wicket_type"),
        F.when(F.col("w"), striker).otherwise("").alias("player_dismissed"),
        F.when(F.col("w") & (how == 0), fielder).otherwise("").alias("fielder"),
        *keep,
    )
