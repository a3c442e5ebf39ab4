"""Delivery CSVs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ballstats import schemas
from ballstats.functions.parse import canonical

WRONG_FIELDS = "wrong number of fields"
_CORRUPT = "_corrupt"


def _blank_for_missing(df: DataFrame) -> DataFrame:
    # Spark reads an empty CSV field as null; consumers of the feed expect ''.
    return canonical(df.na.fill(""))


def read_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """All columns named by the header, as text; a quote inside a field is doubled.

    ``multi_line`` is for fields with line breaks; such files are read by one task each.
    """
    reader = spark.read.options(header=True, inferSchema=False, escape='"', multiLine=multi_line)
    return _blank_for_missing(reader.csv(path))


def split_csv(
    spark: SparkSession, path: str, multi_line: bool = False, names: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """:func:`read_csv` of the rows that have as many fields as the header, and the other rows.

    ``names`` are the columns of files without a header.

    A row with too few or too many fields would have its values under the wrong names. Such rows come
    as they stand in the file, as ``value`` and ``problem``. A file whose header names other columns, or
    the same in another order, than the first one's fails the query, as its rows could not be told.
    """
    options = {"header": names is None, "escape": '"', "multiLine": multi_line}
    names = names or spark.read.options(**options, inferSchema=False).csv(path).columns
    # Without pruning, as a row's fields are counted only as far as columns are asked for.
    reader = spark.read.schema(schemas.strings([*names, _CORRUPT])).option("columnNameOfCorruptRecord", _CORRUPT)
    rows = reader.options(**options, enforceSchema=False, columnPruning=False).csv(path)
    # Spark refuses queries that need the text of faulty rows alone, as counting does: another column is looked at beside it.
    faulty = F.col(_CORRUPT).isNotNull() & (F.length(F.concat_ws("", _CORRUPT, F.col(f"`{names[0]}`"))) >= 0)
    good = rows.where(~faulty).drop(_CORRUPT)
    return _blank_for_missing(good), rows.where(faulty).select(F.col(_CORRUPT).alias("value"), F.lit(WRONG_FIELDS).alias("problem"))


def write_csv(df: DataFrame, path: str) -> None:
    """With a header; values with separators, quotes, line breaks or blanks at their ends come back as they are."""
    kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.options(header=True, escape='"', **kept).csv(path)


def stream_csv(
    spark: SparkSession, path: str, fields: list[str] | None = None, max_files_per_trigger: int = 1000, multi_line: bool = False
) -> DataFrame:
    """CSV files as they appear in a directory; ``fields`` are the columns in file order.

    A file whose header says otherwise fails the query.
    """
    reader = spark.readStream.schema(schemas.strings(fields or schemas.CSV_FIELDS))
    reader = reader.options(header=True, enforceSchema=False, escape='"', multiLine=multi_line)
    return _blank_for_missing(reader.option("maxFilesPerTrigger", max_files_per_trigger).csv(path))


def spread(df: DataFrame) -> DataFrame:
    """Give every core a part of an input that comes in fewer pieces, before costly work per row.

    An input of at least as many pieces is left as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
