"""Where streamed results go.

Each micro-batch writes a directory of its own, ``batch_id=<n>``: repeating the batch replaces
it, and readers of older ones are not disturbed. Readers take directories only whose write has been
committed, which Spark marks by a file ``_SUCCESS``. What is no longer needed is removed later.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BatchWriter = Callable[[DataFrame, int], None]

# Full results kept for readers that are still at work on an older one.
KEPT_SNAPSHOTS = 20
# After this many triggers the changes are folded into one row per key.
FOLD_EVERY = 100


def _remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def committed(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the micro-batches under ``path`` that are written as a whole, in ascending order."""
    marks = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/batch_id=*/_SUCCESS")
    found = marks.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(marks)
    return sorted(int(mark.getPath().getParent().getName().removeprefix("batch_id=")) for mark in found or [])


def snapshot_writer(
    path: str, finish: Callable[[DataFrame], DataFrame] | None = None, kept: int = KEPT_SNAPSHOTS
) -> BatchWriter:
    """The full result of each trigger (complete mode)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        result = finish(batch) if finish else batch
        result.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        _remove(batch.sparkSession, f"{path}/batch_id={batch_id - kept}")

    return write


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The newest full result that has been written as a whole."""
    found = committed(spark, path)
    if not found:
        raise ValueError(f"no result has been written under {path} yet")
    return spark.read.parquet(f"{path}/batch_id={found[-1]}")


def change_writer(path: str, keys: tuple[str, ...], fold_every: int = FOLD_EVERY) -> BatchWriter:
    """The rows that changed in each trigger (update mode), folded now and then.

    Reading takes the last fold and the changes since, so it does not grow with the number of
    triggers. The fold before the last and its changes are kept for readers still at work.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{path}/kind=change/batch_id={batch_id}")
        if batch_id % fold_every == fold_every - 1:
            _newest(spark, path, keys, batch_id).write.mode("overwrite").parquet(f"{path}/kind=fold/batch_id={batch_id}")
            last = batch_id - fold_every
            _remove(spark, f"{path}/kind=fold/batch_id={last - fold_every}")
            for old in range(last - fold_every + 1, last + 1):
                _remove(spark, f"{path}/kind=change/batch_id={old}")

    return write


def _newest(spark: SparkSession, path: str, keys: tuple[str, ...], upto: int | None = None) -> DataFrame:
    """The newest row of every key: of the last fold and the changes since, as far as they are committed.

    With ``upto``, the state after the changes of that batch, whether or not it has been folded before.
    """
    folds = [n for n in committed(spark, f"{path}/kind=fold") if upto is None or n < upto]
    last = folds[-1] if folds else -1
    changes = [n for n in committed(spark, f"{path}/kind=change") if n > last and (upto is None or n <= upto)]
    read = [f"{path}/kind=fold/batch_id={n}" for n in folds[-1:]]
    read += [f"{path}/kind=change/batch_id={n}" for n in changes]
    if not read:
        raise ValueError(f"no result has been written under {path} yet")
    kept = spark.read.option("basePath", path).parquet(*read)
    values = [name for name in kept.columns if name not in (*keys, "kind", "batch_id")]
    return kept.groupBy(*keys).agg(*[F.max_by(name, "batch_id").alias(name) for name in values])


def read_changes(spark: SparkSession, path: str, keys: tuple[str, ...]) -> DataFrame:
    return _newest(spark, path, keys)


def part_writer(path: str, *partitions: str) -> BatchWriter:
    """Rows of each trigger that stay; ``partitions`` are columns that readers choose by."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy(*partitions).parquet(f"{path}/batch_id={batch_id}")

    return write


def read_parts(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of all triggers that are written as a whole."""
    read = [f"{path}/batch_id={n}" for n in committed(spark, path)]
    if not read:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*read)
