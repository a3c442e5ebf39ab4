"""How far a streamed result agrees with the batch result."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Parts that results are compared by before their rows are.
BUCKETS = 1024


def reconcile(name: str, batch: DataFrame, stream: DataFrame) -> DataFrame:
    """One row: records on both sides, equal records, and their share of the batch in percent.

    Rows are matched as a multiset, whatever their order. Both sides are counted per distinct
    row in one aggregate, so neither is sorted, joined or numbered. The accuracy is 0 if a side
    is empty or the columns differ.
    """
    comparable = set(batch.columns) == set(stream.columns)
    if comparable:
        keys = batch.columns
        both = batch.select(*keys, F.lit(1).alias("_b"), F.lit(0).alias("_s")).unionByName(
            stream.select(*keys, F.lit(0).alias("_b"), F.lit(1).alias("_s"))
        )
        per_row = both.groupBy(*keys).agg(F.sum("_b").alias("_b"), F.sum("_s").alias("_s"))
    else:
        per_row = batch.select(F.lit(1).alias("_b"), F.lit(0).alias("_s")).union(
            stream.select(F.lit(0).alias("_b"), F.lit(1).alias("_s"))
        )
    counts = per_row.agg(
        F.coalesce(F.sum("_b"), F.lit(0)).cast("bigint").alias("batch_records"),
        F.coalesce(F.sum("_s"), F.lit(0)).cast("bigint").alias("stream_records"),
        F.coalesce(F.sum(F.least("_b", "_s")), F.lit(0)).cast("bigint").alias("matching_records"),
    )
    either_empty = (F.col("batch_records") == 0) | (F.col("stream_records") == 0)
    share = F.when(either_empty, 0.0).otherwise(F.col("matching_records") * 100.0 / F.col("batch_records"))
    return counts.select(
        F.lit(name).alias("analysis_type"),
        "batch_records",
        "stream_records",
        "matching_records",
        share.cast("double").alias("accuracy"),
    )


def report(pairs: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """One row per analysis."""
    rows = [reconcile(name, batch, stream) for name, (batch, stream) in pairs.items()]
    result = rows[0]
    for row in rows[1:]:
        result = result.unionByName(row)
    return result


def summary(details: DataFrame) -> DataFrame:
    """Mean accuracy and record counts over the analyses that had results on both sides."""
    usable = details.where("batch_records > 0 and stream_records > 0")
    return usable.agg(
        F.count("*").alias("analyses"),
        F.sum("batch_records").alias("batch_records"),
        F.sum("stream_records").alias("stream_records"),
        F.avg("accuracy").alias("avg_accuracy"),
    )


def _hashes(names: Sequence[str]) -> list[Column]:
    """Two hashes of the columns; a null is told from an absent value by a flag."""
    told = [column for name in names for column in (F.col(name), F.col(name).isNull())]
    return [F.xxhash64(F.lit(seed), *told) for seed in (1, 2)]


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("_bucket")


def digests(result: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """Rows and two sums of their hashes per bucket of keys, whatever the order of the rows.

    The sums are combined on the map side, so a task sends one row per bucket, however large a result is.
    """
    first, second = _hashes(sorted(result.columns))
    hashed = result.select(_bucket(keys, buckets), first.alias("_first"), second.alias("_second"))
    sums = [F.sum(F.col(name).cast("decimal(20,0)")).alias(name) for name in ("_first", "_second")]
    return hashed.groupBy("_bucket").agg(F.count("*").alias("_rows"), *sums)


def unequal_buckets(batch: DataFrame, stream: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """``_bucket`` where the two results differ: as many rows as buckets at most."""
    ours, theirs = digests(batch, keys, buckets).alias("b"), digests(stream, keys, buckets).alias("s")
    same = [F.col(f"b.{name}").eqNullSafe(F.col(f"s.{name}")) for name in ("_rows", "_first", "_second")]
    both = ours.join(theirs, F.col("b._bucket") == F.col("s._bucket"), "full_outer")
    differ = both.where(~(same[0] & same[1] & same[2]))
    return differ.select(F.coalesce("b._bucket", "s._bucket").alias("_bucket"))


def difference(batch: DataFrame, stream: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """The keys whose rows differ: ``batch`` and ``stream`` values and numbers of rows of each.

    Results are compared by the digests of :func:`digests` first. Rows are shuffled and compared only in the
    buckets that are unequal, so that two results that agree in all but a few keys cost two scans and
    little more. The digests read both results once before the rows do: hand over stored ones.

    Rows count as a multiset. ``batch`` is a struct of the columns beside the keys: the largest of the
    key's rows that the stream lacks (null if it lacks none), and ``stream`` likewise; ``batch_rows`` and
    ``stream_rows`` count the rows that the other side lacks.
    """
    if set(batch.columns) != set(stream.columns):
        raise ValueError(f"columns differ: {batch.columns} and {stream.columns}")
    names = batch.columns
    values = [name for name in names if name not in keys]
    unequal = F.broadcast(unequal_buckets(batch, stream, keys, buckets))  # a row per bucket at most

    def inside(result: DataFrame, ours: int) -> DataFrame:
        there = result.withColumn("_bucket", _bucket(keys, buckets)).join(unequal, "_bucket", "left_semi")
        return there.select(*names, F.lit(ours).alias("_n"))

    counted = inside(batch, 1).unionByName(inside(stream, -1)).groupBy(*names).agg(F.sum("_n").alias("_n"))
    row = F.struct(*values) if values else F.struct(F.lit(True).alias("there"))
    more, less = F.col("_n") > 0, F.col("_n") < 0
    none = F.lit(0)
    return counted.where("_n <> 0").groupBy(*keys).agg(
        F.max(F.when(more, row)).alias("batch"),
        F.max(F.when(less, row)).alias("stream"),
        F.sum(F.when(more, F.col("_n")).otherwise(none)).alias("batch_rows"),
        F.sum(F.when(less, -F.col("_n")).otherwise(none)).alias("stream_rows"),
    )
