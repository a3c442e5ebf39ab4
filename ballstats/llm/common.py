"""What several operators of this folder share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ballstats import session

#: Texts, and bytes of text, that a task works on at once; a longer text is worked on alone.
TEXTS_AT_ONCE, BYTES_AT_ONCE = 64, 1 << 20


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only ``doc_id`` and ``text`` (null: empty), whatever else the table has."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )


def crc_of_id(column: str | Column) -> Column:
    """crc32 of the id as text; null for a null id."""
    column = F.col(column) if isinstance(column, str) else column
    return F.crc32(column.cast("string").cast("binary"))


def parts(batches: Iterable[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """The batches cut into parts of a bounded number of texts and of bytes."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = held = 0
        for k, size in enumerate(sizes):
            if k > start and (k - start == TEXTS_AT_ONCE or held + size > BYTES_AT_ONCE):
                yield batch.slice(start, k - start)
                start, held = k, 0
            held += size
        if start < len(sizes):
            yield batch.slice(start)


def in_slices(
    make: Callable[[list, list[str]], dict[str, list]], schema: pa.Schema
) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A ``mapInArrow`` function that hands ``make`` the ids and texts of a few rows at a time."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches):
            out = make(part.column("doc_id").to_pylist(), part.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(out[field.name], type=field.type) for field in schema], schema=schema)

    return run


def ddl(schema: pa.Schema) -> str:
    names = {pa.int64(): "long", pa.int32(): "int", pa.string(): "string", pa.float64(): "double", pa.bool_(): "boolean"}
    names |= {pa.binary(): "binary", pa.list_(pa.int64()): "array<long>"}
    return ", ".join(f"`{field.name}` {names[field.type]}" for field in schema)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, and safe if executors are lost."""
    spark: SparkSession = df.sparkSession
    path = session.fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Remove tables of :func:`stored` that nothing reads any more, so that disk holds only what is in use."""
    for table in tables:
        spark = table.sparkSession
        for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles() if "/ballstats/" in file}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
