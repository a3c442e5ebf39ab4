"""Session settings and the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Long-running state of many keys (player x innings) stays off the heap and is
# checkpointed by its changes.
STREAMING_CONF = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # A query with timers would otherwise run batches without data for ever, and never end where it is to take
    # in what is there. Timers go off with the next batch that has data.
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}
# Tables are written by few partition values (topic, table, season): one open file for each instead
# of sorting every task's rows by them.
_WRITERS = {"spark.sql.maxConcurrentOutputFileWriters": "16"}
CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    **STREAMING_CONF,
    **_WRITERS,
}


def build(app: str, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def for_streams(spark: SparkSession) -> SparkSession:
    """A session beside ``spark`` with the state store settings, so that the caller's stay as they are.

    All other settings are the caller's, those made at run time too; so state is split as the session
    says. A query keeps the number of parts it was first started with.
    """
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            session.conf.set(key, value)
    for key, value in {**STREAMING_CONF, **_WRITERS}.items():
        session.conf.set(key, value)
    return session


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``, or a temporary one in local mode only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    return tempfile.mkdtemp(prefix="ballstats-")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has been written to yet."""
    return f"{shared_folder(spark)}/ballstats/{name}-{uuid.uuid4().hex}"
