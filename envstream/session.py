"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# State on local disk instead of the heap, and per batch only its changes uploaded.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # A count of the rows of a store costs a read before every write; progress shows 0.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    # One store per join partition in place of four.
    "spark.sql.streaming.join.stateFormatVersion": "3",
}


def build_session(app_name, shuffle_partitions=None, master=None, extra=None):
    """A session with the settings the jobs here rely on.

    ``shuffle_partitions`` also fixes the number of state partitions of a new
    streaming checkpoint. Leave ``master`` unset under spark-submit.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **STATE_SETTINGS,
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **(extra or {}),
    }
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def streaming_session(spark, partitions=None):
    """A sibling session for streaming queries: RocksDB state, UTC, and as many
    state partitions as the cluster has cores unless told otherwise."""
    session = spark.newSession()
    count = partitions or spark.sparkContext.defaultParallelism
    session.conf.set("spark.sql.shuffle.partitions", str(count))
    session.conf.set("spark.sql.session.timeZone", "UTC")
    for key, value in STATE_SETTINGS.items():
        session.conf.set(key, value)
    return session


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new path under the folder all executors share (spark.checkpoint.dir).

    Where the setting is missing, a temporary folder serves local runs only.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="envstream-")
    return f"{root.rstrip('/')}/envstream/{purpose}-{uuid.uuid4().hex}"


#: Whether Spark removes a query's shuffle files when it ends; read when a frame is made.
_REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(df: DataFrame) -> DataFrame:
    """Write the rows once to reliable storage and cut the lineage there. The shuffle
    files behind them go at once, not when the driver happens to collect its garbage."""
    context, conf = df.sparkSession.sparkContext, df.sparkSession.conf
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession, "checkpoint"))
    before = conf.get(_REMOVE_SHUFFLES, None)
    conf.set(_REMOVE_SHUFFLES, "true")
    try:
        return df.select("*").checkpoint(eager=True)
    finally:
        if before is None:
            conf.unset(_REMOVE_SHUFFLES)
        else:
            conf.set(_REMOVE_SHUFFLES, before)
