"""What the text operators share."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but ASCII white space.
SPACES = r"[\x20\x09-\x0D]+"


#: Rows and bytes of one Arrow batch. Rows hold whole texts here, and a worker holds
#: a batch; a single text may be larger.
BATCH_ROWS = 1000
BATCH_BYTES = 8 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
_BYTES_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def modest_batches(df: DataFrame) -> DataFrame:
    """Lowers the session's batch size to what rows with whole texts allow. It stays
    so for what the session runs afterwards, which changes no result."""
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(_BATCH_SETTING)) <= BATCH_ROWS:
        conf.set(_BATCH_SETTING, str(BATCH_ROWS))
    if conf.get(_BYTES_SETTING, None) != str(BATCH_BYTES):
        conf.set(_BYTES_SETTING, str(BATCH_BYTES))
    return df


_caches = {}


def cache_of(owner: str, make=dict):
    """What a Python worker keeps for one operator from batch to batch. Spark uses a
    worker for stage after stage, so the first call of another operator drops it."""
    if owner not in _caches:
        _caches.clear()
        gc.collect()
        _caches[owner] = make()
    return _caches[owner]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once per row, also where the body
    uses it inside a function that runs per element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """The words of a text; none for NULL."""
    parts = F.split(F.coalesce(text, F.lit("")), SPACES)
    return F.filter(parts, lambda w: w != "")


