"""foreachBatch function: both topics into one dimension and two fact tables."""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envstream import schemas as S
from envstream.functions import fits_fact_id, name_key
from envstream.operators.clean import first_per_key
from envstream.operators.keys import (
    absent, batch_locations, clashing, fact_rows, keyed_fact_rows, number_rows,
)
from envstream.operators.parse import air_rows, rejects, weather_rows
from envstream.session import materialise
from envstream.sources.tables import AIR, LOCATIONS, WEATHER, DatabaseStore, FolderStore, is_placed

FACT_ID = {AIR: "air_pollution_data_id", WEATHER: "weather_data_id"}
MEASURES = {AIR: S.AIR_MEASURES, WEATHER: S.WEATHER_MEASURES}


def read_ledger(spark, path: str) -> DataFrame:
    """What each batch added: job, batch_id, locations_added, air_added, weather_added."""
    rows = spark.read.schema(S.LEDGER_ROW).parquet(path)
    return rows.select("job", "batch_id", "locations_added", "air_added", "weather_added")


def unkept(readings: DataFrame) -> DataFrame:
    """Readings that no table can take, as text with the reason. Those without a
    time come from messages that are rejected whole."""
    reason = (
        F.when(F.col(S.TIME).isNull(), None)
        .when(F.col("location_name").isNull(), "no location name")
        .when(~fits_fact_id(S.TIME), "time out of range")
    )
    return readings.where(reason.isNotNull()).select(
        F.to_json(F.struct(*readings.columns)).alias("json_value"), reason.alias("reason")
    )


def add_locations(store, air: DataFrame, weather: DataFrame, tag=None) -> int:
    """Insert names not yet known; returns their number. Keys that stem from names are
    looked at once they are written: where another name has one, by whatever writer,
    the batch ends in an error before it writes a fact."""
    named = batch_locations(air, weather)
    if store.keyed:
        named = materialise(named.withColumn("location_id", name_key("location_name")))
        if named.isEmpty():
            return 0
        known = store.locations_near(named)
    else:
        known = store.read(LOCATIONS)
    columns = ["location_id", "location_name", "longitude", "latitude"]
    if store.fill_nulls:
        bare = known.where(~is_placed()).select("location_id", "location_name")
        placed = named.where(is_placed()).drop("location_id")
        completed = bare.join(placed, "location_name").select(*columns)
        completed = materialise(completed)
        if not completed.isEmpty():
            store.append(LOCATIONS, completed)
    new = materialise(absent(known, named, ["location_name"]))
    if store.keyed:
        added = 0 if new.isEmpty() else store.append(LOCATIONS, new.select(*columns), tag)
        twice = clashing(store.locations_near(named)).take(10)
        if twice:
            raise ValueError(f"one key for different locations: {[tuple(r) for r in twice]}")
        return added
    if new.isEmpty():
        return 0
    start = known.agg(F.max("location_id")).first()[0] or 0
    return store.append(
        LOCATIONS, number_rows(new, "location_name", start, "location_id").select(*columns), tag
    )


def add_facts(store, name: str, readings: DataFrame, tag=None) -> int:
    """Insert readings whose (location, time) is not in the table; returns their number."""
    keyed = readings.dropna(subset=list(S.JOIN_KEYS)).where(fits_fact_id(S.TIME))
    first = first_per_key(keyed, S.JOIN_KEYS, MEASURES[name])
    if store.keyed:
        rows = keyed_fact_rows(first, MEASURES[name], FACT_ID[name])
    else:
        rows = fact_rows(first, store.read(LOCATIONS), MEASURES[name], FACT_ID[name])
    new = absent(store.keys_near(name, keyed), rows, ["location_id", S.TIME])
    return store.append(name, new, tag)


@dataclass(frozen=True)
class TableWriter:
    """Writes one micro-batch of messages (topic, value).

    Every step inserts only what is absent, so a batch that Spark runs again
    after a failure completes what the first run left undone. One query serves
    both topics, so the dimension has a single writer and needs no lock; a ``keyed``
    store takes several writers, as long as no two write facts of one topic.
    """

    store: FolderStore | DatabaseStore
    air_topic: str
    weather_topic: str
    job: str = "tables"
    ledger: str | None = None
    rejected: str | None = None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        with self.readings(batch) as readings:
            self.write(readings, batch_id)

    @contextmanager
    def readings(self, batch: DataFrame):
        """Messages of a batch, decoded once: those of each topic and their rows."""
        messages = batch.select("topic", "value").persist(StorageLevel.MEMORY_AND_DISK)
        air_messages = messages.where(F.col("topic") == self.air_topic)
        weather_messages = messages.where(F.col("topic") == self.weather_topic)
        air = air_rows(air_messages).persist(StorageLevel.MEMORY_AND_DISK)
        weather = weather_rows(weather_messages).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            yield air_messages, weather_messages, air, weather
        finally:
            for frame in (air, weather, messages):
                frame.unpersist()

    def write(self, readings, batch_id: int) -> None:
        """One run over a batch's ``readings``."""
        air_messages, weather_messages, air, weather = readings
        store = replace(self.store, spark=air.sparkSession)
        tag = store.tag(self.job, batch_id)
        added = (
            add_locations(store, air, weather, tag),
            add_facts(store, AIR, air, tag),
            add_facts(store, WEATHER, weather, tag),
        )
        if self.rejected:
            self._keep_rejects(air_messages, weather_messages, air, weather, batch_id)
        if self.ledger and tag is not None:
            # A run that broke off may have written some already: their tag counts.
            named = ((LOCATIONS, air), (AIR, air), (WEATHER, weather))
            added = tuple(store.written(name, tag, rows) for name, rows in named)
        if self.ledger:
            self._note(air.sparkSession, batch_id, added, whole=tag is not None)

    def _keep_rejects(self, air_messages, weather_messages, air, weather, batch_id):
        """Messages that could not be read, and readings that no table can take."""
        of_air = rejects(air_messages, S.AIR_ENVELOPE).unionByName(unkept(air))
        of_weather = rejects(weather_messages, S.WEATHER_ENVELOPE).unionByName(unkept(weather))
        bad = of_air.withColumn("topic", F.lit(self.air_topic)).unionByName(
            of_weather.withColumn("topic", F.lit(self.weather_topic))
        )
        self._replace_batch(bad, batch_id, self.rejected)

    def _note(self, spark, batch_id, added, whole):
        """Counts that are not ``whole`` add up over the runs of a batch; those of a run
        that broke off before its entry are then missing."""
        folder = spark.createDataFrame([], S.LEDGER_ROW)
        folder.write.mode("ignore").partitionBy("job", "batch_id").parquet(self.ledger)
        before = read_ledger(spark, self.ledger).where(
            (F.col("job") == self.job) & (F.col("batch_id") == batch_id)).first()
        if before is not None and not whole:
            added = tuple(new + old for new, old in zip(added, before[2:]))
        row = spark.createDataFrame([(self.job, batch_id, *added)], S.LEDGER_ROW)
        self._replace_batch(row.drop("job", "batch_id"), batch_id, self.ledger)

    def _replace_batch(self, rows, batch_id, path):
        (
            rows.withColumn("job", F.lit(self.job))
            .withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("job", "batch_id")
            .parquet(path)
        )
