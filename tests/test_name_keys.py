"""Keys worked out from names: several writers on one set of tables."""

import hashlib

import pytest
from pyspark.sql import functions as F

from envstream import schemas as S
from envstream.functions import name_key
from envstream.operators.keys import clashing
from envstream.sources.tables import AIR, LOCATIONS, NAME_PART, WEATHER, FolderStore
from envstream.streaming.table_writer import TableWriter, read_ledger
from helpers import air_entry, counted, frame, message, weather_entry

HOUR = 1704067200


def key(name):
    return int(hashlib.md5(name.encode()).hexdigest()[:15], 16)


def batch(spark, air=(), weather=()):
    return frame(spark, list(air), "air").union(frame(spark, list(weather), "weather"))


def writers(spark, tmp_path, fill_nulls=False):
    store = FolderStore(spark, str(tmp_path / "db"), fill_nulls, keyed=True).create()
    ledger = str(tmp_path / "ledger")
    return (TableWriter(store, "air", "", "air", ledger),
            TableWriter(store, "", "weather", "weather", ledger))


def test_two_writers_give_a_name_one_key(spark, tmp_path):
    of_air, of_weather = writers(spark, tmp_path, fill_nulls=True)
    rows = batch(spark, [message(HOUR, air_entry("A"), air_entry("Ä b"))],
                 [message(HOUR, weather_entry("A"), weather_entry("C"))])
    for _ in range(2):
        of_weather(rows, 0)
        of_air(rows, 0)
    store = of_air.store
    assert {tuple(r) for r in store.read(LOCATIONS).collect()} == {
        (key("A"), "A", 1.0, 2.0), (key("Ä b"), "Ä b", 1.0, 2.0), (key("C"), "C", None, None)}
    assert store.read(LOCATIONS).count() == 3
    ids = counted(store.read(AIR).select("air_pollution_data_id", "location_id"))
    assert ids == sorted(((key(n) << 34) + HOUR + (1 << 33), key(n)) for n in ("A", "Ä b"))
    assert store.read(WEATHER).count() == 2
    assert dict(store.read(AIR).dtypes)["air_pollution_data_id"] == "decimal(32,0)"
    # The air writer adds Ä b, and the place of A by a further row.
    assert counted(read_ledger(spark, of_air.ledger).where("job = 'weather'")) == [
        ("weather", 0, 2, 0, 2)]
    assert counted(read_ledger(spark, of_air.ledger).where("job = 'air'")) == [("air", 0, 1, 2, 0)]


def test_a_location_that_two_writers_added_at_once_is_one(spark, tmp_path):
    of_air, of_weather = writers(spark, tmp_path)
    of_air(batch(spark, [message(HOUR, air_entry("A"))]), 0)
    again = spark.createDataFrame([(key("A"), "A", None, None)], S.LOCATIONS_TABLE)
    of_air.store.append(LOCATIONS, again, "weather:0")
    of_weather(batch(spark, weather=[message(HOUR, weather_entry("A"))]), 0)
    assert counted(of_air.store.read(LOCATIONS)) == [(key("A"), "A", 1.0, 2.0)]
    assert of_air.store.read(WEATHER).count() == 1


def test_two_names_with_one_key_stop_the_writer(spark, tmp_path):
    of_air, _ = writers(spark, tmp_path)
    other = spark.createDataFrame([(key("A"), "other", None, None)], S.LOCATIONS_TABLE)
    of_air.store.append(LOCATIONS, other)
    with pytest.raises(ValueError, match="one key for different locations"):
        of_air(batch(spark, [message(HOUR, air_entry("A"))]), 0)
    assert of_air.store.read(AIR).isEmpty()
    assert clashing(of_air.store.read(LOCATIONS)).count() == 1


def test_a_batch_reads_the_parts_it_touches(spark, tmp_path):
    of_air, _ = writers(spark, tmp_path)
    of_air(batch(spark, [message(HOUR, *[air_entry(f"place {i}") for i in range(60)])]), 0)
    one = spark.createDataFrame([("place 7",)], "location_name string").withColumn(
        "location_id", name_key("location_name"))
    near = of_air.store.locations_near(one)
    assert "place 7" in [r.location_name for r in near.collect()]
    plan = near._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and NAME_PART in plan
    assert near.count() < 10


def test_a_batch_without_names(spark, tmp_path):
    of_air, of_weather = writers(spark, tmp_path)
    of_air(batch(spark, ["{not json", message(HOUR, air_entry(None))]), 0)
    of_weather(batch(spark), 0)
    assert of_air.store.read(LOCATIONS).isEmpty() and of_air.store.read(AIR).isEmpty()
