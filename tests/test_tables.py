import pytest
from pyspark.sql import functions as F

from envstream import schemas as S
from envstream.operators import keys
from envstream.session import streaming_session
from envstream.sinks.outputs import write_feed
from envstream.sources.files import read_feed
from envstream.sources.tables import AIR, LOCATIONS, WEATHER, DatabaseStore, FolderStore
from envstream.streaming.queries import start_batches
from envstream.streaming.table_writer import TableWriter, read_ledger
from helpers import air_entry, counted, frame, message, weather_entry

HOUR = 1704067200


def batch(spark, air=(), weather=()):
    return frame(spark, list(air), "air").union(frame(spark, list(weather), "weather"))


def writer(spark, tmp_path, fill_nulls=False, **how):
    return TableWriter(FolderStore(spark, str(tmp_path / "db"), fill_nulls).create(), "air", "weather", **how)


def located(store):
    return counted(store.read(LOCATIONS).select("location_name", "longitude", "latitude"))


def test_first_writer_wins_between_batches(spark, tmp_path):
    write = writer(spark, tmp_path)
    write(batch(spark, [message(HOUR, air_entry("A", aqi=1), air_entry("B", aqi=2))]), 0)
    write(batch(spark, [message(HOUR, air_entry("A", aqi=5)), message(HOUR + 3600, air_entry("A", aqi=4))]), 1)
    rows = write.store.read(AIR).join(write.store.read(LOCATIONS), "location_id")
    got = counted(rows.select("location_name", F.unix_seconds(S.TIME), "air_quality_index"))
    assert got == [("A", HOUR, 1), ("A", HOUR + 3600, 4), ("B", HOUR, 2)]
    ids = [r[0] for r in write.store.read(AIR).select("air_pollution_data_id").collect()]
    assert len(set(ids)) == 3


def test_one_batch_resolves_ties_by_the_stated_order(spark, tmp_path):
    write = writer(spark, tmp_path)
    write(batch(spark, [message(HOUR, air_entry("A", aqi=4), air_entry("A", aqi=2), air_entry("A", aqi=2))]), 0)
    assert [r.air_quality_index for r in write.store.read(AIR).collect()] == [2]


def test_replayed_batch_adds_nothing(spark, tmp_path):
    write = writer(spark, tmp_path, ledger=str(tmp_path / "ledger"))
    rows = batch(spark, [message(HOUR, air_entry("A"))], [message(HOUR, weather_entry("A"), weather_entry("B"))])
    write(rows, 0)
    before = [counted(write.store.read(n)) for n in (LOCATIONS, AIR, WEATHER)]
    assert counted(read_ledger(spark, write.ledger)) == [("tables", 0, 2, 1, 2)]
    write(rows, 0)
    assert [counted(write.store.read(n)) for n in (LOCATIONS, AIR, WEATHER)] == before
    assert counted(read_ledger(spark, write.ledger)) == [("tables", 0, 2, 1, 2)]


def test_weather_columns_and_first_description(spark, tmp_path):
    write = writer(spark, tmp_path)
    write(batch(spark, weather=[message(HOUR, weather_entry("A", gust=None, conditions=()))]), 0)
    row = write.store.read(WEATHER).first()
    assert row.weather_description is None and row.wind_gust is None and row.temperature == 10.0
    assert f"{', '.join(f'{n} {t}' for n, t in write.store.read(WEATHER).dtypes)}" == S.WEATHER_TABLE


@pytest.mark.parametrize("fill, expected", [(False, (None, None)), (True, (1.0, 2.0))])
def test_coordinates_of_a_location_first_seen_in_weather(spark, tmp_path, fill, expected):
    write = writer(spark, tmp_path, fill)
    write(batch(spark, weather=[message(HOUR, weather_entry("A"))]), 0)
    write(batch(spark, air=[message(HOUR, air_entry("A"), air_entry("B"))]), 1)
    write(batch(spark, air=[message(HOUR, air_entry("A", lon=8.0))]), 2)
    assert located(write.store) == [("A", *expected), ("B", 1.0, 2.0)]
    assert counted(write.store.read(LOCATIONS).select("location_id")) == [(1,), (2,)]


def test_one_batch_takes_coordinates_from_pollution(spark, tmp_path):
    write = writer(spark, tmp_path)
    write(batch(spark, [message(HOUR, air_entry("A"))], [message(HOUR, weather_entry("A"))]), 0)
    assert located(write.store) == [("A", 1.0, 2.0)]


def test_rows_without_a_full_key_stay_out(spark, tmp_path):
    write = writer(spark, tmp_path, rejected=str(tmp_path / "rejected"))
    rows = batch(spark, ["{not json", message("noon", air_entry("A")), message(HOUR, air_entry(None))])
    write(rows, 4)
    assert write.store.read(AIR).count() == 0 and located(write.store) == [("A", 1.0, 2.0)]
    kept = spark.read.parquet(str(tmp_path / "rejected"))
    assert counted(kept.select("reason", "topic", "batch_id")) == [
        ("key is no time", "air", 4), ("no location name", "air", 4), ("not an envelope", "air", 4),
    ]


def test_a_time_no_key_can_hold_is_rejected_alone(spark, tmp_path):
    write = writer(spark, tmp_path, rejected=str(tmp_path / "rejected"))
    far = 16725225600  # year 2500
    write(batch(spark, [message(far, air_entry("A")), message(HOUR, air_entry("B"))]), 0)
    assert write.store.read(AIR).count() == 1
    kept = spark.read.parquet(str(tmp_path / "rejected"))
    assert [r.reason for r in kept.collect()] == ["time out of range"]


def test_only_the_touched_days_are_read(spark, tmp_path):
    write = writer(spark, tmp_path)
    write(batch(spark, [message(HOUR + 86400 * d, air_entry("A")) for d in range(40)]), 0)
    two = write.store.read(AIR).where(F.unix_seconds(S.TIME).isin(HOUR, HOUR + 39 * 86400))
    near = write.store.keys_near(AIR, two)
    days = near.select(F.input_file_name().alias("f")).distinct().collect()
    assert len(days) == 2 and near.count() == 2


def test_completed_locations_are_one_row_for_every_reader(spark, tmp_path):
    filling = writer(spark, tmp_path, fill_nulls=True)
    filling(batch(spark, weather=[message(HOUR, weather_entry("A"))]), 0)
    filling(batch(spark, [message(HOUR, air_entry("A"))]), 1)
    plain = writer(spark, tmp_path)
    plain(batch(spark, [message(HOUR + 3600, air_entry("A"))]), 2)
    assert located(plain.store) == [("A", 1.0, 2.0)] == located(filling.store)
    assert plain.store.read(AIR).count() == 2


def test_location_keys_are_dense_and_go_on(spark):
    names = spark.range(9000).select(F.concat(F.lit("n"), F.col("id").cast("string")).alias("location_name"))
    numbered = keys.number_rows(names, "location_name", 100, "location_id").cache()
    ids = [r.location_id for r in numbered.orderBy("location_id").collect()]
    assert ids == list(range(101, 9101))
    ordered = numbered.orderBy(F.md5("location_name"), "location_name")
    assert [r.location_id for r in ordered.collect()] == ids


def test_fact_keys_are_unique_and_fail_loudly(spark):
    from envstream.functions import packed_fact_id

    def ids(place, *seconds):
        df = spark.createDataFrame([(place, s) for s in seconds], "place bigint, s bigint")
        df = df.withColumn("t", F.timestamp_seconds("s"))
        return [r[0] for r in df.select(packed_fact_id("place", "t")).collect()]

    got = ids(1, 0, 1, -1, HOUR) + ids(2, 0, 1, -1, HOUR) + ids((1 << 29) - 1, (1 << 33) - 1)
    assert len(set(got)) == 9 and all(0 < i < 1 << 63 for i in got)
    with pytest.raises(Exception, match="no fact id"):
        ids(1 << 29, 0)


def test_facts_of_many_days_and_pruned_reads(spark, tmp_path):
    write = writer(spark, tmp_path)
    days = [message(HOUR + 86400 * d, air_entry("A")) for d in range(4)]
    write(batch(spark, days), 0)
    near = write.store.keys_near(AIR, write.store.read(AIR).where(F.unix_seconds(S.TIME) >= HOUR + 3 * 86400))
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(measurement_date" in plan and near.count() == 1
    assert "air_quality_index" not in plan
    assert write.store.keys_near(AIR, write.store.read(AIR).limit(0)).count() == 0


def test_days_do_not_follow_the_session_time_zone(spark, tmp_path):
    write = writer(spark, tmp_path)
    rows = batch(spark, [message(HOUR + 3600 * h, air_entry("A")) for h in (0, 12, 23)])
    for zone in ("UTC", "Asia/Tokyo", "America/Los_Angeles"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        write(rows, 0)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert write.store.read(AIR).count() == 3


def test_ordered_facts_and_orphans(spark, tmp_path):
    write = writer(spark, tmp_path)
    write(batch(spark, [message(HOUR + 3600, air_entry("A")), message(HOUR, air_entry("B"), air_entry("A"))]), 0)
    facts, known = write.store.read(AIR), write.store.read(LOCATIONS)
    order = [(r[S.TIME], r.location_id) for r in keys.in_time_order(facts).collect()]
    assert order == sorted(order) and len(order) == 3
    assert keys.orphans(facts, known).count() == 0
    assert keys.orphans(facts, known.where("location_name = 'A'")).count() == 1


def test_stream_resumes_after_a_failed_batch(spark, tmp_path):
    write = writer(spark, tmp_path)
    feed, state = str(tmp_path / "feed"), str(tmp_path / "state")
    session = streaming_session(spark, 4)
    write_feed(batch(spark, [message(HOUR, air_entry("A"), air_entry("B"))], [message(HOUR, weather_entry("A"))]), feed)

    def fails_at_the_end(rows, batch_id):
        write(rows, batch_id)
        raise RuntimeError("lost the connection")

    def drain(handle):
        query = start_batches(read_feed(session, feed), handle, state, drain=True)
        query.awaitTermination()

    with pytest.raises(Exception, match="lost the connection"):
        drain(fails_at_the_end)
    drain(write)
    write_feed(batch(spark, [message(HOUR, air_entry("A", aqi=1), air_entry("C"))]), feed)
    drain(write)
    assert [write.store.read(n).count() for n in (LOCATIONS, AIR, WEATHER)] == [3, 3, 1]


def test_database_options():
    store = DatabaseStore(None, "jdbc:x:y", {"driver": "d"})
    assert store.options(AIR) == {"url": "jdbc:x:y", "dbtable": AIR, "driver": "d"}
    span = ("2024-01-01 00:00:00", "2024-01-02 00:00:00")
    cut = f"(select location_id, {S.TIME} from {AIR} where {S.TIME} between '{span[0]}' and '{span[1]}') near_keys"
    assert store.options(AIR, span) == {"url": "jdbc:x:y", "dbtable": cut, "driver": "d"}
    split = DatabaseStore(None, "jdbc:x:y", read_parts=16).options(AIR, span)
    assert split["partitionColumn"] == S.TIME and split["numPartitions"] == "16"
    assert (split["lowerBound"], split["upperBound"]) == span
    assert store.fill_nulls is False


def test_materialised_rows_leave_no_shuffle_files(spark):
    from envstream.session import materialise

    before = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    rows = materialise(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    assert rows._jdf.queryExecution().shuffleCleanupMode().toString() == "RemoveShuffleFiles"
    assert sorted(r["count"] for r in rows.collect()) == [142] + [143] * 6 == sorted(
        r["count"] for r in rows.collect())
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == before
