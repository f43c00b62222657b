import time

import pytest
from pyspark.sql import functions as F

from envstream import schemas as S
from envstream.operators import clean, parse, unify
from envstream.session import streaming_session
from envstream.sinks.outputs import write_feed
from envstream.sources.files import backfill_feed, read_feed
from envstream.streaming.queries import (
    LastInput, start_batches, start_files, stop_when_idle, unified_stream,
)
from helpers import air_entry, counted, frame, message, weather_entry

HOUR = 1704067200


class Replay:
    """Lands messages and drains one query over them, again and again."""

    def __init__(self, spark, tmp_path, build):
        self.spark, self.build = spark, build
        self.feed, self.out, self.state = (str(tmp_path / n) for n in ("feed", "out", "state"))
        self.session = streaming_session(spark, 4)

    def land(self, topic, *texts):
        write_feed(frame(self.spark, texts, topic), self.feed)
        return self

    def drain(self):
        rows = self.build(read_feed(self.session, self.feed))
        query = start_files(rows, self.out, self.state, drain=True)
        query.awaitTermination()
        return counted(self.spark.read.parquet(self.out))


def joined(delay=None):
    return lambda messages: unified_stream(messages, "air", "weather", delay)



def test_a_row_waits_for_its_partner(spark, tmp_path):
    replay = Replay(spark, tmp_path, joined())
    assert replay.land("air", message(HOUR, air_entry("A"), air_entry("B"))).drain() == []
    rows = replay.land("weather", message(HOUR, weather_entry("A"))).drain()
    assert [r[1] for r in rows] == ["A"]


def test_global_distinct_outlives_a_restart_and_batch_distinct_does_not(spark, tmp_path):
    text = message(HOUR, air_entry("A"), air_entry("A"))
    whole = Replay(spark, tmp_path / "a", lambda m: clean.dedup_global(parse.air_rows(m)))
    assert len(whole.land("air", text).drain()) == 1
    assert len(whole.land("air", text).drain()) == 1
    assert len(whole.drain()) == 1

    sizes = []
    replay = Replay(spark, tmp_path / "b", None)
    for _ in range(2):
        replay.land("air", text)
        query = start_batches(
            parse.air_rows(read_feed(replay.session, replay.feed)),
            lambda batch, _: sizes.append(clean.dedup_batch(batch).count()),
            replay.state, drain=True,
        )
        query.awaitTermination()
    assert sizes == [1, 1]


def test_spread_distinct_equals_plain_distinct(spark, tmp_path):
    def build(messages):
        return clean.dedup_spread(parse.air_rows(messages, "n"), "n", parts=3)

    replay = Replay(spark, tmp_path, build)
    for hour in (0, 0, 1):
        texts = [message(HOUR + 3600 * hour, air_entry("A"), *[air_entry(f"x{i}")]) for i in range(6)]
        rows = replay.land("air", *texts).drain()
    assert len(rows) == 2 * 7 and len(set(rows)) == 14


def test_spread_join_equals_plain_join(spark, tmp_path):
    plain = Replay(spark, tmp_path / "a", joined())
    spread = Replay(spark, tmp_path / "b", lambda m: unified_stream(m, "air", "weather", "9 hours", 3))
    for i in range(2):
        airs = [air_entry("A", co=float(c)) for c in range(6 + i)] * 2
        for replay in (plain, spread):
            replay.land("air", message(HOUR, *airs))
            replay.land("weather", message(HOUR, weather_entry("A", temp=float(i)), weather_entry("B")))
            rows = replay.drain()
            assert len(rows) == (6 if i == 0 else 14)
    assert counted(spark.read.parquet(plain.out)) == rows


def test_late_rows_are_dropped_only_with_a_watermark(spark, tmp_path):
    early, late = message(HOUR, air_entry("A")), message(HOUR + 36000, air_entry("A"), air_entry("B"))
    partner = message(HOUR, weather_entry("A"))
    newer = message(HOUR + 36000, weather_entry("A"), weather_entry("B"))
    results = {}
    for delay in (None, "1 hour"):
        replay = Replay(spark, tmp_path / str(delay), joined(delay))
        replay.land("air", early, late).land("weather", newer).drain()
        results[delay] = replay.land("weather", partner).drain()
    assert len(results[None]) == 3
    assert len(results["1 hour"]) == 2


def test_stream_equals_batch_over_the_same_feed(spark, tmp_path):
    replay = Replay(spark, tmp_path, joined())
    for hour in range(3):
        names = [f"p{i}" for i in range(hour, hour + 4)]
        replay.land("air", message(HOUR + hour * 3600, *(air_entry(n) for n in names + names)))
        replay.land("weather", message(HOUR + hour * 3600, *(weather_entry(n) for n in names[1:])))
        rows = replay.drain()
    feed = backfill_feed(spark, replay.feed)
    batch = unify.unify(
        parse.air_rows(feed.where("topic = 'air'")), parse.weather_rows(feed.where("topic = 'weather'"))
    )
    assert rows == counted(batch) and len(rows) == 9


def test_streaming_plan(spark, tmp_path, capsys):
    replay = Replay(spark, tmp_path, None)
    replay.land("air", message(HOUR, air_entry()))
    joined()(read_feed(replay.session, replay.feed)).explain("extended")
    text = capsys.readouterr().out
    plan = text[text.index("== Optimized Logical Plan =="):text.index("== Physical Plan ==")]
    assert plan.count("from_json") == 2
    above, *below = plan.split("Deduplicate")
    assert len(below) == 2 and "Join Inner" in above
    assert all("atleastnnonnulls" in side for side in below)


def test_idle_queries_are_stopped(spark, tmp_path):
    replay = Replay(spark, tmp_path, None)
    replay.land("air", message(HOUR, air_entry()))
    watch = LastInput()
    session = replay.session
    session.streams.addListener(watch)
    try:
        rows = [
            start_batches(
                parse.air_rows(read_feed(session, replay.feed)), lambda batch, _: batch.count(),
                f"{replay.state}{i}", interval="1 second",
            )
            for i in range(2)
        ]
        began = time.monotonic()
        stop_when_idle(rows, watch, timeout=6, poll=0.5)
        assert not any(q.isActive for q in rows)
        assert time.monotonic() - began >= 5
        assert all(q.exception() is None for q in rows)
    finally:
        session.streams.removeListener(watch)


def test_idle_stop_waits_for_a_running_batch(spark, tmp_path):
    replay = Replay(spark, tmp_path, None).land("air", message(HOUR, air_entry()))
    watch, done = LastInput(), []

    def slow(batch, batch_id):
        batch.count()
        time.sleep(6)
        done.append(batch_id)

    replay.session.streams.addListener(watch)
    try:
        rows = parse.air_rows(read_feed(replay.session, replay.feed))
        query = start_batches(rows, slow, replay.state)
        stop_when_idle([query], watch, timeout=2, poll=0.2)
        assert done == [0] and query.exception() is None and not query.isActive
    finally:
        replay.session.streams.removeListener(watch)


def test_rows_behind_the_watermark_are_counted(spark, tmp_path):
    replay = Replay(spark, tmp_path, joined("1 hour"))
    watch = LastInput()
    replay.session.streams.addListener(watch)
    try:
        for hour in (0, 10, 11, 0):
            when = HOUR + 3600 * hour
            replay.land("air", message(when, air_entry(f"A{hour}", aqi=1 + hour % 5)))
            replay.land("weather", message(when, weather_entry(f"A{hour}")))
            replay.drain()
        time.sleep(1)
        assert sum(watch.dropped.values()) > 0
    finally:
        replay.session.streams.removeListener(watch)


def test_shared_clock():
    now = [0.0]
    watch = LastInput(clock=lambda: now[0])

    class Event:
        class progress:
            numInputRows = 0

    now[0] = 50.0
    watch.onQueryProgress(Event)
    assert watch.idle_seconds() == 50
    Event.progress.numInputRows = 3
    watch.onQueryProgress(Event)
    assert watch.idle_seconds() == 0


def test_state_partitions_follow_the_setting(spark):
    assert streaming_session(spark, 7).conf.get("spark.sql.shuffle.partitions") == "7"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"


def test_shared_folder_comes_from_the_session(spark):
    from envstream.session import shared_dir

    assert shared_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


@pytest.mark.parametrize("column", [S.TIME, "location_name"])
def test_unified_stream_keeps_its_columns(spark, tmp_path, column):
    replay = Replay(spark, tmp_path, None).land("air", message(HOUR, air_entry()))
    rows = joined("1 hour")(read_feed(replay.session, replay.feed))
    assert rows.isStreaming and column in rows.columns and tuple(rows.columns) == S.UNIFIED_COLUMNS


def test_equal_messages_are_told_apart_by_their_place(spark, tmp_path):
    replay = Replay(spark, tmp_path, None).land("air", *[message(HOUR, air_entry())] * 50)
    stream = read_feed(replay.session, replay.feed, positions=True)
    rows = parse.air_rows(stream, "message_no")
    start_files(rows, replay.out, replay.state, drain=True).awaitTermination()
    assert spark.read.parquet(replay.out).select("message_no").distinct().count() == 50
