import json

from pyspark.sql import functions as F

from envstream.operators import encode, parse
from envstream.sinks import outputs
from envstream.sources import files
from helpers import counted

AIR = {
    "Vic": {
        "coord": {"lon": 2.25, "lat": 41.93},
        "list": [
            {"dt": 20, "main": {"aqi": 2}, "components": {"co": 1.5, "nh3": 0.5}},
            {"dt": 10, "main": {"aqi": 1}, "components": {"co": 2.5}},
            {"dt": 20, "main": {"aqi": 2}, "components": {"co": 1.5, "nh3": 0.5}},
        ],
    },
    "Alella": {"coord": {"lon": 2.29, "lat": 41.49},
               "list": [{"dt": 20, "main": {"aqi": 4}, "components": {}}]},
    "Empty": {"coord": {"lon": 0.0, "lat": 0.0}, "list": []},
}
WEATHER = {
    "Vic": {"list": [{"dt": 30, "main": {"temp": 1.0}, "wind": {"speed": 2.0}, "clouds": {"all": 3},
                      "weather": [{"description": "mist"}], "rain": {"1h": 9}}]},
}
ORDER = ["location_no", "item_no"]


def raw(spark, tmp_path):
    for name, data in (("air.json", AIR), ("weather.json", WEATHER)):
        (tmp_path / name).write_text(json.dumps(data), encoding="utf-8")
    air = files.scan_raw_air(spark, str(tmp_path / "air.json"))
    weather = files.scan_raw_weather(spark, str(tmp_path / "weather.json"))
    return (
        air.withColumn("dt", F.col("item.dt")).withColumn("entry", encode.air_entry()),
        weather.withColumn("dt", F.col("item.dt")).withColumn("entry", encode.weather_entry()),
    )


def grouped(df, **how):
    return encode.regroup(df, ["dt"], "entry", ORDER, encode.span_of("location_no"), **how)


def test_scan_of_whole_documents(spark, tmp_path):
    air, _ = raw(spark, tmp_path)
    rows = air.select("location_no", "location_name", "item_no", "coord.lon", "item.dt", "item.main.aqi")
    assert counted(rows) == [
        (0, "Vic", 0, 2.25, 20, 2), (0, "Vic", 1, 2.25, 10, 1), (0, "Vic", 2, 2.25, 20, 2),
        (1, "Alella", 0, 2.29, 20, 4),
    ]


def test_groups_keep_source_order_and_copies(spark, tmp_path):
    air, _ = raw(spark, tmp_path)
    by_time = {r.dt: r.entries for r in grouped(air).collect()}
    assert [e.location_id.location_name for e in by_time[20]] == ["Vic", "Vic", "Alella"]
    assert [e.location_id.location_name for e in by_time[10]] == ["Vic"]


def test_long_groups_are_cut_and_stay_whole(spark, tmp_path):
    air, _ = raw(spark, tmp_path)
    parts = grouped(air, max_entries=2).where("dt = 20").orderBy("stretch", "chunk").collect()
    assert [len(p.entries) for p in parts] == [2, 1]
    names = [e.location_id.location_name for p in parts for e in p.entries]
    assert names == ["Vic", "Vic", "Alella"]


def test_a_stretch_splits_a_hot_hour(spark):
    df = spark.range(50).select(F.col("id").alias("pos"), F.lit(7).alias("dt"), F.col("id").alias("entry"))
    groups = encode.regroup(df, ["dt"], "entry", ["pos"], encode.span_of("pos", 20), max_entries=8)
    lists = [r.entries for r in groups.orderBy("stretch", "chunk").collect()]
    assert [len(x) for x in lists] == [8, 8, 4, 8, 8, 4, 8, 2]
    assert [e for x in lists for e in x] == list(range(50))


def test_both_topics_get_a_message_per_time(spark, tmp_path):
    air, weather = raw(spark, tmp_path)
    aligned = encode.align(grouped(air), grouped(weather)).orderBy("dt").collect()
    assert [(r.dt, len(r.air_entries), len(r.weather_entries)) for r in aligned] == [
        (10, 1, 0), (20, 3, 0), (30, 0, 1),
    ]
    keys = encode.key_union(air, weather)
    assert [r.dt for r in encode.first_timestamps(keys).collect()] == [10, 20, 30]
    assert [r.dt for r in encode.first_timestamps(keys, 2).collect()] == [10, 20]
    assert encode.timestamp_count(keys).first()[0] == 3


def test_messages_hold_one_key_and_four_blocks(spark, tmp_path):
    _, weather = raw(spark, tmp_path)
    text = bytes(encode.encode(grouped(weather)).first().value).decode("utf-8")
    body = json.loads(text)
    assert list(body) == ["30"]
    assert body["30"][0]["location_id"] == "Vic"
    assert set(body["30"][0]["weather_info"]) == {"main", "wind", "clouds", "weather"}


def test_encode_then_decode(spark, tmp_path):
    air, weather = raw(spark, tmp_path)
    aligned = encode.align(grouped(air), grouped(weather))
    back = parse.air_rows(encode.encode(aligned, "air_entries"))
    assert counted(back.select("location_name", "air_quality_index", "co", "nh3")) == [
        ("Alella", 4, None, None), ("Vic", 1, 2.5, None), ("Vic", 2, 1.5, 0.5), ("Vic", 2, 1.5, 0.5),
    ]
    assert parse.weather_rows(encode.encode(aligned, "weather_entries")).count() == 1


def test_raw_lines_read_back_by_line(spark, tmp_path):
    air, _ = raw(spark, tmp_path)
    lines = outputs.raw_lines(
        air, coord="coord", order=ORDER, stretch=encode.span_of("location_no"), max_entries=2
    )
    outputs.write_lines(lines, str(tmp_path / "lines"))
    back = files.scan_raw_air(spark, str(tmp_path / "lines"), whole=False)
    columns = ["location_name", "coord.lat", "item.dt", "item.components.co"]
    assert counted(back.select(*columns)) == counted(air.select(*columns))
    assert spark.read.text(str(tmp_path / "lines")).count() == 3
