"""The jobs from raw files to tables and models, over a folder feed."""

import json

import pytest
from pyspark.sql import functions as F

from envstream import app, schemas as S
from envstream.plans.landing import merge_answers
from envstream.sources.tables import AIR, LOCATIONS, WEATHER, FolderStore
from envstream.streaming.table_writer import read_ledger
from helpers import counted

HOUR, PLACES, HOURS = 1704067200, ("Vic", "Berga", "Alella"), 12


@pytest.fixture
def raw_files(tmp_path):
    air, weather = {}, {}
    for n, place in enumerate(PLACES):
        times = [HOUR + 3600 * h for h in range(HOURS)]
        air[place] = {
            "coord": {"lon": float(n), "lat": 40.0},
            "list": [{"dt": t, "main": {"aqi": 1 + (t // 3600 + n) % 5},
                      "components": {p: float(t % 7 + i) for i, p in enumerate(S.POLLUTANTS)}} for t in times],
        }
        weather[place] = {"list": [
            {"dt": t, "main": {"temp": 1.0 * n, "feels_like": 1.0, "pressure": 990, "humidity": 40,
                               "temp_min": 0.0, "temp_max": 9.0},
             "wind": {"speed": 1.0, "deg": 10, "gust": 2.0}, "clouds": {"all": 5},
             "weather": [{"id": 1, "main": "x", "description": "mist", "icon": "y"}]} for t in times[1:]]}
    for name, data in (("air.json", air), ("weather.json", weather)):
        (tmp_path / name).write_text(json.dumps(data))
    return tmp_path


def replay(where, *more):
    app.main(["replay", "--air-file", f"{where}/air.json", "--weather-file", f"{where}/weather.json",
              "--feed", f"{where}/feed", *more])


def test_replay_then_tables(spark, raw_files):
    replay(raw_files)
    arguments = ["tables", "--feed", f"{raw_files}/feed", "--root", f"{raw_files}/db", "--ledger",
                 f"{raw_files}/ledger", "--checkpoint", f"{raw_files}/state", "--drain", "--per-trigger", "500"]
    for _ in range(2):
        app.main(arguments)
    store = FolderStore(spark, f"{raw_files}/db")
    assert [store.read(n).count() for n in (LOCATIONS, AIR, WEATHER)] == [3, 36, 33]
    assert counted(read_ledger(spark, f"{raw_files}/ledger")) == [(f"{raw_files}/state", 0, 3, 36, 33)]


def test_replay_of_the_first_times(spark, raw_files):
    replay(raw_files, "--first", "2", "--whole")
    rows = spark.read.parquet(f"{raw_files}/feed").selectExpr("topic", "cast(value as string) as text").collect()
    assert sorted(r.topic for r in rows) == ["air", "air", "weather", "weather"]
    assert {next(iter(json.loads(r.text))) for r in rows} == {str(HOUR), str(HOUR + 3600)}
    empty = [r for r in rows if r.topic == "weather" and json.loads(r.text) == {str(HOUR): []}]
    assert len(empty) == 1


def test_replay_then_train(spark, raw_files):
    replay(raw_files)
    app.main(["train", "--feed", f"{raw_files}/feed", "--models", f"{raw_files}/models", "--metrics",
              f"{raw_files}/metrics", "--checkpoint", f"{raw_files}/state", "--delay", "2 hours", "--drain",
              "--scores", f"{raw_files}/scores"])
    assert spark.read.parquet(f"{raw_files}/metrics").count() == 1
    assert spark.read.parquet(f"{raw_files}/scores").count() > 0
    assert (raw_files / "models" / "0").exists()


def test_stretches_come_in_order_of_time(spark, raw_files):
    replay(raw_files, "--stretch", "7200")
    times = (spark.read.parquet(f"{raw_files}/feed")
             .selectExpr("_metadata.file_modification_time as at",
                         "regexp_extract(cast(value as string), '([0-9]+)', 1) as dt")
             .groupBy("dt").agg(F.max("at").alias("at")).orderBy("dt").collect())
    written = [r["at"] for r in times]
    assert len(times) == HOURS and all(a <= b for a, b in zip(written[::2], written[2::2]))


def test_land_then_backfill(spark, raw_files, tmp_path):
    for kind in ("air", "weather"):
        data = json.loads((raw_files / f"{kind}.json").read_text())
        lines = [json.dumps({"location_name": n, "fetch_no": f, **d}) for n, d in data.items() for f in (0, 1)]
        (tmp_path / f"{kind}-answers.json").write_text("\n".join(lines))
        app.main(["land", "--answers", f"{tmp_path}/{kind}-answers.json", "--kind", kind,
                  "--out", f"{tmp_path}/{kind}-raw"])
    app.main(["replay", "--air-file", f"{tmp_path}/air-raw", "--weather-file", f"{tmp_path}/weather-raw",
              "--feed", f"{tmp_path}/landed"])
    app.main(["backfill", "--feed", f"{tmp_path}/landed", "--out", f"{tmp_path}/joined"])
    assert spark.read.parquet(f"{tmp_path}/joined").count() == len(PLACES) * (HOURS - 1)


def test_a_folder_or_a_database_but_not_both():
    with pytest.raises(SystemExit):
        app.main(["tables", "--feed", "x", "--checkpoint", "y", "--root", "a", "--jdbc-url", "jdbc:x:y"])


def test_plan(spark, tmp_path):
    (tmp_path / "city.json").write_text(json.dumps(
        [{"id": i, "name": n, "country": c, "coord": {"lon": 1.0, "lat": 2.0}}
         for i, (n, c) in enumerate([("Vic", "ES"), ("Vic", "US"), ("Lima", "PE")])]))
    (tmp_path / "names.txt").write_text('"Vic", "Berga"')
    app.main(["plan", "--catalogue", f"{tmp_path}/city.json", "--names", f"{tmp_path}/names.txt",
              "--country", "ES", "--first-day", "2024-01-01", "--out", f"{tmp_path}/out"])
    requests = spark.read.option("header", True).csv(f"{tmp_path}/out/requests")
    assert requests.columns == ["index", "name", "id", "lon", "lat", "week_no", "start_unix", "end_unix"]
    assert requests.count() == 9


def test_a_broker_or_a_folder_but_not_both():
    with pytest.raises(SystemExit):
        app.main(["tables", "--root", "x", "--checkpoint", "y"])


def test_overlapping_answers(spark):
    answers = spark.createDataFrame(
        [("Vic", 1, [(10, 1.0), (20, 1.0)]), ("Vic", 0, [(20, 0.0), (30, 0.0), (30, 5.0)]), ("Lima", 0, [])],
        "location_name string, fetch_no int, list array<struct<dt: bigint, v: double>>",
    )
    rows = merge_answers(answers).select("location_name", "dt", "item.v")
    assert counted(rows) == [("Vic", 10, 1.0), ("Vic", 20, 0.0), ("Vic", 30, 0.0)]
