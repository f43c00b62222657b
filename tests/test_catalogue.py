import json

from envstream.operators import catalogue as cat
from envstream.operators import clean
from envstream.sinks import outputs
from envstream.sources import files
from helpers import counted

CITIES = [
    {"id": 5, "name": "Berga", "country": "ES", "coord": {"lon": 1.8, "lat": 42.1}, "state": ""},
    {"id": 6, "name": "Paris", "country": "FR", "coord": {"lon": 2.3, "lat": 48.8}},
    {"id": 7, "name": "Vic", "country": "ES", "coord": {"lon": 2.2, "lat": 41.9}},
    {"id": 8, "name": "Berga", "country": "ES", "coord": {"lon": 9.9, "lat": 9.9}},
]
NAMES = "\"Vic\", \"Castellar de n\"Hug\", \"Gornal'\", \"Vic\", \"Berga\""


def write(tmp_path):
    (tmp_path / "city.json").write_text(json.dumps(CITIES), encoding="utf-8")
    (tmp_path / "names.txt").write_text(NAMES, encoding="utf-8")
    return str(tmp_path / "city.json"), str(tmp_path / "names.txt")


def test_name_list_keeps_the_text_rule(spark, tmp_path):
    _, names = write(tmp_path)
    rows = files.scan_name_list(spark, names).orderBy("item_no").collect()
    assert [r.name for r in rows] == ["Vic", "Castellar de nHug", "Gornal'", "Vic", "Berga"]


def test_location_table(spark, tmp_path):
    cities, names = write(tmp_path)
    rows = files.scan_catalogue(spark, cities)
    chosen = cat.named_in(cat.in_country(rows, "ES"), files.scan_name_list(spark, names))
    table = cat.location_table(chosen)
    assert table.columns == ["index", "name", "id", "lon", "lat"]
    assert counted(table) == [(0, "Berga", 5, 1.8, 42.1), (2, "Vic", 7, 2.2, 41.9), (3, "Berga", 8, 9.9, 9.9)]
    outputs.write_csv(table, str(tmp_path / "csv"))
    back = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert back.columns == table.columns and back.count() == 3
    last = clean.last_per_key(table, ["name"], ["index"])
    assert counted(last.select("name", "id")) == [("Berga", 8), ("Vic", 7)]


def test_only_documents_with_readings(spark):
    df = spark.createDataFrame([("a", [1]), ("b", []), ("c", None)], "name string, list array<int>")
    assert [r.name for r in cat.with_readings(df).collect()] == ["a"]


def test_fetch_plan(spark):
    places = spark.createDataFrame([("Vic", 2.2, 41.9)], "name string, lon double, lat double")
    rows = cat.fetch_plan(places, "2024-01-01 00:00:00").orderBy("week_no").collect()
    assert [r.start_unix for r in rows] == [1704067200 + 604800 * w for w in range(9)]
    assert {r.end_unix for r in rows} == {1704067200 + 604800 * 9}


def test_fetch_plan_steps_by_wall_clock(spark):
    places = spark.createDataFrame([("Vic",)], "name string")
    rows = cat.fetch_plan(places, "2024-03-28 00:00:00", weeks=2, zone="Europe/Madrid")
    starts = [r.start_unix for r in rows.orderBy("week_no").collect()]
    assert starts[0] == 1711580400 and starts[1] - starts[0] == 604800 - 3600
