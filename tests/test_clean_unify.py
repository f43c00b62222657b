from envstream import schemas as S
from envstream.operators import clean, parse, unify
from helpers import air_entry, counted, frame, message, weather_entry

HOUR = 1704067200


def readings(spark, air, weather):
    return (
        parse.air_rows(frame(spark, [message(HOUR, *air)])),
        parse.weather_rows(frame(spark, [message(HOUR, *weather)])),
    )


def test_missing_gust_never_reaches_the_model(spark):
    air, weather = readings(
        spark, [air_entry("A"), air_entry("B")],
        [weather_entry("A", gust=None), weather_entry("B")],
    )
    assert [r.location_name for r in unify.unify(air, weather).collect()] == ["B"]


def test_not_a_number_counts_as_missing(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (None, "c")], "x double, y string")
    assert [r.y for r in clean.drop_nulls(df).collect()] == ["a"]
    assert clean.drop_nulls(df, ["y"]).count() == 3


def test_copies_collapse_and_differing_rows_stay(spark):
    air, weather = readings(
        spark, [air_entry("A"), air_entry("A"), air_entry("A", co=9.0)],
        [weather_entry("A"), weather_entry("A"), weather_entry("A", temp=11.0)],
    )
    rows = unify.unify(air, weather)
    assert tuple(rows.columns) == S.UNIFIED_COLUMNS and len(rows.columns) == 24
    assert rows.count() == 4 and rows.distinct().count() == 4


def test_missing_keys_never_match(spark):
    air, weather = readings(
        spark, [air_entry(None)], [weather_entry(None), weather_entry("A")]
    )
    assert unify.join_readings(air, weather).count() == 0


def test_other_hour_or_name_does_not_match(spark):
    air = parse.air_rows(frame(spark, [message(HOUR, air_entry("A")), message(HOUR + 3600, air_entry("a"))]))
    weather = parse.weather_rows(frame(spark, [message(HOUR + 3600, weather_entry("A"))]))
    assert unify.unify(air, weather).count() == 0


def test_order_of_steps_does_not_change_the_result(spark, sf_dir):
    """NULL rows last and a distinct after the join give the same rows."""
    from envstream.plans import derived

    air = parse.air_rows(derived.air_messages(spark, sf_dir))
    weather = parse.weather_rows(derived.weather_messages(spark, sf_dir))
    late = unify.join_readings(air.distinct(), weather.distinct()).distinct().dropna()
    assert counted(late) == counted(unify.unify(air, weather))


def test_first_and_last_per_key(spark):
    rows = [("a", 1, 0, "x"), ("a", 0, 5, "y"), ("a", 0, 2, "z"), ("b", 3, 3, "w"), ("b", None, 0, "v")]
    df = spark.createDataFrame(rows, "k string, fetch_no int, pos int, v string")
    first = clean.first_per_key(df, ["k"], ["fetch_no", "pos"])
    last = clean.last_per_key(df, ["k"], ["fetch_no", "pos"])
    assert {r.k: r.v for r in first.collect()} == {"a": "z", "b": "w"}
    assert {r.k: r.v for r in last.collect()} == {"a": "x", "b": "w"}


def test_categories(spark):
    df = spark.createDataFrame([(1,), (2,), (1,), (None,)], "c int")
    assert counted(clean.categories(df, "c")) == [(1, 2), (2, 1), (None, 1)]
    assert clean.category_count(df, "c").first()[0] == 2
