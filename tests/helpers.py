"""Hand-written messages and small frames."""

import json

from envstream import schemas as S


def air_entry(name="A", lon=1.0, lat=2.0, aqi=3, **components):
    values = {p: float(i) for i, p in enumerate(S.POLLUTANTS)} | components
    return {
        "location_id": {"location_name": name, "lon": lon, "lat": lat},
        "air_pollution_info": {"main": {"aqi": aqi}, "components": values},
    }


def weather_entry(name="A", temp=10.0, deg=270, gust=4.0, conditions=("rain",)):
    wind = {"speed": 2.0, "deg": deg}
    if gust is not None:
        wind["gust"] = gust
    return {
        "location_id": name,
        "weather_info": {
            "main": {
                "temp": temp, "feels_like": 9.0, "pressure": 1000, "humidity": 50,
                "temp_min": 8.0, "temp_max": 12.0,
            },
            "wind": wind,
            "clouds": {"all": 75},
            "weather": [
                {"id": 500, "main": "Rain", "description": c, "icon": "10d"} for c in conditions
            ],
        },
    }


def message(dt, *entries):
    return json.dumps({str(dt): list(entries)})


def frame(spark, texts, topic=None):
    if topic is None:
        return spark.createDataFrame(
            [(None if t is None else bytearray(t, "utf-8"),) for t in texts], "value binary"
        )
    return spark.createDataFrame(
        [(topic, bytearray(t, "utf-8")) for t in texts], "topic string, value binary"
    )


def plan_text(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def physical_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def counted(df):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
