"""Shapes of messages, raw files, flat rows and tables, as Spark DDL text.

Only fields that some operator reads are declared: Catalyst does not prune
inside a map-typed JSON schema, so every extra field would be decoded for
every entry.
"""

# --- fixed values: field names and types shared with the message producers ---
POLLUTANTS = ("co", "no", "no2", "o3", "so2", "pm2_5", "pm10", "nh3")

_COMPONENTS = "struct<" + ", ".join(f"{p}: double" for p in POLLUTANTS) + ">"
_AIR_MAIN = "struct<aqi: int>"
_COORD = "struct<lon: double, lat: double>"
_WEATHER_MAIN = (
    "struct<temp: double, feels_like: double, pressure: int, humidity: int, "
    "temp_min: double, temp_max: double>"
)
_WIND = "struct<speed: double, deg: int, gust: double>"
_CLOUDS = "struct<all: int>"
_CONDITIONS = "array<struct<description: string>>"

AIR_ENTRY = (
    "struct<location_id: struct<location_name: string, lon: double, lat: double>, "
    f"air_pollution_info: struct<main: {_AIR_MAIN}, components: {_COMPONENTS}>>"
)
WEATHER_ENTRY = (
    f"struct<location_id: string, weather_info: struct<main: {_WEATHER_MAIN}, "
    f"wind: {_WIND}, clouds: {_CLOUDS}, weather: {_CONDITIONS}>>"
)

# One message: {"<unix seconds>": [entry, ...]}
AIR_ENVELOPE = f"map<string, array<{AIR_ENTRY}>>"
WEATHER_ENVELOPE = f"map<string, array<{WEATHER_ENTRY}>>"

# One raw document: {"<location>": {"coord": ..., "list": [item, ...]}}
RAW_AIR = (
    f"map<string, struct<coord: {_COORD}, list: array<struct<dt: bigint, "
    f"main: {_AIR_MAIN}, components: {_COMPONENTS}>>>>"
)
RAW_WEATHER = (
    f"map<string, struct<list: array<struct<dt: bigint, main: {_WEATHER_MAIN}, "
    f"wind: {_WIND}, clouds: {_CLOUDS}, weather: {_CONDITIONS}>>>>"
)

CATALOGUE_RECORD = f"struct<id: bigint, name: string, country: string, coord: {_COORD}>"

# Flat column -> path inside one message entry.
AIR_FIELDS = {
    "location_name": "location_id.location_name",
    "longitude": "location_id.lon",
    "latitude": "location_id.lat",
    "air_quality_index": "air_pollution_info.main.aqi",
    **{p: f"air_pollution_info.components.{p}" for p in POLLUTANTS},
}
WEATHER_FIELDS = {
    "location_name": "location_id",
    "temperature": "weather_info.main.temp",
    "thermal_sensation": "weather_info.main.feels_like",
    "pressure": "weather_info.main.pressure",
    "humidity": "weather_info.main.humidity",
    "minimum_temperature": "weather_info.main.temp_min",
    "maximum_temperature": "weather_info.main.temp_max",
    "wind_speed": "weather_info.wind.speed",
    "wind_direction": "weather_info.wind.deg",
    "wind_gust": "weather_info.wind.gust",
    "cloudiness_percentage": "weather_info.clouds.all",
}

TIME = "timestamp_measurement"
JOIN_KEYS = (TIME, "location_name")
LABEL = "air_quality_index"

WEATHER_NUMBERS = (
    "temperature", "thermal_sensation", "pressure", "humidity",
    "minimum_temperature", "maximum_temperature", "wind_speed",
    "wind_direction", "wind_gust", "cloudiness_percentage",
)
AIR_COLUMNS = ("location_name", "longitude", "latitude", TIME, LABEL, *POLLUTANTS)
WEATHER_COLUMNS = (TIME, "location_name", *WEATHER_NUMBERS, "weather_description")
UNIFIED_COLUMNS = (
    TIME, "location_name", "longitude", "latitude", *POLLUTANTS,
    *WEATHER_NUMBERS, "weather_description", LABEL,
)
FEATURES = ("longitude", "latitude", *POLLUTANTS, *WEATHER_NUMBERS)

AIR_MEASURES = (LABEL, *POLLUTANTS)
WEATHER_MEASURES = (*WEATHER_NUMBERS, "weather_description")

_INTEGERS = {LABEL, "pressure", "humidity", "wind_direction", "cloudiness_percentage"}
_TEXTS = {"weather_description"}


def _ddl(columns):
    kinds = {**dict.fromkeys(_INTEGERS, "int"), **dict.fromkeys(_TEXTS, "string")}
    return ", ".join(f"{c} {kinds.get(c, 'double')}" for c in columns)


# Keys are bigint: they outgrow int long before the data set does.
LOCATIONS_TABLE = (
    "location_id bigint, location_name string, longitude double, latitude double"
)
AIR_TABLE = (
    f"air_pollution_data_id bigint, location_id bigint, {_ddl(AIR_MEASURES)}, "
    f"{TIME} timestamp"
)
WEATHER_TABLE = (
    f"weather_data_id bigint, location_id bigint, {_ddl(WEATHER_MEASURES)}, "
    f"{TIME} timestamp"
)
METRICS_ROW = "batch_id bigint, rmse double, mae double, accuracy double"
LEDGER_ROW = (
    "job string, batch_id bigint, locations_added bigint, air_added bigint, "
    "weather_added bigint"
)
# --- end of fixed values ---
