"""The same results in plain SQL, for DuckDB over the same tables."""

from __future__ import annotations

from envstream import schemas as S
from envstream.plans import derived as D

#: Delay of the bounded distincts.
DELAY_SECONDS = 7200
HOUR = "cast(epoch(date_trunc('hour', ts)) as bigint)"


def _times(name, factor):
    return f"value * cast({factor} as double) as {name}"


def _list(*columns):
    return ", ".join(columns)


AIR = f"""
air_once as (
  select event_id as pos, {HOUR} as dt, {D.LOCATION} as location_name,
    {D.LON} as longitude, {D.LAT} as latitude, {D.AQI} as air_quality_index,
    {_list(*(_times(p, D.POLLUTANT_FACTORS[p]) for p in S.POLLUTANTS))},
    unnest(range(1, case when event_type = 'signup' then 3 else 2 end)) as copy
  from events where event_type <> 'error'),
air as (select dt as measured_at, cast(copy as int) as copy_no, * exclude (copy) from air_once)
"""

WEATHER = f"""
weather_once as (
  select event_id as pos, {HOUR} as dt, {D.LOCATION} as location_name,
    {_times('temperature', D.WEATHER_FACTORS['temp'])},
    {_times('thermal_sensation', D.WEATHER_FACTORS['feels_like'])},
    {D.WEATHER_INTS['pressure']} as pressure, {D.WEATHER_INTS['humidity']} as humidity,
    {_times('minimum_temperature', D.WEATHER_FACTORS['temp_min'])},
    {_times('maximum_temperature', D.WEATHER_FACTORS['temp_max'])},
    {_times('wind_speed', D.SPEED_FACTOR)}, {D.DEG} as wind_direction,
    case when event_id % 4 <> 0 then value * cast({D.GUST_FACTOR} as double) end as wind_gust,
    {D.CLOUDS} as cloudiness_percentage,
    case when event_id % 7 <> 0 then event_type end as weather_description,
    cast(case when event_id % 7 <> 0 then 1 else 0 end as int) as n_conditions,
    unnest(range(1, case when event_type = 'view' then 3 else 2 end)) as copy
  from events where event_type <> 'signup'),
weather as (
  select dt as measured_at, cast(copy as int) as copy_no, * exclude (copy) from weather_once)
"""

BOTH = f"with {AIR}, {WEATHER}"

AIR_COLUMNS = _list(*("measured_at" if c == S.TIME else c for c in S.AIR_COLUMNS))
WEATHER_COLUMNS = _list(*("measured_at" if c == S.TIME else c for c in S.WEATHER_COLUMNS))
UNIFIED_COLUMNS = _list(*("measured_at" if c == S.TIME else c for c in S.UNIFIED_COLUMNS))
COMPLETE = " and ".join(
    f"{c} is not null" for c in ("measured_at", "location_name", *S.WEATHER_MEASURES)
)

JOINED = f"""
joined as (
  select distinct {UNIFIED_COLUMNS} from air join weather using (measured_at, location_name)
  where {COMPLETE})
"""

LOCATIONS = f"""
named as (
  select location_name, min(longitude) as longitude, min(latitude) as latitude from (
    select location_name, longitude, latitude from air
    union all select location_name, null, null from weather)
  group by location_name),
dimension as (
  select row_number() over (order by md5(location_name), location_name) as location_id, *
  from named)
"""


def _first(source, measures):
    return (
        f"select * exclude (rn) from (select *, row_number() over (partition by "
        f"measured_at, location_name order by {_list(*measures)}) as rn from {source}) where rn = 1"
    )


def _fact(source, measures, id_column):
    # 2^34 seconds per location, counted from 2^33 seconds before 1970.
    return f"""
    select location_id * 17179869184 + measured_at + 8589934592 as {id_column},
      location_id, {_list(*measures)}, measured_at
    from ({_first(source, measures)}) join dimension using (location_name)"""


def _slices(count=4):
    return f"""
bounds as (select min(measured_at) as low, max(measured_at) as high from (
  select measured_at from air union all select measured_at from weather)),
sliced as (
  select location_name, longitude, latitude, topic,
    (measured_at - low) // ((high - low) // {count} + 1) as slice_no
  from (select location_name, longitude, latitude, measured_at, 'air' as topic from air
    union all select location_name, null, null, measured_at, 'weather' from weather), bounds),
entered as (select *, min(slice_no) over (partition by location_name) as first_slice from sliced)
"""


def _facts_by_slice(source, count=4):
    return f"""
of_{source} as (
  select batch_id, count(*) as {source}_added from (
    select distinct (measured_at - low) // ((high - low) // {count} + 1) as batch_id,
      location_name, measured_at from {source}, bounds) group by batch_id)
"""


def _ids_by_place(source):
    # 2^34 seconds per location, counted from 2^33 seconds before 1970.
    return f"""
ids_of_{source} as (
  select location_id, count(*) as {source}_facts, cast(min(
      cast(location_id as hugeint) * 17179869184 + measured_at + 8589934592) as varchar)
      as first_{source}_id
  from (select distinct location_name, measured_at from {source})
    join places using (location_name) group by location_id)
"""


def _regrouped(source):
    return f"""
    ranked as (
      select *, pos // 1048576 as stretch,
        row_number() over (partition by dt, pos // 1048576 order by pos, copy_no) - 1 as rk
      from {source}),
    grouped as (
      select *, rk // 1000 as chunk, cast(rk % 1000 as int) as entry_no from ranked)"""


def _message_sizes(source, prefix):
    return f"""
    {prefix}_ranked as (
      select dt, pos, copy_no, location_name, pos // 1048576 as stretch,
        row_number() over (partition by dt, pos // 1048576 order by pos, copy_no) - 1 as rk
      from {source}),
    {prefix}_sizes as (
      select dt, stretch, rk // 1000 as chunk, cast(count(*) as int) as n,
        string_agg(location_name, ',' order by rk) as names
      from {prefix}_ranked group by all)"""


FETCHED = f"""
kinds as (select event_id as pos, event_type from events),
fetched as (
  select location_name, dt, pos, copy_no as copy, temperature as temp, 0 as fetch_no
  from weather join kinds using (pos) where event_type <> 'error'
  union all
  select location_name, dt, pos, copy_no, temperature + 1, 1 from weather)
"""

CATALOGUE = """
catalogue as (
  select c_custkey as "index", c_custkey as id,
    concat('n_', cast(c_custkey // 4 as varchar)) as name, c_mktsegment as country,
    cast(c_nationkey as double) as lon, c_acctbal as lat
  from customer)
"""

NAMES = """
names as (
  select unnest([0, 1, 2])::int as item_no,
    unnest([concat('n_', s_suppkey), concat('odd n_', s_suppkey), concat('n_', s_suppkey + 1)])
      as name
  from supplier)
"""

PAIRS = """
pairs as (
  select p as prediction, cast(air_quality_index as double) as label,
    cast(trunc(p) as int) as rounded_prediction, cast(round(p) as int) as nearest_prediction
  from (select *, least(cast(5 as double), cast(1 as double) + co / cast(100 as double)) as p
    from air))
"""

SCORES = """
sqrt(avg((prediction - label) * (prediction - label))) as rmse,
avg(abs(prediction - label)) as mae,
avg(case when rounded_prediction = label then cast(1 as double) else cast(0 as double) end)
  as accuracy
"""
ROUNDED = "round(rmse, 9) as rmse, round(mae, 9) as mae, round(accuracy, 9) as accuracy"

_POLLUTANTS = _list(*S.POLLUTANTS)

_CONFUSION = f"""{BOTH}, {PAIRS} select label,
            cast(rounded_prediction as double) as predicted, count(*) as n_rows from pairs
            where rounded_prediction in (select label from pairs) group by 1, 2"""

_UNIFIED = f"{BOTH}, {JOINED} select {UNIFIED_COLUMNS} from joined"
_FACT_AIR = (
    f"{BOTH}, {LOCATIONS} {_fact('air', S.AIR_MEASURES, 'air_pollution_data_id')}"
)


def _scaled():
    deviations = _list(*(f"stddev_samp({f}) as sd_{f}" for f in S.FEATURES))
    scaled = _list(*(
        f"round(case when sd_{f} = 0 then 0 else {f} / sd_{f} end, 6) as scaled_{f}"
        for f in S.FEATURES
    ))
    return (
        f"{BOTH}, {JOINED}, spread as (select {deviations} from joined) "
        f"select measured_at, location_name, {scaled} from joined, spread"
    )


def oracle():
    return {
        "parse_air": f"{BOTH} select measured_at, location_name, longitude as lon, "
        f"latitude as lat, air_quality_index as aqi, {_POLLUTANTS} from air",
        "parse_weather": f"""{BOTH} select measured_at, location_name as location_id,
            temperature as temp, thermal_sensation as feels_like, pressure, humidity,
            minimum_temperature as temp_min, maximum_temperature as temp_max,
            wind_speed as speed, wind_direction as deg, wind_gust as gust,
            cloudiness_percentage as "all", n_conditions from weather""",
        "flatten_air": f"{BOTH} select {AIR_COLUMNS} from air",
        "flatten_weather": f"{BOTH} select {WEATHER_COLUMNS} from weather",
        "first_description": f"{BOTH} select measured_at, location_name, weather_description "
        "from weather",
        "epoch_to_ts": f"""
            select 'air' as topic, event_id as pos, cast({HOUR} as varchar) as unix_timestamp,
              {HOUR} as measured_at from events where event_type <> 'error'
            union all
            select 'weather', event_id, cast({HOUR} as varchar), {HOUR}
            from events where event_type <> 'signup'""",
        "rejected_messages": """
            select case event_type when 'error' then 'not an envelope' else 'key is no time' end
              as reason, count(*) as n_messages
            from events where event_type in ('error', 'click') group by 1""",
        "drop_nulls": f"{BOTH} select {WEATHER_COLUMNS} from weather where {COMPLETE}",
        "batch_distinct": f"{BOTH} select distinct {AIR_COLUMNS} from air",
        "unified": _UNIFIED,
        "label_categories": f"{BOTH} select air_quality_index, count(*) as n_rows from air "
        "group by 1",
        "label_category_count": f"{BOTH} select count(distinct air_quality_index) "
        "as n_categories from air",
        "first_per_key": f"""{BOTH}, {FETCHED} select * exclude (rn) from (
            select *, row_number() over (partition by location_name, dt
              order by fetch_no, pos, copy) as rn from fetched) where rn = 1""",
        "last_per_name": f"""with {CATALOGUE} select "index", name, id, lon, lat from (
            select *, row_number() over (partition by name order by "index" desc) as rn
            from catalogue) where rn = 1""",
        "stream_dedup": f"{BOTH} select distinct {AIR_COLUMNS} from air",
        "stream_dedup_spread": f"{BOTH} select distinct {AIR_COLUMNS} from air",
        "stream_dedup_digest": f"{BOTH} select distinct {AIR_COLUMNS} from air",
        "state_after_replay": f"""{BOTH}, late as (
              select distinct {AIR_COLUMNS} from air),
            edge as (select max(measured_at) as newest from late)
            select 'rows' as state, count(*) as n_rows from late, edge
            where measured_at > newest - {DELAY_SECONDS}
            union all select 'digests', count(*) from late, edge
            where measured_at > newest - 2 * {DELAY_SECONDS}""",
        "stream_join": _UNIFIED,
        "stream_join_bounded": _UNIFIED,
        "stream_join_spread": _UNIFIED,
        "stream_join_replayed": _UNIFIED,
        "stream_weather_facts": f"{BOTH} select location_name, measured_at, "
        f"{_list(*S.WEATHER_MEASURES)} from ({_first('weather', S.WEATHER_MEASURES)})",
        "rf_checks": f"""{BOTH}, {JOINED} select count(*) as n_rows, true as in_range,
            true as beats_mean from joined where
            substr(md5(location_name || '|' || cast(measured_at as varchar)), 1, 4) >= 'cccd'""",
        "stream_facts": f"{BOTH} select location_name, measured_at, {_list(*S.AIR_MEASURES)} "
        f"from ({_first('air', S.AIR_MEASURES)})",
        "stream_two_writers": f"""{BOTH},
            places as (
              select location_name, cast('0x' || substr(md5(location_name), 1, 15) as bigint)
                as location_id
              from (select location_name from air union select location_name from weather)
              where location_name is not null),
            {_ids_by_place("air")}, {_ids_by_place("weather")}
            select location_id, location_name, coalesce(air_facts, 0) as air_facts,
              first_air_id, coalesce(weather_facts, 0) as weather_facts, first_weather_id
            from places left join ids_of_air using (location_id)
              left join ids_of_weather using (location_id)""",
        "stream_locations": f"""{BOTH}, {_slices()}
            select location_name, min(longitude) as longitude, min(latitude) as latitude
            from entered where slice_no = first_slice group by location_name""",
        "stream_last_per_key": f"""{BOTH} select {WEATHER_COLUMNS} from (
            select *, row_number() over (partition by location_name order by
              measured_at desc nulls last, {_list(*(f"{c} desc nulls last" for c in S.WEATHER_MEASURES))}
            ) as place from weather) where place = 1""",
        "ledger_after_crash": f"""{BOTH}, {_slices()},
            of_locations as (
              select slice_no as batch_id, count(distinct case when slice_no = first_slice
                then location_name end) as locations_added from entered group by slice_no),
            {_facts_by_slice("air")}, {_facts_by_slice("weather")}
            select batch_id, locations_added, coalesce(air_added, 0) as air_added,
              coalesce(weather_added, 0) as weather_added
            from of_locations left join of_air using (batch_id)
              left join of_weather using (batch_id)""",
        "dim_locations": f"{BOTH}, {LOCATIONS} select * from dimension",
        "scan_locations": f"{BOTH}, {LOCATIONS} select * from dimension",
        "fact_air": _FACT_AIR,
        "fact_weather": f"{BOTH}, {LOCATIONS} "
        f"{_fact('weather', S.WEATHER_MEASURES, 'weather_data_id')}",
        "facts_ordered": f"{_FACT_AIR} order by measured_at, location_id",
        "fk_orphans": f"""{BOTH}, {LOCATIONS} select distinct location_id, measured_at
            from air join dimension using (location_name)
            where location_name not in (select concat('loc_', s_suppkey) from supplier)""",
        "insert_if_absent": f"""{BOTH},
            early as (select event_id from events where event_type in ('view', 'click')),
            existing as (select distinct location_name, dt, true as known from air
              where pos in (select event_id from early))
            select location_name, dt, co, pos from (
              select *, row_number() over (partition by location_name, dt order by co, pos) as rn
              from air) left join existing using (location_name, dt)
            where rn = 1 and known is null""",
        "regroup_air": f"{BOTH}, {_regrouped('air')} select dt, stretch, chunk, entry_no, "
        "location_name, longitude as lon, latitude as lat, air_quality_index as aqi, "
        f"{_POLLUTANTS} from grouped",
        "regroup_weather": f"{BOTH}, {_regrouped('weather')} select dt, stretch, chunk, "
        "entry_no, location_name as location_id, temperature as temp, wind_gust as gust, "
        'cloudiness_percentage as "all", n_conditions from grouped',
        "key_union": f"{BOTH} select dt from air union select dt from weather",
        "timestamp_count": f"{BOTH} select count(distinct dt) as n_timestamps from "
        "(select dt from air union all select dt from weather)",
        "first_n_timestamps": f"{BOTH} select dt from (select dt from air union "
        "select dt from weather) order by dt limit 10",
        "align_topics": f"""{BOTH}, {_message_sizes('air', 'a')}, {_message_sizes('weather', 'w')}
            select dt, stretch, chunk, coalesce(a.n, 0) as n_air, coalesce(w.n, 0) as n_weather,
              coalesce(a.names, '') as air_names, coalesce(w.names, '') as weather_names
            from a_sizes a full join w_sizes w using (dt, stretch, chunk)""",
        "encode_roundtrip": f"{BOTH} select {WEATHER_COLUMNS} from weather",
        "encode_roundtrip_air": f"{BOTH} select {AIR_COLUMNS} from air",
        "scan_map_json": f"""{BOTH} select location_name, longitude as lon, latitude as lat,
            cast((row_number() over (partition by location_name, pos // 1048576
              order by pos, copy_no) - 1) % 1000 as int) as item_no,
            dt, air_quality_index as aqi, {_POLLUTANTS} from air""",
        "scan_map_document": f"""{BOTH} select concat('{{"', location_name, '}}\\') as location_name,
            longitude as lon, latitude as lat,
            cast((row_number() over (partition by location_name, pos // 1048576
              order by pos, copy_no) - 1) % 1000 as int) as item_no,
            dt, air_quality_index as aqi, {_POLLUTANTS} from air""",
        "scan_array_document": f"""with {CATALOGUE} select row_number() over (order by id) - 1
            as "index", id, concat(name, '}}, {{"') as name, country, lon, lat from catalogue""",
        "scan_name_line": """select
            cast(row_number() over (order by s_suppkey, k) - 1 as int) as item_no,
            case k when 0 then concat('n_', s_suppkey) when 1 then concat('odd n_', s_suppkey)
              else concat('n_', s_suppkey + 1) end as name
            from supplier, range(3) as t(k)""",
        "scan_catalogue": f"""with {CATALOGUE} select cast(row_number() over (
            partition by id // 1000 order by id) - 1 as int) as "index", id, name, country,
            lon, lat from catalogue""",
        "name_list": f"with {NAMES} select item_no, name from names",
        "catalogue_by_country": f"with {CATALOGUE} select id, name, country from catalogue "
        "where country = 'FURNITURE'",
        "catalogue_semi": f"with {CATALOGUE}, {NAMES} select id, name, country from catalogue "
        "where name in (select name from names)",
        "locations": f"""with {CATALOGUE}, {NAMES} select "index", name, id, lon, lat
            from catalogue where country = 'FURNITURE' and name in (select name from names)""",
        "fetch_plan": f"""with {CATALOGUE}, weeks as (select unnest(range(0, 9)) as w)
            select name, id, lon, lat, cast(w as int) as week_no,
              1704067200 + w * 604800 as start_unix, 1704067200 + 9 * 604800::bigint as end_unix
            from catalogue, weeks""",
        "nonempty_locations": f"""select event_id as answer_no, {D.LOCATION} as location_name,
            {HOUR} as dt from events where event_type not in ('click', 'error')""",
        "scaled_features": _scaled(),
        "scaled_from_history": _scaled(),
        "split_counts": f"""{BOTH}, {JOINED} select case when
              substr(md5(location_name || '|' || cast(measured_at as varchar)), 1, 4) < 'cccd'
              then 'train' else 'test' end as part, count(*) as n_rows from joined group by 1""",
        "prediction_pairs": f"{BOTH}, {PAIRS} select * from pairs",
        "regression_metrics": f"{BOTH}, {PAIRS} select {ROUNDED} from "
        f"(select {SCORES} from pairs)",
        "confusion_matrix": _CONFUSION,
        "metrics_overall": f"{BOTH}, {PAIRS} select {ROUNDED} from "
        f"(select {SCORES} from pairs)",
        "confusion_overall": _CONFUSION,
        "metrics_row": f"{BOTH}, {PAIRS} select cast(3 as bigint) as batch_id, {ROUNDED} from "
        f"(select {SCORES} from pairs)",
    }
