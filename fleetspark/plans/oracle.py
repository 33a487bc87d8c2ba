"""Independent DuckDB SQL for every oracle-checked query.

The same derivation of telemetry from ``events`` as ``sources.readings``
(FIXTURES.md section 3), then the staging and mart semantics written as
plain SQL. Ties are broken the same way as in the Spark jobs and NULL order
is always stated, since DuckDB sorts NULLs last by default.
"""

from __future__ import annotations

READINGS_CTE = """
e as (select *, cast(regexp_extract(props, '([0-9]+)', 1) as int) as k from events),
m as (select
  '00000000-0000-4000-8000-' || lpad(cast(event_id as varchar), cast(greatest(12, length(cast(event_id as varchar))) as int), '0') as message_id,
  'vehicle-' || lpad(cast(user_id as varchar), cast(greatest(3, length(cast(user_id as varchar))) as int), '0') as vehicle_id,
  'TESTVIN' || lpad(cast(user_id as varchar), cast(greatest(10, length(cast(user_id as varchar))) as int), '0') as vin,
  case user_id % 4 when 0 then 'CAR' when 1 then 'VAN' when 2 then 'TRUCK' else 'BUS' end as vehicle_type,
  ts as recorded_at,
  59.3293 + cast(k as double) * 0.001 as latitude,
  18.0686 + cast(k as double) * 0.001 as longitude,
  cast(k as double) * 3.6 as heading_deg,
  value as speed_kmh,
  k * 100 as rpm, k % 9 as gear,
  cast(60 + k as double) as engine_temp_c,
  cast(100 - k as double) as fuel_level_pct,
  12 + cast(k as double) / 50 as battery_voltage,
  cast(event_id as double) / 200 as odometer_km,
  230 - cast(k as double) * 0.5 as tire_front_left_kpa,
  cast(230 as double) as tire_front_right_kpa,
  cast(228 as double) as tire_rear_left_kpa,
  cast(case when k % 7 = 0 then null else 225 - k end as double) as tire_rear_right_kpa,
  event_type = 'error' as check_engine_light,
  case when event_type = 'error' then split('P0217,C0750', ',') end as dtc_codes,
  case event_type when 'error' then split('ENGINE_OVERHEATING,LOW_TIRE_PRESSURE', ',')
    when 'click' then split('HARSH_BRAKING', ',') when 'purchase' then split('SPEEDING', ',')
    when 'signup' then split('HARSH_ACCELERATION', ',') end as events,
  cast(user_id % 3 as int) as kafka_partition, event_id as kafka_offset,
  ts + interval '1' minute as ingested_at from e),
raw as (
  select * from m
  union all
  select * exclude (ingested_at), ingested_at + interval '5' minute as ingested_at from m where kafka_offset % 10 = 0
),
flat as (select
  message_id, vehicle_id, vin, lower(vehicle_type) as vehicle_type, recorded_at, cast(recorded_at as date) as event_date,
  latitude, longitude, heading_deg, speed_kmh, rpm, gear, engine_temp_c, fuel_level_pct, battery_voltage, odometer_km,
  tire_front_left_kpa, tire_front_right_kpa, tire_rear_left_kpa, tire_rear_right_kpa, check_engine_light, dtc_codes,
  list_transform(events, lambda x: lower(x)) as events, kafka_partition, kafka_offset, ingested_at
  from raw),
dedup as (
  select unnest(arg_min(flat, (ingested_at is not null, ingested_at, kafka_partition, kafka_offset))) from flat group by message_id
),
prev as (
  select * exclude (place, before), before.odometer_km as previous_odometer_km
  from (select *, row_number() over vehicle as place, lag({'odometer_km': odometer_km}) over vehicle as before from dedup
    window vehicle as (partition by vehicle_id order by recorded_at nulls first, message_id nulls first))
),
stg as (
  select *, coalesce(list_sum(list_filter([odometer_km - previous_odometer_km], lambda step: step >= 0 and step <= 1)), 0) as distance_km
  from prev
)
"""


def with_readings(body: str, ctes: str = "") -> str:
    """The readings CTEs, optional extra CTEs (``name as (...)``, comma separated), then ``body``."""
    extra = ",\n" + ctes.strip() if ctes.strip() else ""
    return "with " + READINGS_CTE.strip() + extra + "\n" + body.strip()


STAGING_SELECT = """
select message_id, vehicle_id, vin, vehicle_type, recorded_at, event_date, latitude, longitude, heading_deg, speed_kmh,
  rpm, gear, engine_temp_c, fuel_level_pct, battery_voltage, odometer_km, tire_front_left_kpa, tire_front_right_kpa,
  tire_rear_left_kpa, tire_rear_right_kpa, check_engine_light,
  array_to_string(dtc_codes, ',') as dtc_codes, array_to_string(events, ',') as events,
  kafka_partition, kafka_offset, ingested_at, previous_odometer_km, distance_km
from stg
"""

# Marts, from their stated meaning.
DAILY_SELECT = """
select vehicle_id, event_date, count(*) as reading_count, min(recorded_at) as first_reading_at, max(recorded_at) as last_reading_at,
  round(sum(distance_km), 6) as distance_km, round(avg(speed_kmh), 6) as avg_speed_kmh, max(speed_kmh) as max_speed_kmh,
  round(avg(speed_kmh) filter (where speed_kmh > 1), 6) as avg_moving_speed_kmh,
  round(avg(engine_temp_c), 6) as avg_engine_temp_c, max(engine_temp_c) as max_engine_temp_c,
  min(fuel_level_pct) as min_fuel_level_pct, min(battery_voltage) as min_battery_voltage, min(tire) as min_tire_pressure_kpa,
  count(*) filter (where 'harsh_braking' in happened) as harsh_braking_count,
  count(*) filter (where 'harsh_acceleration' in happened) as harsh_acceleration_count,
  count(*) filter (where 'speeding' in happened) as speeding_readings,
  count(*) filter (where 'engine_overheating' in happened) as overheating_readings,
  coalesce(bool_or(check_engine_light), false) as had_check_engine_light
from (select *, list_min([tire_front_left_kpa, tire_front_right_kpa, tire_rear_left_kpa, tire_rear_right_kpa]) as tire,
  coalesce(events, []) as happened from stg)
group by all
"""

# The newest reading of a vehicle is the one that no other reading of it follows.
NEWEST = """(
  select s.* from stg s anti join stg n
    on n.vehicle_id = s.vehicle_id and (n.recorded_at, n.message_id) > (s.recorded_at, s.message_id)) newest"""

DIM_SELECT = f"""
select vehicle_id, vin, vehicle_type, first_seen_at, recorded_at as last_seen_at, reading_count, spans.odometer_km
from {NEWEST} join (
  select vehicle_id, min(recorded_at) as first_seen_at, count(*) as reading_count, max(odometer_km) as odometer_km from stg group by vehicle_id) spans
  using (vehicle_id)
"""

LATEST_SELECT = f"""
select vehicle_id, vehicle_type, recorded_at, latitude, longitude, speed_kmh, engine_temp_c, fuel_level_pct, battery_voltage,
  list_min([tire_front_left_kpa, tire_front_right_kpa, tire_rear_left_kpa, tire_rear_right_kpa]) as min_tire_pressure_kpa,
  check_engine_light, array_to_string(dtc_codes, ',') as dtc_codes
from {NEWEST}
"""

EVENTS_CTE = """
fct as (
  select message_id || '-' || event_type as event_id, message_id, vehicle_id, recorded_at, event_date, latitude, longitude,
    speed_kmh, engine_temp_c, kafka_partition, kafka_offset, event_type
  from (select *, unnest(events) as event_type from stg)
)
"""

HOURLY_SELECT = """
select vehicle_id, date_trunc('hour', recorded_at) as hour, round(avg(speed_kmh), 6) as avg_speed_kmh, count(*) as reading_count
from stg group by vehicle_id, date_trunc('hour', recorded_at)
"""

TIME_CHART_SELECT = """
select vehicle_id, time_bucket(interval '15 minutes', recorded_at) as window_start,
  time_bucket(interval '15 minutes', recorded_at) + interval '15 minutes' as window_end,
  round(avg(speed_kmh), 6) as avg_speed_kmh, max(speed_kmh) as max_speed_kmh, count(*) as reading_count
from stg where recorded_at is not null
group by vehicle_id, time_bucket(interval '15 minutes', recorded_at)
"""

COUNT_BY_SELECT = "select vehicle_type, count(*) as row_count from stg group by vehicle_type"

SEARCH_SELECT = """
select message_id, vehicle_id, recorded_at, speed_kmh, engine_temp_c, check_engine_light, array_to_string(events, ',') as events
from stg
where coalesce(list_contains(events, 'speeding'), false) or coalesce(engine_temp_c > 150, false)
   or coalesce(check_engine_light = true, false)
"""

DUPLICATES_SELECT = """
select message_id, count(*) as row_count from flat group by message_id having count(*) > 1
"""

ORACLE: dict[str, str] = {
    "M7_staging": with_readings(STAGING_SELECT),
    "D2_daily": with_readings(DAILY_SELECT),
    "D1_dim_vehicles": with_readings(DIM_SELECT),
    "E2_latest_status": with_readings(LATEST_SELECT),
    "B12_vehicle_events": with_readings("select * from fct", EVENTS_CTE),
    "D9_hourly_speed": with_readings(HOURLY_SELECT),
    "D10_time_chart": with_readings(TIME_CHART_SELECT),
    "D8_count_by_type": with_readings(COUNT_BY_SELECT),
    "B8_search_events": with_readings(SEARCH_SELECT),
    "D7_redelivered_messages": with_readings(DUPLICATES_SELECT),
}

# Rule checks on the raw (not de-duplicated) messages, strict form: zero scalars read as NULL.
VALIDATION_NOW = "2024-01-30 00:00:00"
_UUID = "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
_NOW = f"timestamp '{VALIDATION_NOW}'"
FIELD_CHECKS_SQL = [
    ("message_id", "nullif(message_id, '')", f"regexp_matches(coalesce(nullif(message_id, ''), ''), '{_UUID}')"),
    ("vehicle_id", "nullif(vehicle_id, '')", "regexp_matches(coalesce(nullif(vehicle_id, ''), ''), '^vehicle-[0-9]{3}$')"),
    ("vin", "nullif(vin, '')", "length(coalesce(nullif(vin, ''), '')) = 17"),
    (
        "vehicle_type",
        "nullif(vehicle_type, 'VEHICLE_TYPE_UNSPECIFIED')",
        "not starts_with(coalesce(vehicle_type, 'VEHICLE_TYPE_UNSPECIFIED'), 'UNKNOWN_ENUM_VALUE_')"
        " and coalesce(vehicle_type, 'VEHICLE_TYPE_UNSPECIFIED') not in ('VEHICLE_TYPE_UNSPECIFIED')",
    ),
    ("timestamp", "recorded_at", f"recorded_at is not null and (recorded_at is null or recorded_at < {_NOW})"),
    ("position", "null", "(latitude between -90 and 90) and (longitude between -180 and 180)"),
    ("heading_deg", "nullif(heading_deg, 0)", "heading_deg >= 0 and heading_deg < 360"),
    ("speed_kmh", "nullif(speed_kmh, 0)", "speed_kmh >= 0 and speed_kmh <= 250"),
    ("rpm", "nullif(rpm, 0)", "rpm >= 0 and rpm <= 10000"),
    ("gear", "nullif(gear, 0)", "gear >= 0 and gear <= 8"),
    ("engine_temp_c", "nullif(engine_temp_c, 0)", "engine_temp_c >= -40 and engine_temp_c <= 150"),
    ("fuel_level_pct", "nullif(fuel_level_pct, 0)", "fuel_level_pct >= 0 and fuel_level_pct <= 100"),
    ("battery_voltage", "nullif(battery_voltage, 0)", "battery_voltage >= 0 and battery_voltage <= 30"),
    ("odometer_km", "nullif(odometer_km, 0)", "odometer_km >= 0"),
    (
        "tire_pressure_kpa",
        "null",
        " and ".join(
            f"(coalesce({w}, 0) between 0 and 500)"
            for w in ("tire_front_left_kpa", "tire_front_right_kpa", "tire_rear_left_kpa", "tire_rear_right_kpa")
        ),
    ),
    (
        "dtc_codes",
        "null",
        "dtc_codes is null or coalesce(list_bool_and(list_transform(dtc_codes, lambda x: regexp_matches(x, '^[PCBU][0-9]{4}$'))), true)",
    ),
    (
        "events",
        "null",
        "(events is null or len(list_distinct(events)) = len(events)) and (events is null or coalesce(list_bool_and("
        "list_transform(events, lambda x: not starts_with(x, 'UNKNOWN_ENUM_VALUE_') and x not in ('EVENT_UNSPECIFIED'))), true))",
    ),
]

VIOLATIONS_SELECT = "\nunion all\n".join(
    f"select message_id, kafka_partition, kafka_offset, ingested_at, '{name}' as field, cast({value} as varchar) as invalid_value"
    f" from raw where not coalesce({cond}, false)"
    for name, value, cond in FIELD_CHECKS_SQL
)

# Model checks over staging and marts: one row per check with its failing-row count.
MODEL_CHECKS_CTES = EVENTS_CTE.strip() + """,
dim as (select vehicle_id from stg group by vehicle_id),
daily as (select vehicle_id, event_date from stg group by vehicle_id, event_date)
"""
MODEL_CHECKS_SELECT = """
select 'stg_message_id_unique' as "check", (select count(*) from (select message_id from stg where message_id is not null group by message_id having count(*) > 1)) as failures
union all select 'stg_message_id_not_null', (select count(*) from stg where message_id is null)
union all select 'stg_vehicle_id_not_null', (select count(*) from stg where vehicle_id is null)
union all select 'stg_vehicle_type_accepted', (select count(*) from stg where vehicle_type not in ('car', 'van', 'truck', 'bus'))
union all select 'stg_recorded_at_not_null', (select count(*) from stg where recorded_at is null)
union all select 'stg_latitude_not_null', (select count(*) from stg where latitude is null)
union all select 'stg_longitude_not_null', (select count(*) from stg where longitude is null)
union all select 'stg_speed_not_negative', (select count(*) from stg where speed_kmh < 0)
union all select 'events_event_id_unique', (select count(*) from (select event_id from fct where event_id is not null group by event_id having count(*) > 1))
union all select 'events_event_id_not_null', (select count(*) from fct where event_id is null)
union all select 'events_vehicle_in_dim', (select count(*) from fct where vehicle_id is not null and vehicle_id not in (select vehicle_id from dim where vehicle_id is not null))
union all select 'events_event_type_accepted', (select count(*) from fct where event_type not in
  ('harsh_braking', 'harsh_acceleration', 'speeding', 'engine_overheating', 'low_fuel', 'refueled', 'low_tire_pressure'))
union all select 'daily_unique_vehicle_day', (select count(*) from (select vehicle_id, event_date from daily group by vehicle_id, event_date having count(*) > 1))
union all select 'stg_readings_over_limits', (select count(*) from stg where speed_kmh > 250 or engine_temp_c > 150)
"""

ORACLE["Q24_field_violations"] = with_readings(VIOLATIONS_SELECT)
ORACLE["Q31_model_checks"] = with_readings(MODEL_CHECKS_SELECT, MODEL_CHECKS_CTES)

INCREMENT_CUT = "2024-01-16 00:00:00"
SNAPSHOT_CUTS = ("2024-01-10 00:00:00", "2024-01-20 00:00:00", None)
AS_OF = "2024-01-15 00:00:00"

_FCT_COLS = (
    "message_id || '-' || event_type as event_id, message_id, vehicle_id, recorded_at, event_date, latitude, longitude,"
    " speed_kmh, engine_temp_c, kafka_partition, kafka_offset, event_type"
)
INCREMENTAL_CTES = f"""
dedup1 as (
  select * exclude (rn) from (
    select *, row_number() over (partition by message_id
      order by ingested_at asc nulls first, kafka_partition asc, kafka_offset asc) as rn
    from flat where ingested_at < timestamp '{INCREMENT_CUT}') where rn = 1
),
fct1 as (select {_FCT_COLS} from (select *, unnest(events) as event_type from dedup1)),
wm as (select kafka_partition, max(kafka_offset) as max_kafka_offset from fct1 group by kafka_partition),
new_stg as (
  select s.* from stg s left join wm on s.kafka_partition = wm.kafka_partition
  where wm.max_kafka_offset is null or s.kafka_offset > wm.max_kafka_offset
),
fct2 as (
  select * exclude (rn) from (
    select *, row_number() over (partition by event_id order by kafka_partition desc, kafka_offset desc) as rn
    from (select {_FCT_COLS} from (select *, unnest(events) as event_type from new_stg))) where rn = 1
)
"""
INCREMENTAL_SELECT = """
select * from fct1 where event_id not in (select event_id from fct2)
union all
select * from fct2
"""


def _dim_cte(name: str, cut: str | None) -> str:
    where = f"where recorded_at < timestamp '{cut}'" if cut else ""
    return f"""{name} as (
  select vehicle_id,
    arg_max(vin, struct_pack(r := recorded_at, m := message_id)) as vin,
    arg_max(vehicle_type, struct_pack(r := recorded_at, m := message_id)) as vehicle_type,
    min(recorded_at) as first_seen_at, max(recorded_at) as last_seen_at,
    count(*) as reading_count, max(odometer_km) as odometer_km
  from stg {where} group by vehicle_id)"""


_DIM_COLS = "vehicle_id, vin, vehicle_type, first_seen_at, last_seen_at, reading_count, odometer_km"
_SCD_ID = "md5(vehicle_id || '|' || cast(epoch_us(valid_from) as varchar))"


def _scd_first(name: str, dim: str) -> str:
    return f"""{name} as (
  select *, {_SCD_ID} as scd_id from (
    select {_DIM_COLS}, last_seen_at as valid_from, cast(null as timestamp) as valid_to from {dim}))"""


def _scd_step(name: str, prev: str, dim: str) -> str:
    p_cols = ", ".join(f"p.{c.strip()}" for c in _DIM_COLS.split(","))
    return f"""{name} as (
  select {p_cols}, p.valid_from,
    case when p.valid_to is null and d.vehicle_id is not null and p.valid_from < d.last_seen_at
      then d.last_seen_at else p.valid_to end as valid_to,
    p.scd_id
  from {prev} p left join {dim} d on p.vehicle_id = d.vehicle_id
  union all
  select *, {_SCD_ID} as scd_id from (
    select {", ".join("d." + c.strip() for c in _DIM_COLS.split(","))}, d.last_seen_at as valid_from, cast(null as timestamp) as valid_to
    from {dim} d left join (select * from {prev} where valid_to is null) p on p.vehicle_id = d.vehicle_id
    where p.vehicle_id is null or p.valid_from < d.last_seen_at))"""


SCD2_CTES = ",\n".join(
    [_dim_cte(f"dim{i}", cut) for i, cut in enumerate(SNAPSHOT_CUTS, 1)]
    + [_scd_first("h1", "dim1")]
    + [_scd_step(f"h{i}", f"h{i - 1}", f"dim{i}") for i in range(2, len(SNAPSHOT_CUTS) + 1)]
)
_LAST = f"h{len(SNAPSHOT_CUTS)}"

ORACLE["I1_incremental_events"] = with_readings(INCREMENTAL_SELECT, INCREMENTAL_CTES)
ORACLE["I5_scd2_history"] = with_readings(f"select * from {_LAST}", SCD2_CTES)
ORACLE["I7_scd2_as_of"] = with_readings(
    f"select * from {_LAST} where valid_from <= timestamp '{AS_OF}' and (valid_to is null or timestamp '{AS_OF}' < valid_to)",
    SCD2_CTES,
)
ORACLE["I8_scd2_current"] = with_readings(f"select * from {_LAST} where valid_to is null", SCD2_CTES)

# Through the binary archive: unset repeated fields come back empty, a missing tire reading as 0.
ARCHIVE_SELECT = STAGING_SELECT.replace("tire_rear_right_kpa, check_engine_light", "coalesce(tire_rear_right_kpa, 0) as tire_rear_right_kpa, check_engine_light").replace(
    "array_to_string(dtc_codes, ',') as dtc_codes, array_to_string(events, ',') as events",
    "coalesce(array_to_string(dtc_codes, ','), '') as dtc_codes, coalesce(array_to_string(events, ','), '') as events",
)
ORACLE["A3_archive_roundtrip"] = with_readings(ARCHIVE_SELECT)

CHANGELOG_CTES = """
cl as (
  select case when not coalesce(list_contains(events, 'HARSH_ACCELERATION'), false) then vehicle_id end as key,
    case when not check_engine_light then coalesce(list_contains(events, 'SPEEDING'), false) end as paused,
    case when not check_engine_light then recorded_at end as updated_at,
    not check_engine_light as has_value,
    kafka_offset as "offset"
  from m
),
last as (
  select *, row_number() over (partition by key order by "offset" desc) as rn from cl where key is not null
)
"""
LATEST_STATE_SELECT = """
select key, paused, updated_at, (select max("offset") from cl c where c.key = last.key) as "offset"
from last where rn = 1 and has_value
"""

# Lag over all hours, partitions and groups: at each hour, what all earlier hours of a partition hold.
LAG_CTES = """
seen as (
  select kafka_partition as p, date_trunc('hour', recorded_at) as h, kafka_offset as o, ingested_at as i,
    date_trunc('hour', recorded_at) + interval '1 hour' as until
  from raw
),
news as (
  select p, h, min(o) as low, max(o) as high, max(o) filter (where i < until) as archived,
    max(o) filter (where i + interval '10 minutes' < until) as indexed
  from seen group by p, h
),
starts as (select p, arg_min(low, h) as first_low from news group by p),
state as (
  select hours.h, starts.p, coalesce(min(low), any_value(first_low)) as earliest,
    coalesce(max(high) + 1, any_value(first_low)) as ending, max(archived) + 1 as archived, max(indexed) + 1 as indexed
  from (select distinct h from news) hours cross join starts left join news on news.p = starts.p and news.h <= hours.h
  group by hours.h, starts.p
),
report as (
  select epoch(h)::bigint + 3600 as t, group_id, sum(ending)::bigint as produced, sum(ending - earliest)::bigint as retained,
    sum(coalesce(done, 0))::bigint as consumed, sum(ending - coalesce(done, earliest))::bigint as lag
  from (select h, earliest, ending, archived as done, 'protobuf-writer' as group_id from state
    union all by name select h, earliest, ending, indexed as done, 'elk-writer' as group_id from state)
  group by h, group_id
)
"""
RATES_SELECT = """
select group_id, t,
  round(case when t > first_value(t) over w then (produced - first_value(produced) over w) / (t - first_value(t) over w) else 0.0 end, 6) as produced_rate,
  round(case when t > first_value(t) over w then (consumed - first_value(consumed) over w) / (t - first_value(t) over w) else 0.0 end, 6) as consumed_rate
from report
window w as (partition by group_id order by t range between 7200 preceding and current row)
"""

ORACLE["S10_latest_state"] = with_readings(LATEST_STATE_SELECT, CHANGELOG_CTES)
ORACLE["S11_lag_report"] = with_readings("select * from report", LAG_CTES)
ORACLE["S12_rates"] = with_readings(RATES_SELECT, LAG_CTES)
ORACLE["S13_lag_history"] = with_readings("select * from report where t >= (select max(t) from report) - 600 * 60", LAG_CTES)

ORACLE["S6_stream_dedup"] = with_readings("select message_id, vehicle_id, recorded_at, kafka_partition, kafka_offset from dedup")
ORACLE["S9_stream_distance"] = with_readings("select message_id, vehicle_id, previous_odometer_km, distance_km from stg")

ORACLE["A8_documents"] = with_readings("""
select m.message_id as id, 'vehicle-telemetry-' || strftime(m.recorded_at, '%Y.%m.%d') as index,
  m.kafka_partition, m.kafka_offset, 'vehicle-telemetry' as topic, m.kafka_offset as json_offset,
  m.recorded_at as json_timestamp, m.vehicle_type, coalesce(m.speed_kmh, 0) as speed_kmh, coalesce(m.gear, 0) as gear,
  m.event_type_is_error as check_engine_light, coalesce(m.tire_rear_right_kpa, 0) as rear_right,
  coalesce(array_to_string(m.dtc_codes, ','), '') as dtc_codes, coalesce(array_to_string(m.events, ','), '') as events
from (select *, coalesce(check_engine_light, false) as event_type_is_error from m) m
""")
ORACLE["A6_archive_append"] = with_readings("select message_id, count(*) as deliveries from raw group by message_id")
ORACLE["I2_merge_null_partition"] = with_readings("""
select message_id, kafka_offset, case when kafka_offset % 5 <> 0 then event_date end as event_date,
  cast(if(kafka_offset % 3 = 0, 1, 2) as int) as version
from dedup
""")
ORACLE["A10_full_rebuild"] = with_readings("select message_id, event_date from dedup where day(event_date) % 2 = 1")
ORACLE["E3_previous_reading"] = with_readings("select message_id, previous_odometer_km, distance_km from stg")
# The steps that depend on a failed one are skipped; raw messages fail if any field rule does, odd types fail staging.
ORACLE["Q33_gate"] = with_readings("""
select i.input, s.step,
  case i.input when 'clean' then true when 'raw' then breaks = 0 else s.step = 'sources' or buses = 0 end as published,
  case i.input when 'clean' then false when 'raw' then breaks > 0 and s.step <> 'sources'
    else buses > 0 and s.step not in ('sources', 'staging') end as skipped
from (values ('raw'), ('clean'), ('odd_types')) i(input)
cross join (values ('sources'), ('staging'), ('dim_vehicles'), ('fct_vehicle_daily'), ('vehicle_latest_status'),
  ('fct_vehicle_events'), ('dim_vehicles_snapshot')) s(step)
cross join (select count(*) filter (where not coalesce(speed_kmh, 0) between 0 and 250 or engine_temp_c > 150
    or not regexp_matches(vehicle_id, '^vehicle-[0-9]{3}$') or fuel_level_pct < 0) as breaks,
  count(*) filter (where vehicle_type = 'BUS') as buses from m) n
""")

# Versions count up by what is published; a table keeps its last two.
ORACLE["Q33_publish_versions"] = with_readings(
    """
select attempt, version, case when version is not null then rows end as rows,
  coalesce(version = last, false) as visible, coalesce(version >= last - 1, false) as readable
from (
  select *, max(version) over () as last from (
    select 'first' as attempt, 1 as version, (select count(*) from fine where ingested_at < timestamp '2024-01-16') as rows
    union all select 'unchecked', case when bad = 0 then 2 end, (select count(*) from dedup) from broken
    union all select 'full', case when bad = 0 then 3 else 2 end, (select count(*) from fine) from broken
    union all select 'late', null, null
    union all select 'odd_days', case when bad = 0 then 4 else 3 end,
      (select count(*) from odd) + (select count(*) from fine where event_date not in (select event_date from odd)) from broken
  )
)
""",
    """
fine as (select * from dedup where speed_kmh <= 250),
broken as (select count(*) as bad from dedup where not coalesce(speed_kmh <= 250, false)),
odd as (select * from fine where day(event_date) % 2 = 1 and speed_kmh <= 100)
""",
)

ORACLE["E3_carry_scan"] = with_readings("""
select message_id, vehicle_id, recorded_at, odometer_km,
  lag(odometer_km) over (partition by vehicle_id order by recorded_at nulls first, message_id) as previous_odometer_km
from (
  select message_id, case when kafka_offset % 3 = 0 then 'vehicle-hot' else vehicle_id end as vehicle_id,
    case when kafka_offset % 12 < 3 then timestamp '2024-01-01' else recorded_at end as recorded_at, odometer_km
  from dedup
)
""")

# A stream's end state is that of the batch over all it was fed.
ORACLE["S8_stream_daily"] = ORACLE["D2_daily"]
ORACLE["S8_stream_chart"] = ORACLE["D10_time_chart"]
ORACLE["S10_stream_state"] = ORACLE["S10_latest_state"]
ORACLE["S12_stream_rates"] = ORACLE["S12_rates"]
