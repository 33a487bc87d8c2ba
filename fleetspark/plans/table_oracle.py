"""DuckDB SQL for ``plans.table_queries``: each end state stated directly from the readings."""

from __future__ import annotations

from fleetspark.plans.oracle import ORACLE, SCD2_CTES, _LAST, with_readings

TABLE_ORACLE: dict[str, str] = {}

# Versions open where the values differ from those at the cut before.
TABLE_ORACLE["I6_scd2_check"] = with_readings(
    """
select vehicle_id, vehicle_type, check_engine_light, cut as valid_from, lead(cut) over (partition by vehicle_id order by cut) as valid_to,
  md5(vehicle_id || '|' || cast(epoch_us(cut) as varchar)) as scd_id
from changed
""",
    """
cuts as (select unnest([timestamp '2024-01-08', timestamp '2024-01-15', timestamp '2024-01-22', timestamp '2024-02-01']) as cut),
states as (
  select cut, vehicle_id, arg_max(vehicle_type, (recorded_at, message_id)) as vehicle_type,
    arg_max(check_engine_light, (recorded_at, message_id)) as check_engine_light
  from cuts join dedup on recorded_at < cut group by cut, vehicle_id
),
before as (
  select *, lag({'t': vehicle_type, 'l': check_engine_light}) over (partition by vehicle_id order by cut) as was from states
),
changed as (
  select * from before where was is null or was.t is distinct from vehicle_type or was.l is distinct from check_engine_light
)
""",
)

TABLE_ORACLE["I7_point_in_time"] = with_readings(
    f"""
select r.message_id, r.vehicle_id, r.recorded_at, h.scd_id, h.odometer_km as version_km
from (select message_id, case when kafka_offset % 3 = 0 then 'vehicle-001' else vehicle_id end as vehicle_id, recorded_at from dedup) r
left join {_LAST} h on h.vehicle_id = r.vehicle_id and h.valid_from <= r.recorded_at and (h.valid_to is null or r.recorded_at < h.valid_to)
""",
    SCD2_CTES,
)

TABLE_ORACLE["I4_microbatch"] = with_readings(
    "select vehicle_id, event_date, count(*) as reading_count from dedup where recorded_at < timestamp '2024-02-05' and recorded_at >= timestamp '2024-01-01' group by all"
)

TABLE_ORACLE["C3_merge_moved_key"] = with_readings("""
select message_id, kafka_offset,
  case when moved then cast(event_date + interval '1' day as date) else event_date end as event_date, case when moved then 2 else 1 end as version
from (select *, (day(event_date) in (10, 11) and kafka_offset % 2 = 0) or kafka_offset % 10 = 9 as moved from dedup)
""")

TABLE_ORACLE["S6_global_dedup"] = ORACLE["S6_stream_dedup"]

TABLE_ORACLE["D6_watermarks"] = with_readings("select kafka_partition, max(kafka_offset) as max_kafka_offset from dedup group by kafka_partition")

#: The messages that break each rule; m has the fields flat and the enum names as they are.
BROKEN = {
    "Q1_required": "tire_rear_right_kpa is null",
    "Q1_required_items": "coalesce(len(events), 0) = 0",
    "Q2_const": "gear <> 4",
    "Q2_gt_lt": "coalesce(speed_kmh, 0) <= 10 or coalesce(speed_kmh, 0) >= 100",
    "Q2_gte_over_gt": "gear < 2",
    "Q2_null_is_zero": "coalesce(tire_rear_right_kpa, 0) <= 0",
    "Q3_outside": "coalesce(speed_kmh, 0) > 50 and coalesce(speed_kmh, 0) < 150",
    "Q4_finite": "gear in (0, 1)",
    "Q5_in": "gear not in (1, 2, 3)",
    "Q5_not_in": "gear in (1, 2, 3)",
    "Q6_len": "len(vehicle_type) <> 3",
    "Q6_min_len": "len(vehicle_type) < 4",
    "Q6_max_len": "len(vehicle_type) + 1 > 4",
    "Q6_const": "vehicle_type <> 'BUS'",
    "Q7_len_bytes": "strlen(vehicle_type) + 2 <> 5",
    "Q7_min_bytes": "strlen(vehicle_type) + 2 < 6",
    "Q7_max_bytes": "strlen(vehicle_type) + 2 > 5",
    "Q8_pattern": "cast(right(vin, 1) as int) % 2 = 0",
    "Q9_prefix": "left(vehicle_id, 10) <> 'vehicle-00'",
    "Q9_suffix": "right(vehicle_id, 1) <> '7'",
    "Q9_contains": "position('01' in vehicle_id) = 0",
    "Q9_not_contains": "position('01' in vehicle_id) > 0",
    "Q10_in": "vehicle_type in ('TRUCK', 'BUS')",
    "Q10_not_in": "vehicle_type in ('CAR', 'VAN')",
    "Q11_uuid": "gear = 0",
    "Q11_tuuid": "gear = 1",
    "Q11_ulid": "gear = 2",
    "Q11_email": "gear = 3",
    "Q12_defined": "gear = 0",
    "Q13_const": "vehicle_type <> 'CAR'",
    "Q13_in": "vehicle_type not in ('CAR', 'VAN')",
    "Q13_not_in": "vehicle_type in ('CAR', 'VAN')",
    "Q14_bool_const": "gear = 0 or not check_engine_light",
    "Q15_min_items": "coalesce(len(events), 0) < 2",
    "Q15_max_items": "coalesce(len(events), 0) > 1",
    "Q16_unique": "gear = 0",
    "Q17_items": "len(list_filter(dtc_codes, lambda x: x not like 'P%')) > 0",
    "Q18_lt": "recorded_at >= timestamp '2024-01-20'",
    "Q18_lte_gte": "recorded_at > timestamp '2024-01-25' or recorded_at < timestamp '2024-01-05'",
    "Q18_gt": "gear > 0 and recorded_at <= timestamp '2024-01-10'",
    "Q18_const": "recorded_at <> timestamp '2024-01-01'",
    "Q19_lt_now": "recorded_at >= timestamp '2024-01-15'",
    "Q19_gt_now": "recorded_at <= timestamp '2024-01-15'",
    "Q19_within": "recorded_at not between timestamp '2024-01-12' and timestamp '2024-01-18'",
    "Q20_nested": "gear > 0 and latitude < 59.35",
    "Q21_ignore_always": "false",
    "Q21_ignore_if_zero": "rpm > 0 and rpm < 5000",
}
TABLE_ORACLE["Q2_rule_matrix"] = with_readings(
    " union all ".join(f"select '{rule}' as rule, count(*) filter (where {broken}) as failing from m" for rule, broken in BROKEN.items())
)
