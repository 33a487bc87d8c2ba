"""Registered queries over versioned tables, histories, loads in parts and rules; same contract as ``plans.queries``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspark.functions.rules import FieldSpec, all_true, conditions, not_true
from fleetspark.model import VEHICLE_TYPES
from fleetspark.operators.staging import dedup_first, first_readings, flatten_readings
from fleetspark.session import materialize, work_path
from fleetspark.sources.readings import load_messages
from fleetspark.sources.versioned import VersionedTable

CUTS = ("2024-01-08 00:00:00", "2024-01-15 00:00:00", "2024-01-22 00:00:00", "2024-02-01 00:00:00")


def _readings(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return first_readings(load_messages(spark, sf_dir)).select(*columns)


def q_scd2_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History of each vehicle's engine light and type by comparison of their values, stored month by month."""
    from fleetspark.operators.snapshot import History

    rows = materialize(_readings(spark, sf_dir, "vehicle_id", "vehicle_type", "recorded_at", "message_id", "check_engine_light"))
    history = History(spark, work_path(spark, "history-check"), "vehicle_id")
    for cut in CUTS:
        seen = rows.where(F.col("recorded_at") < F.lit(cut).cast("timestamp_ntz"))
        latest = F.struct("recorded_at", "message_id")
        state = seen.groupBy("vehicle_id").agg(F.max_by("vehicle_type", latest).alias("vehicle_type"), F.max_by("check_engine_light", latest).alias("check_engine_light"))
        history.run(state, check_cols=["vehicle_type", "check_engine_light"], now=cut)
    zone = lambda c: F.col(c).cast("timestamp_ntz").alias(c)
    return history.read().select("vehicle_id", "vehicle_type", "check_engine_light", zone("valid_from"), zone("valid_to"), "scd_id")


def q_point_in_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each reading with the version of its vehicle valid then; one vehicle sends a third of all readings."""
    from fleetspark.operators.intervals import versions_at
    from fleetspark.plans.queries import scd2_history

    hot = F.when(F.col("kafka_offset") % 3 == 0, F.lit("vehicle-001")).otherwise(F.col("vehicle_id"))
    rows = _readings(spark, sf_dir, "message_id", "vehicle_id", "recorded_at", "kafka_offset").select("message_id", hot.alias("vehicle_id"), "recorded_at")
    history = scd2_history(spark, sf_dir).withColumnRenamed("odometer_km", "version_km")
    found = versions_at(rows, history, "vehicle_id", "recorded_at", ["scd_id", "version_km"], hot=1000)
    return found.select("message_id", "vehicle_id", "recorded_at", "scd_id", "version_km")


class _Unavailable(Exception):
    pass


def q_microbatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily counts loaded in batches of five days: one batch fails at first, rows come late, the end is that of a full load (I4)."""
    from fleetspark.operators.microbatch import Microbatches

    rows = materialize(_readings(spark, sf_dir, "vehicle_id", "recorded_at", "event_date", "kafka_offset"))
    begin, until = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 5)
    half = dt.datetime(2024, 1, 16)
    load = Microbatches(spark, work_path(spark, "microbatch"), "recorded_at", begin, dt.timedelta(days=5), lookback=1)
    count = lambda part: part.groupBy("vehicle_id", "event_date").agg(F.count("*").alias("reading_count"))
    fresh = [True]

    def unsteady(part: DataFrame) -> DataFrame:
        if fresh and len(load._notes()) == 1:
            fresh.clear()
            raise _Unavailable("source is away")
        return count(part)

    # A seventh of the last five days before the cut comes late.
    late = (F.col("recorded_at") >= F.lit(half - dt.timedelta(days=5))) & (F.col("kafka_offset") % 7 == 0)
    load.run(rows.where(~late), unsteady, half)
    load.run(rows, count, until)
    return load.read()


def q_merge_moved_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An upsert whose rows move to the next day's partition: no old copy stays."""
    from fleetspark.operators.keyindex import IndexedTable

    rows = _readings(spark, sf_dir, "message_id", "kafka_offset", "event_date")
    table = IndexedTable(spark, work_path(spark, "indexed"), ["message_id"], ["event_date"], buckets=8)
    table.merge(rows.where(F.col("kafka_offset") % 10 < 9).withColumn("version", F.lit(1)))
    some = F.dayofmonth("event_date").isin(10, 11) & (F.col("kafka_offset") % 2 == 0) | (F.col("kafka_offset") % 10 == 9)
    table.merge(rows.where(some).withColumn("event_date", F.date_add("event_date", 1)).withColumn("version", F.lit(2)))
    return table.read().select("message_id", "kafka_offset", "event_date", "version")


def q_global_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First arrival of each message from a stream in which copies come three weeks later."""
    from fleetspark.plans.queries import _chunk, _feed_in_chunks
    from fleetspark.streaming.seen import FirstArrivals

    out, ckpt = FirstArrivals(spark, work_path(spark, "arrivals"), buckets=8), work_path(spark, "arrivals-ckpt")
    rows = flatten_readings(load_messages(spark, sf_dir))
    rows = rows.select("message_id", "vehicle_id", "recorded_at", "kafka_partition", "kafka_offset", "ingested_at")
    again = F.col("ingested_at") > F.col("recorded_at") + F.expr("interval 2 minutes")
    rows = rows.withColumn("ingested_at", F.when(again, F.col("ingested_at") + F.expr("interval 21 days")).otherwise(F.col("ingested_at")))
    _feed_in_chunks(spark, rows, _chunk(rows, "ingested_at"), "arrivals", lambda stream: out.start(stream, ckpt).awaitTermination())
    return out.read().select("message_id", "vehicle_id", F.col("recorded_at"), "kafka_partition", "kafka_offset")


def q_watermarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greatest loaded offset per Kafka partition from file footers, after two loads."""
    from fleetspark.operators.incremental import footer_watermarks

    rows = _readings(spark, sf_dir, "message_id", "kafka_partition", "kafka_offset", "event_date")
    table = VersionedTable(spark, work_path(spark, "offsets"))
    for part in (0, 1):
        table.append(rows.where(F.col("kafka_offset") % 2 == part), ["kafka_partition"])
    return footer_watermarks(table)


#: Rules that telemetry breaks: name, column of the message, spec. The SQL states each as a plain predicate.
NOW = "2024-01-15 00:00:00"


def _rule_matrix() -> dict[str, tuple]:
    c, lit, when = F.col, F.lit, F.when
    number = lambda **rules: FieldSpec("double", rules=rules)
    text = lambda **rules: FieldSpec("string", rules=rules)
    enum = lambda **rules: FieldSpec("enum", rules=rules, enum_values=tuple(VEHICLE_TYPES))
    time = lambda **rules: FieldSpec("timestamp", rules=rules)
    at = c("timestamp").cast("timestamp")
    gear, kind, vehicle = c("gear"), c("vehicle_type"), c("vehicle_id")
    accented = F.concat(lit("é"), kind)
    odd_speed = when(gear == 0, lit(float("inf"))).when(gear == 1, lit(float("nan"))).otherwise(c("speed_kmh"))
    utc = lambda d: dt.datetime(2024, 1, d, tzinfo=dt.timezone.utc)
    return {
        "Q1_required": (c("tire_pressure_kpa.rear_right"), FieldSpec("double", required=True)),
        "Q1_required_items": (c("events"), FieldSpec("string", repeated=True, required=True)),
        "Q2_const": (gear, number(const=4)),
        "Q2_gt_lt": (c("speed_kmh"), number(gt=10, lt=100)),
        "Q2_gte_over_gt": (gear, number(gte=2, gt=7)),
        "Q2_null_is_zero": (c("tire_pressure_kpa.rear_right"), number(gt=0)),
        "Q3_outside": (c("speed_kmh"), number(gte=150, lte=50)),
        "Q4_finite": (odd_speed, number(finite=True)),
        "Q5_in": (gear, number(**{"in": [1, 2, 3]})),
        "Q5_not_in": (gear, number(not_in=[1, 2, 3])),
        "Q6_len": (kind, text(len=3)),
        "Q6_min_len": (kind, text(min_len=4)),
        "Q6_max_len": (accented, text(max_len=4)),
        "Q6_const": (kind, text(const="BUS")),
        "Q7_len_bytes": (accented, text(len_bytes=5)),
        "Q7_min_bytes": (accented, text(min_bytes=6)),
        "Q7_max_bytes": (accented, text(max_bytes=5)),
        "Q8_pattern": (c("vin"), text(pattern="[13579]$")),
        "Q9_prefix": (vehicle, text(prefix="vehicle-00")),
        "Q9_suffix": (vehicle, text(suffix="7")),
        "Q9_contains": (vehicle, text(contains="01")),
        "Q9_not_contains": (vehicle, text(not_contains="01")),
        "Q10_in": (kind, text(**{"in": ["CAR", "VAN"]})),
        "Q10_not_in": (kind, text(not_in=["CAR", "VAN"])),
        "Q11_uuid": (when(gear == 0, vehicle).otherwise(c("message_id")), text(well_known=("uuid",))),
        "Q11_tuuid": (when(gear == 1, vehicle).otherwise(F.md5("message_id")), text(well_known=("tuuid",))),
        "Q11_ulid": (when(gear == 2, vehicle).otherwise(lit("01ARZ3NDEKTSV4RRFFQ69G5FAV")), text(well_known=("ulid",))),
        "Q11_email": (when(gear == 3, vehicle).otherwise(F.concat(vehicle, lit("@fleet.example"))), text(well_known=("email",))),
        "Q12_defined": (when(gear == 0, lit("UNKNOWN_ENUM_VALUE_VehicleType_9")).otherwise(kind), enum()),
        "Q13_const": (kind, enum(const=1)),
        "Q13_in": (kind, enum(**{"in": [1, 2]})),
        "Q13_not_in": (kind, enum(not_in=[1, 2])),
        "Q14_bool_const": (when(gear > 0, c("check_engine_light")), FieldSpec("bool", rules={"const": True})),
        "Q15_min_items": (c("events"), FieldSpec("string", repeated=True, repeated_rules={"min_items": 2})),
        "Q15_max_items": (c("events"), FieldSpec("string", repeated=True, repeated_rules={"max_items": 1})),
        "Q16_unique": (F.array(kind, when(gear == 0, kind).otherwise(lit("X"))), FieldSpec("string", repeated=True, repeated_rules={"unique": True})),
        "Q17_items": (c("dtc_codes"), FieldSpec("string", repeated=True, items={"pattern": "^P"})),
        "Q18_lt": (at, time(lt=utc(20))),
        "Q18_lte_gte": (at, time(lte=utc(25), gte=utc(5))),
        "Q18_gt": (when(gear > 0, at), time(gt=utc(10))),
        "Q18_const": (at, time(const=utc(1))),
        "Q19_lt_now": (at, time(lt_now=True)),
        "Q19_gt_now": (at, time(gt_now=True)),
        "Q19_within": (at, time(within=dt.timedelta(days=3))),
        "Q20_nested": (when(gear > 0, c("position")), FieldSpec("message", fields={"lat": number(gte=59.35)})),
        "Q21_ignore_always": (gear, FieldSpec("double", ignore="always", rules={"const": 99})),
        "Q21_ignore_if_zero": (when(c("rpm") > 0, c("rpm")), FieldSpec("int32", ignore="if_zero", rules={"gte": 5000})),
    }


def q_rule_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that break each kind of rule, counted in one pass (Q1-Q21)."""
    messages = load_messages(spark, sf_dir, redeliver=False)
    now = F.lit(NOW).cast("timestamp")
    counts = [F.count_if(not_true(all_true(conditions(spec, value, name, now).items))).alias(name) for name, (value, spec) in _rule_matrix().items()]
    found = messages.agg(*counts)
    pairs = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("failing")) for n in found.columns])
    return found.select(F.explode(pairs).alias("p")).select("p.rule", "p.failing")


TABLE_QUERIES = {
    "I6_scd2_check": q_scd2_check,
    "I7_point_in_time": q_point_in_time,
    "I4_microbatch": q_microbatch,
    "C3_merge_moved_key": q_merge_moved_key,
    "S6_global_dedup": q_global_dedup,
    "D6_watermarks": q_watermarks,
    "Q2_rule_matrix": q_rule_matrix,
}
