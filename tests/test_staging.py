"""Staging semantics on hand-written rows (FIXTURES.md section 4)."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from fleetspark.model import TELEMETRY_SCHEMA
from fleetspark.operators import marts
from fleetspark.operators.staging import dedup_first, stage_readings, with_previous
from pyspark.sql import types as T

T0 = dt.datetime(2024, 3, 1, 10, 0, 0)

KAFKA = [
    T.StructField("kafka_partition", T.IntegerType()),
    T.StructField("kafka_offset", T.LongType()),
    T.StructField("kafka_timestamp", T.TimestampType()),
    T.StructField("ingested_at", T.TimestampType()),
]
DECODED = T.StructType(list(TELEMETRY_SCHEMA.fields) + KAFKA)


def message(mid, vehicle="vehicle-001", minutes=0, odometer=0.0, events=None, speed=10.0, partition=0, offset=0, ingested_delay=1, vtype="CAR"):
    ts = T0 + dt.timedelta(minutes=minutes)
    return {
        "message_id": mid,
        "vehicle_id": vehicle,
        "vin": "TESTVIN0000000001",
        "vehicle_type": vtype,
        "timestamp": ts,
        "position": {"lat": 59.0, "lon": 18.0},
        "heading_deg": 0.0,
        "speed_kmh": speed,
        "rpm": 0,
        "gear": 0,
        "engine_temp_c": 80.0,
        "fuel_level_pct": 50.0,
        "battery_voltage": 12.5,
        "odometer_km": odometer,
        "tire_pressure_kpa": {"front_left": 230.0, "front_right": 231.0, "rear_left": None, "rear_right": 229.0},
        "check_engine_light": False,
        "dtc_codes": [],
        "events": events if events is not None else [],
        "kafka_partition": partition,
        "kafka_offset": offset,
        "kafka_timestamp": ts,
        "ingested_at": ts + dt.timedelta(minutes=ingested_delay),
    }


def frame(spark, rows):
    return spark.createDataFrame([tuple(r[f.name] for f in DECODED.fields) for r in rows], DECODED)


def by_id(df):
    return {r["message_id"]: r for r in df.collect()}


def test_distance_rule_edges(spark):
    rows = [
        message("a", minutes=0, odometer=100.0),
        message("b", minutes=1, odometer=100.0),  # step 0: kept
        message("c", minutes=2, odometer=101.0),  # step exactly 1: kept
        message("d", minutes=3, odometer=101.5),  # 0.5
        message("e", minutes=4, odometer=99.0),  # drop: 0
        message("f", minutes=5, odometer=150.0),  # jump > 1: 0
    ]
    stg = by_id(stage_readings(frame(spark, rows)))
    assert stg["a"]["previous_odometer_km"] is None and stg["a"]["distance_km"] == 0.0
    assert stg["b"]["distance_km"] == 0.0
    assert stg["c"]["distance_km"] == 1.0
    assert stg["d"]["distance_km"] == 0.5
    assert stg["e"]["distance_km"] == 0.0
    assert stg["f"]["distance_km"] == 0.0
    assert stg["f"]["previous_odometer_km"] == 99.0


def test_distance_crosses_bucket_boundaries(spark):
    # readings hours apart: the first reading of each hour continues from the previous hour's last one
    rows = [message(f"m{i}", minutes=i * 45, odometer=10.0 + 0.25 * i) for i in range(12)]
    stg = by_id(stage_readings(frame(spark, rows)))
    for i in range(1, 12):
        assert stg[f"m{i}"]["previous_odometer_km"] == 10.0 + 0.25 * (i - 1)
        assert stg[f"m{i}"]["distance_km"] == 0.25


def test_bucketed_lag_equals_plain_lag(spark):
    rng = random.Random(7)
    rows = []
    for i in range(400):
        rows.append(message(f"id{i:04d}", vehicle=f"vehicle-{rng.randint(0, 4):03d}", minutes=rng.randint(0, 3000), odometer=rng.random() * 1000))
    df = frame(spark, rows).withColumnRenamed("timestamp", "recorded_at")
    ours = with_previous(df, "vehicle_id", ["recorded_at", "message_id"], "odometer_km", "prev", bucket="hour")
    w = Window.partitionBy("vehicle_id").orderBy("recorded_at", "message_id")
    plain = df.withColumn("prev", F.lag("odometer_km").over(w))
    a = {r["message_id"]: r["prev"] for r in ours.collect()}
    b = {r["message_id"]: r["prev"] for r in plain.collect()}
    assert a == b


def test_first_ingested_copy_wins(spark):
    rows = [
        message("x", offset=5, ingested_delay=10, speed=1.0),
        message("x", offset=5, ingested_delay=2, speed=2.0),
        message("x", partition=1, offset=9, ingested_delay=2, speed=3.0),
    ]
    out = dedup_first(frame(spark, rows)).collect()
    assert len(out) == 1
    assert out[0]["speed_kmh"] == 2.0  # earliest ingested_at, then lowest partition


def test_events_explode_and_counts(spark):
    rows = [
        message("none", minutes=0, events=[]),
        message("two", minutes=1, events=["SPEEDING", "HARSH_BRAKING"]),
        message("rep", minutes=2, events=["SPEEDING", "SPEEDING"]),
    ]
    stg = stage_readings(frame(spark, rows))
    ev = marts.vehicle_events(stg).collect()
    assert sorted(r["event_id"] for r in ev) == ["rep-speeding", "rep-speeding", "two-harsh_braking", "two-speeding"]
    daily = marts.daily(stg).collect()[0]
    assert daily["speeding_readings"] == 2 and daily["harsh_braking_count"] == 1
    assert daily["min_tire_pressure_kpa"] == 229.0  # NULL wheel skipped
    assert daily["had_check_engine_light"] is False


def test_latest_status_ties_break_on_message_id(spark):
    rows = [message("a", minutes=5, speed=1.0), message("b", minutes=5, speed=2.0), message("c", minutes=1, speed=3.0)]
    latest = marts.latest_status(stage_readings(frame(spark, rows))).collect()
    assert len(latest) == 1 and latest[0]["speed_kmh"] == 2.0
