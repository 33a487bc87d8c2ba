"""Marts over the staging readings: dimension, facts, latest status, search.

All of these are one ``groupBy`` (hash aggregate with map-side partial
aggregation, so a hot vehicle is combined before the shuffle) or one
top-1-per-key window (partial ``WindowGroupLimit`` before the shuffle).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetspark.operators.staging import latest_per_key


def min_tire_pressure(prefix: str = "tire_") -> Column:
    """Lowest of the four wheels, NULLs skipped (``least``)."""
    return F.least(
        F.col(f"{prefix}front_left_kpa"),
        F.col(f"{prefix}front_right_kpa"),
        F.col(f"{prefix}rear_left_kpa"),
        F.col(f"{prefix}rear_right_kpa"),
    )


def count_if_event(event: str) -> Column:
    return F.sum(F.when(F.array_contains("events", event), 1).otherwise(0))


def bool_any(cond: Column) -> Column:
    return F.max(F.when(cond, 1).otherwise(0)) == 1


def dim_vehicles(stg: DataFrame) -> DataFrame:
    """One row per vehicle (D1): latest vin / type, first / last seen, count, max odometer."""
    latest = F.struct("recorded_at", "message_id")
    return stg.groupBy("vehicle_id").agg(
        F.max_by("vin", latest).alias("vin"),
        F.max_by("vehicle_type", latest).alias("vehicle_type"),
        F.min("recorded_at").alias("first_seen_at"),
        F.max("recorded_at").alias("last_seen_at"),
        F.count(F.lit(1)).alias("reading_count"),
        F.max("odometer_km").alias("odometer_km"),
    )


def daily(stg: DataFrame) -> DataFrame:
    """One row per vehicle and day."""
    return stg.groupBy("vehicle_id", "event_date").agg(
        F.count(F.lit(1)).alias("reading_count"),
        F.min("recorded_at").alias("first_reading_at"),
        F.max("recorded_at").alias("last_reading_at"),
        F.sum("distance_km").alias("distance_km"),
        F.avg("speed_kmh").alias("avg_speed_kmh"),
        F.max("speed_kmh").alias("max_speed_kmh"),
        F.avg(F.when(F.col("speed_kmh") > 1, F.col("speed_kmh"))).alias("avg_moving_speed_kmh"),
        F.avg("engine_temp_c").alias("avg_engine_temp_c"),
        F.max("engine_temp_c").alias("max_engine_temp_c"),
        F.min("fuel_level_pct").alias("min_fuel_level_pct"),
        F.min("battery_voltage").alias("min_battery_voltage"),
        F.min(min_tire_pressure()).alias("min_tire_pressure_kpa"),
        count_if_event("harsh_braking").alias("harsh_braking_count"),
        count_if_event("harsh_acceleration").alias("harsh_acceleration_count"),
        count_if_event("speeding").alias("speeding_readings"),
        count_if_event("engine_overheating").alias("overheating_readings"),
        bool_any(F.col("check_engine_light")).alias("had_check_engine_light"),
    )


def hourly(stg: DataFrame, measure: str = "speed_kmh") -> DataFrame:
    """Average of a measure per vehicle and hour."""
    return stg.groupBy("vehicle_id", F.date_trunc("hour", "recorded_at").alias("hour")).agg(
        F.avg(measure).alias(f"avg_{measure}"), F.count(F.lit(1)).alias("reading_count")
    )


def time_chart(stg: DataFrame, measure: str = "speed_kmh", interval: str = "15 minutes") -> DataFrame:
    """Average and maximum of a measure per vehicle and fixed interval."""
    win = F.window("recorded_at", interval)
    return stg.groupBy("vehicle_id", win.alias("w")).agg(
        F.avg(measure).alias(f"avg_{measure}"), F.max(measure).alias(f"max_{measure}"), F.count(F.lit(1)).alias("reading_count")
    ).select(
        "vehicle_id",
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        f"avg_{measure}",
        f"max_{measure}",
        "reading_count",
    )


def event_id(message_id: Column, event_type: Column) -> Column:
    """``message_id-event_type``."""
    return F.concat(message_id, F.lit("-"), event_type)


def vehicle_events(stg: DataFrame) -> DataFrame:
    """One row per event of a reading (B12, B10): empty or NULL arrays give no rows."""
    exploded = stg.select(
        "message_id",
        "vehicle_id",
        "recorded_at",
        "event_date",
        "latitude",
        "longitude",
        "speed_kmh",
        "engine_temp_c",
        "kafka_partition",
        "kafka_offset",
        F.explode("events").alias("event_type"),
    )
    return exploded.select(event_id(F.col("message_id"), F.col("event_type")).alias("event_id"), "*")


def latest_status(stg: DataFrame) -> DataFrame:
    """The most recent reading of every vehicle."""
    latest = latest_per_key(stg, ["vehicle_id"])
    return latest.select(
        "vehicle_id",
        "vehicle_type",
        "recorded_at",
        "latitude",
        "longitude",
        "speed_kmh",
        "engine_temp_c",
        "fuel_level_pct",
        "battery_voltage",
        min_tire_pressure().alias("min_tire_pressure_kpa"),
        "check_engine_light",
        "dtc_codes",
    )


def search_events(
    stg: DataFrame,
    event: str | None = None,
    min_engine_temp: float | None = None,
    check_engine_light: bool | None = None,
) -> DataFrame:
    """Readings matching any of the given conditions (B8); conditions left as None are ignored."""
    conds = []
    if event is not None:
        conds.append(F.coalesce(F.array_contains("events", event), F.lit(False)))
    if min_engine_temp is not None:
        conds.append(F.coalesce(F.col("engine_temp_c") > min_engine_temp, F.lit(False)))
    if check_engine_light is not None:
        conds.append(F.coalesce(F.col("check_engine_light") == check_engine_light, F.lit(False)))
    if not conds:
        return stg
    cond = conds[0]
    for c in conds[1:]:
        cond = cond | c
    return stg.where(cond)


def count_by(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows per value of the given columns."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("row_count"))


def duplicates(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Value combinations that occur more than once, with their count."""
    return count_by(df, cols).where(F.col("row_count") > 1)
