"""Telemetry messages derived from the driver's ``events`` table.

The driver's tables hold no telemetry, so every registered query starts from
messages derived row by row from ``events``; the mapping is the one in
FIXTURES.md section 3 and is repeated in ``oracle.READINGS_SQL``. The result
has the shape of a decoded archive (``decode_messages``): the message fields,
nested ``position`` / ``tire_pressure_kpa`` structs, enum names in upper case,
plus the Kafka coordinates. Every tenth offset is delivered twice (the second
copy five minutes later), which is the at-least-once input the staging
de-duplication must absorb.

One scan of ``events`` produces both copies (``explode`` of a copy list), so
the redelivery costs no second read and no union.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Redelivery of the fixture: offsets divisible by this are delivered twice,
# the copy arriving this many minutes after the first delivery.
REDELIVERY_EVERY = 10
REDELIVERY_DELAY_MINUTES = 5


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _lpad_id(c: str, width: int) -> Column:
    """An id padded to ``width``; longer ids keep all their digits."""
    text = F.col(c).cast("string")
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0"))


def telemetry_messages(events: DataFrame, redeliver: bool = True) -> DataFrame:
    """Decoded-archive-shaped messages, one per delivery, from ``events``."""
    k = F.regexp_extract("props", r"([0-9]+)", 1).try_cast("int")
    kd = F.col("k").cast("double")
    event_type = F.col("event_type")
    base = events.select("event_id", "ts", "user_id", "event_type", "value", k.alias("k"))

    if redeliver:
        copies = F.when(F.col("event_id") % REDELIVERY_EVERY == 0, F.array(F.lit(0), F.lit(REDELIVERY_DELAY_MINUTES))).otherwise(
            F.array(F.lit(0))
        )
        base = base.withColumn("_delay", F.explode(copies))
    else:
        base = base.withColumn("_delay", F.lit(0))

    vehicle_type = (
        F.when(F.col("user_id") % 4 == 0, "CAR")
        .when(F.col("user_id") % 4 == 1, "VAN")
        .when(F.col("user_id") % 4 == 2, "TRUCK")
        .otherwise("BUS")
    )
    events_arr = (
        F.when(event_type == "error", F.array(F.lit("ENGINE_OVERHEATING"), F.lit("LOW_TIRE_PRESSURE")))
        .when(event_type == "click", F.array(F.lit("HARSH_BRAKING")))
        .when(event_type == "purchase", F.array(F.lit("SPEEDING")))
        .when(event_type == "signup", F.array(F.lit("HARSH_ACCELERATION")))
    )
    dtc = F.when(event_type == "error", F.array(F.lit("P0217"), F.lit("C0750")))
    rear_right = F.when(F.col("k") % 7 == 0, F.lit(None)).otherwise(225 - F.col("k")).cast("double")
    ingested = F.col("ts") + F.expr("interval 1 minute") + F.make_dt_interval(mins=F.col("_delay"))

    return base.select(
        F.concat(F.lit("00000000-0000-4000-8000-"), _lpad_id("event_id", 12)).alias("message_id"),
        F.concat(F.lit("vehicle-"), _lpad_id("user_id", 3)).alias("vehicle_id"),
        F.concat(F.lit("TESTVIN"), _lpad_id("user_id", 10)).alias("vin"),
        vehicle_type.alias("vehicle_type"),
        F.col("ts").alias("timestamp"),
        F.struct((F.lit(59.3293) + kd * 0.001).alias("lat"), (F.lit(18.0686) + kd * 0.001).alias("lon")).alias("position"),
        (kd * 3.6).alias("heading_deg"),
        F.col("value").alias("speed_kmh"),
        (F.col("k") * 100).alias("rpm"),
        (F.col("k") % 9).alias("gear"),
        (60 + F.col("k")).cast("double").alias("engine_temp_c"),
        (100 - F.col("k")).cast("double").alias("fuel_level_pct"),
        (F.lit(12) + kd / 50).alias("battery_voltage"),
        (F.col("event_id").cast("double") / 200).alias("odometer_km"),
        F.struct(
            (F.lit(230) - kd * 0.5).alias("front_left"),
            F.lit(230.0).alias("front_right"),
            F.lit(228.0).alias("rear_left"),
            rear_right.alias("rear_right"),
        ).alias("tire_pressure_kpa"),
        (event_type == "error").alias("check_engine_light"),
        dtc.alias("dtc_codes"),
        events_arr.alias("events"),
        (F.col("user_id") % 3).cast("int").alias("kafka_partition"),
        F.col("event_id").alias("kafka_offset"),
        F.col("ts").alias("kafka_timestamp"),
        ingested.alias("ingested_at"),
    )


def load_messages(spark: SparkSession, sf_dir: str, redeliver: bool = True) -> DataFrame:
    return telemetry_messages(read_table(spark, sf_dir, "events"), redeliver=redeliver)
