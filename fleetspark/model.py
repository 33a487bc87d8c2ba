"""The telemetry data model: message fields, enums, staging columns.

Everything below the "fixed values" marker must equal the message schema the
archive was written with (names, numbers, order); it is not derived.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (message schema and accepted values; must not change).
# ---------------------------------------------------------------------------

TELEMETRY_MESSAGE = "vehicle.v1.VehicleTelemetry"
RECORD_MESSAGE = "kafka.v1.KafkaRecord"
RECORD_BATCH_MESSAGE = "kafka.v1.KafkaRecordBatch"

VEHICLE_TYPES = ["VEHICLE_TYPE_UNSPECIFIED", "CAR", "VAN", "TRUCK", "BUS"]  # numbers 0..4
EVENTS = [
    "EVENT_UNSPECIFIED",
    "HARSH_BRAKING",
    "HARSH_ACCELERATION",
    "SPEEDING",
    "ENGINE_OVERHEATING",
    "LOW_FUEL",
    "REFUELED",
    "LOW_TIRE_PRESSURE",
]  # numbers 0..7

ACCEPTED_VEHICLE_TYPES = ["car", "van", "truck", "bus"]
ACCEPTED_EVENT_TYPES = [
    "harsh_braking",
    "harsh_acceleration",
    "speeding",
    "engine_overheating",
    "low_fuel",
    "refueled",
    "low_tire_pressure",
]

UNKNOWN_ENUM_PREFIX = "UNKNOWN_ENUM_VALUE_"

# ---------------------------------------------------------------------------

POSITION = T.StructType([T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType())])
TIRE_PRESSURE = T.StructType(
    [
        T.StructField("front_left", T.DoubleType()),
        T.StructField("front_right", T.DoubleType()),
        T.StructField("rear_left", T.DoubleType()),
        T.StructField("rear_right", T.DoubleType()),
    ]
)

# Decoded telemetry message (field order = field numbers 1..18).
TELEMETRY_SCHEMA = T.StructType(
    [
        T.StructField("message_id", T.StringType()),
        T.StructField("vehicle_id", T.StringType()),
        T.StructField("vin", T.StringType()),
        T.StructField("vehicle_type", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("position", POSITION),
        T.StructField("heading_deg", T.DoubleType()),
        T.StructField("speed_kmh", T.DoubleType()),
        T.StructField("rpm", T.IntegerType()),
        T.StructField("gear", T.IntegerType()),
        T.StructField("engine_temp_c", T.DoubleType()),
        T.StructField("fuel_level_pct", T.DoubleType()),
        T.StructField("battery_voltage", T.DoubleType()),
        T.StructField("odometer_km", T.DoubleType()),
        T.StructField("tire_pressure_kpa", TIRE_PRESSURE),
        T.StructField("check_engine_light", T.BooleanType()),
        T.StructField("dtc_codes", T.ArrayType(T.StringType())),
        T.StructField("events", T.ArrayType(T.StringType())),
    ]
)

# Columns of the flat staging table, in order.
STAGING_COLUMNS = [
    "message_id",
    "vehicle_id",
    "vin",
    "vehicle_type",
    "recorded_at",
    "event_date",
    "latitude",
    "longitude",
    "heading_deg",
    "speed_kmh",
    "rpm",
    "gear",
    "engine_temp_c",
    "fuel_level_pct",
    "battery_voltage",
    "odometer_km",
    "tire_front_left_kpa",
    "tire_front_right_kpa",
    "tire_rear_left_kpa",
    "tire_rear_right_kpa",
    "check_engine_light",
    "dtc_codes",
    "events",
    "kafka_partition",
    "kafka_offset",
    "ingested_at",
    "previous_odometer_km",
    "distance_km",
]

# Kafka coordinates carried next to each decoded message.
