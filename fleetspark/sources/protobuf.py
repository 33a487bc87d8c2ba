"""Protobuf schemas built in code, and the per-task codec used inside Arrow batches.

There is no ``protoc`` and no spark-protobuf jar here, so the message schemas
are declared with ``descriptor_pb2`` and messages are decoded / encoded by the
Python protobuf runtime inside ``mapInArrow`` tasks: Spark partitions and
shuffles the work; each task builds the message classes once and then walks
its Arrow batches.

Decode semantics (the same as Spark's ``from_protobuf`` in PERMISSIVE mode):

* bytes that do not parse give a NULL message;
* enum values are their names; an unknown number becomes
  ``UNKNOWN_ENUM_VALUE_<Enum>_<number>``;
* with defaults (``emit_defaults=True``) unset scalars read as their zero
  value and unset repeated fields as empty arrays; without defaults they are
  NULL; unset message fields are NULL in both modes;
* ``google.protobuf.Timestamp`` becomes a timestamp, truncated to
  microseconds;
* fields unknown to the descriptor are ignored, fields missing from old
  bytes take their default (schema evolution, A7).
"""

from __future__ import annotations

import datetime as dt
from functools import lru_cache

from pyspark.sql import types as T

from fleetspark.model import EVENTS, VEHICLE_TYPES

UTC = dt.timezone.utc
EPOCH = dt.datetime(1970, 1, 1, tzinfo=UTC)


def file_descriptor_set_bytes() -> bytes:
    """The descriptor set (telemetry + Kafka record + Timestamp) as written next to an archive."""
    from google.protobuf import descriptor_pb2, timestamp_pb2

    fds = descriptor_pb2.FileDescriptorSet()
    ts = descriptor_pb2.FileDescriptorProto()
    timestamp_pb2.DESCRIPTOR.CopyToProto(ts)
    fds.file.append(ts)
    fds.file.append(_telemetry_file())
    fds.file.append(_kafka_file())
    return fds.SerializeToString()


def _field(msg, name, number, ftype, label=None, type_name=None):
    from google.protobuf import descriptor_pb2 as d

    f = msg.field.add()
    f.name = name
    f.number = number
    f.type = ftype
    f.label = label or d.FieldDescriptorProto.LABEL_OPTIONAL
    if type_name:
        f.type_name = type_name
    return f


def _telemetry_file():
    from google.protobuf import descriptor_pb2 as d

    FD = d.FieldDescriptorProto
    f = d.FileDescriptorProto(name="vehicle/v1/vehicle_telemetry.proto", package="vehicle.v1", syntax="proto3")
    f.dependency.append("google/protobuf/timestamp.proto")
    for enum_name, values in (("VehicleType", VEHICLE_TYPES), ("Event", EVENTS)):
        e = f.enum_type.add(name=enum_name)
        for number, value in enumerate(values):
            e.value.add(name=value, number=number)
    pos = f.message_type.add(name="Position")
    _field(pos, "lat", 1, FD.TYPE_DOUBLE)
    _field(pos, "lon", 2, FD.TYPE_DOUBLE)
    tire = f.message_type.add(name="TirePressure")
    for i, wheel in enumerate(("front_left", "front_right", "rear_left", "rear_right"), 1):
        _field(tire, wheel, i, FD.TYPE_DOUBLE)
    m = f.message_type.add(name="VehicleTelemetry")
    _field(m, "message_id", 1, FD.TYPE_STRING)
    _field(m, "vehicle_id", 2, FD.TYPE_STRING)
    _field(m, "vin", 3, FD.TYPE_STRING)
    _field(m, "vehicle_type", 4, FD.TYPE_ENUM, type_name=".vehicle.v1.VehicleType")
    _field(m, "timestamp", 5, FD.TYPE_MESSAGE, type_name=".google.protobuf.Timestamp")
    _field(m, "position", 6, FD.TYPE_MESSAGE, type_name=".vehicle.v1.Position")
    _field(m, "heading_deg", 7, FD.TYPE_DOUBLE)
    _field(m, "speed_kmh", 8, FD.TYPE_DOUBLE)
    _field(m, "rpm", 9, FD.TYPE_INT32)
    _field(m, "gear", 10, FD.TYPE_INT32)
    _field(m, "engine_temp_c", 11, FD.TYPE_DOUBLE)
    _field(m, "fuel_level_pct", 12, FD.TYPE_DOUBLE)
    _field(m, "battery_voltage", 13, FD.TYPE_DOUBLE)
    _field(m, "odometer_km", 14, FD.TYPE_DOUBLE)
    _field(m, "tire_pressure_kpa", 15, FD.TYPE_MESSAGE, type_name=".vehicle.v1.TirePressure")
    _field(m, "check_engine_light", 16, FD.TYPE_BOOL)
    _field(m, "dtc_codes", 17, FD.TYPE_STRING, label=FD.LABEL_REPEATED)
    _field(m, "events", 18, FD.TYPE_ENUM, label=FD.LABEL_REPEATED, type_name=".vehicle.v1.Event")
    return f


def _kafka_file():
    from google.protobuf import descriptor_pb2 as d

    FD = d.FieldDescriptorProto
    f = d.FileDescriptorProto(name="kafka/v1/kafka_record.proto", package="kafka.v1", syntax="proto3")
    f.dependency.append("google/protobuf/timestamp.proto")
    batch = f.message_type.add(name="KafkaRecordBatch")
    _field(batch, "records", 1, FD.TYPE_MESSAGE, label=FD.LABEL_REPEATED, type_name=".kafka.v1.KafkaRecord")
    r = f.message_type.add(name="KafkaRecord")
    _field(r, "topic", 1, FD.TYPE_STRING)
    _field(r, "partition", 2, FD.TYPE_INT32)
    _field(r, "offset", 3, FD.TYPE_INT64)
    _field(r, "timestamp", 4, FD.TYPE_MESSAGE, type_name=".google.protobuf.Timestamp")
    _field(r, "key", 5, FD.TYPE_STRING)
    _field(r, "message_type", 6, FD.TYPE_STRING)
    _field(r, "value", 7, FD.TYPE_BYTES)
    _field(r, "ingested_at", 8, FD.TYPE_MESSAGE, type_name=".google.protobuf.Timestamp")
    return f


@lru_cache(maxsize=8)
def _pool(descriptor_set: bytes | None = None):
    from google.protobuf import descriptor_pb2, descriptor_pool

    fds = descriptor_pb2.FileDescriptorSet.FromString(descriptor_set or file_descriptor_set_bytes())
    pool = descriptor_pool.DescriptorPool()
    for fp in fds.file:
        pool.Add(fp)
    return pool


def message_descriptor(full_name: str, descriptor_set: bytes | None = None):
    return _pool(descriptor_set).FindMessageTypeByName(full_name)


@lru_cache(maxsize=32)
def message_class(full_name: str, descriptor_set: bytes | None = None):
    from google.protobuf import message_factory

    return message_factory.GetMessageClass(message_descriptor(full_name, descriptor_set))


# ---------------------------------------------------------------------------
# Descriptor -> Spark schema (A5)
# ---------------------------------------------------------------------------

_SCALARS = None


def _scalar_types():
    global _SCALARS
    if _SCALARS is None:
        from google.protobuf.descriptor import FieldDescriptor as FD

        _SCALARS = {
            FD.TYPE_DOUBLE: T.DoubleType(),
            FD.TYPE_FLOAT: T.FloatType(),
            FD.TYPE_INT32: T.IntegerType(),
            FD.TYPE_SINT32: T.IntegerType(),
            FD.TYPE_SFIXED32: T.IntegerType(),
            FD.TYPE_UINT32: T.LongType(),
            FD.TYPE_FIXED32: T.LongType(),
            FD.TYPE_INT64: T.LongType(),
            FD.TYPE_SINT64: T.LongType(),
            FD.TYPE_SFIXED64: T.LongType(),
            FD.TYPE_UINT64: T.DecimalType(20, 0),
            FD.TYPE_FIXED64: T.DecimalType(20, 0),
            FD.TYPE_BOOL: T.BooleanType(),
            FD.TYPE_STRING: T.StringType(),
            FD.TYPE_BYTES: T.BinaryType(),
            FD.TYPE_ENUM: T.StringType(),
        }
    return _SCALARS


def _is_map(field) -> bool:
    return field.message_type is not None and field.message_type.GetOptions().map_entry


def _is_repeated(field) -> bool:
    flag = getattr(field, "is_repeated", None)
    return bool(flag) if flag is not None else field.label == field.LABEL_REPEATED


def _field_type(field) -> T.DataType:
    from google.protobuf.descriptor import FieldDescriptor as FD

    if field.type == FD.TYPE_MESSAGE:
        name = field.message_type.full_name
        if _is_map(field):
            k, v = field.message_type.fields_by_name["key"], field.message_type.fields_by_name["value"]
            return T.MapType(_field_type(k), _field_type(v))
        if name == "google.protobuf.Timestamp":
            base = T.TimestampType()
        elif name == "google.protobuf.Duration":
            base = T.DayTimeIntervalType()
        elif name == "google.protobuf.Struct":
            base = T.StringType()
        else:
            base = spark_schema(field.message_type)
    else:
        base = _scalar_types()[field.type]
    return T.ArrayType(base) if _is_repeated(field) else base


def spark_schema(descriptor) -> T.StructType:
    """The Spark type of a message, generic over descriptors (A5)."""
    return T.StructType([T.StructField(f.name, _field_type(f), True) for f in descriptor.fields])


# ---------------------------------------------------------------------------
# Message -> Python value matching ``spark_schema`` (runs inside tasks)
# ---------------------------------------------------------------------------


def _timestamp_value(ts) -> dt.datetime | None:
    """The time, or None if it lies outside the years 1 to 9999 (PERMISSIVE: NULL, never an error)."""
    try:
        return EPOCH + dt.timedelta(seconds=ts.seconds, microseconds=ts.nanos // 1000)
    except OverflowError:
        return None


def _enum_name(field, number: int) -> str:
    value = field.enum_type.values_by_number.get(number)
    return value.name if value is not None else f"UNKNOWN_ENUM_VALUE_{field.enum_type.name}_{number}"


def _single(field, value, emit_defaults: bool = True):
    from google.protobuf.descriptor import FieldDescriptor as FD

    if field.type == FD.TYPE_ENUM:
        return _enum_name(field, value)
    if field.type == FD.TYPE_MESSAGE:
        name = field.message_type.full_name
        if name == "google.protobuf.Timestamp":
            return _timestamp_value(value)
        if name == "google.protobuf.Duration":
            return dt.timedelta(seconds=value.seconds, microseconds=value.nanos // 1000)
        if name == "google.protobuf.Struct":
            from google.protobuf import json_format

            return json_format.MessageToJson(value)
        return to_row(value, emit_defaults)
    return value


_PLANS: dict = {}


def _plan(descriptor, emit_defaults: bool):
    """Per descriptor and mode, built once per process: (name, kind, converter) for every field.

    Descriptors, not names: one worker may decode a message by two versions of its schema.
    """
    plan = _PLANS.get((descriptor, emit_defaults))
    if plan is None:
        plan = []
        for field in descriptor.fields:
            if _is_map(field):
                value_field = field.message_type.fields_by_name["value"]
                plan.append((field.name, "map", lambda v, f=value_field: _single(f, v, emit_defaults)))
            elif _is_repeated(field):
                plan.append((field.name, "repeated", _converter(field, emit_defaults)))
            elif field.message_type is not None:
                plan.append((field.name, "message", _converter(field, emit_defaults)))
            else:
                plan.append((field.name, "scalar", _converter(field, emit_defaults)))
        _PLANS[descriptor, emit_defaults] = plan
    return plan


def _converter(field, emit_defaults: bool):
    """A function from one protobuf value of ``field`` to its Spark-ready value (None = as is)."""
    if field.enum_type is not None:
        return lambda v, f=field: _enum_name(f, v)
    if field.message_type is not None:
        return lambda v, f=field: _single(f, v, emit_defaults)
    return None


def to_row(msg, emit_defaults: bool = True) -> dict:
    """A parsed message as a dict of Spark-ready values."""
    out = {}
    present = None if emit_defaults else {f.name for f, _ in msg.ListFields()}
    for name, kind, conv in _plan(msg.DESCRIPTOR, emit_defaults):
        if kind == "scalar":
            if present is not None and name not in present:
                out[name] = None
            else:
                v = getattr(msg, name)
                out[name] = v if conv is None else conv(v)
        elif kind == "message":
            out[name] = conv(getattr(msg, name)) if msg.HasField(name) else None
        elif kind == "repeated":
            values = getattr(msg, name)
            if len(values) or emit_defaults:
                out[name] = list(values) if conv is None else [conv(v) for v in values]
            else:
                out[name] = None
        else:
            m = getattr(msg, name)
            out[name] = {k: conv(m[k]) for k in m} if (len(m) or emit_defaults) else None
    return out


def parse(cls, data: bytes | None):
    """Parsed message, or None when the bytes are not a valid message (PERMISSIVE)."""
    if data is None:
        return None
    from google.protobuf.message import DecodeError

    msg = cls()
    try:
        msg.ParseFromString(data)
    except (DecodeError, ValueError, RuntimeError):
        return None
    return msg


# ---------------------------------------------------------------------------
# Python value -> message (encoding, used by the archive writer and fixtures)
# ---------------------------------------------------------------------------


def _set_timestamp(ts, value: dt.datetime) -> None:
    if value.tzinfo is None:
        value = value.replace(tzinfo=UTC)
    micros = (value - EPOCH) // dt.timedelta(microseconds=1)
    ts.seconds, rem = divmod(micros, 1_000_000)
    ts.nanos = rem * 1000


def _enum_number(field, value):
    if isinstance(value, int):
        return value
    v = field.enum_type.values_by_name.get(value)
    if v is not None:
        return v.number
    prefix = f"UNKNOWN_ENUM_VALUE_{field.enum_type.name}_"
    if isinstance(value, str) and value.startswith(prefix):
        return int(value[len(prefix) :])
    raise ValueError(f"{value!r} is not a value of {field.enum_type.full_name}")


def fill(msg, row: dict) -> None:
    """Sets message fields from a dict; None leaves a field unset."""
    for field in msg.DESCRIPTOR.fields:
        value = row.get(field.name)
        if value is None:
            continue
        name = field.name
        if _is_repeated(field):
            target = getattr(msg, name)
            for v in value:
                if field.message_type is not None:
                    fill(target.add(), v)
                elif field.enum_type is not None:
                    target.append(_enum_number(field, v))
                else:
                    target.append(v)
        elif field.message_type is not None:
            if field.message_type.full_name == "google.protobuf.Timestamp":
                _set_timestamp(getattr(msg, name), value)
            else:
                fill(getattr(msg, name), value)
        elif field.enum_type is not None:
            setattr(msg, name, _enum_number(field, value))
        else:
            setattr(msg, name, value)
