"""Staging: flatten decoded messages, keep one copy per message, add distance.

The staging table is the one every mart reads. Its three steps:

* ``flatten_readings``: nested fields to columns, ``timestamp`` renamed,
  enum text lower-cased (B1-B4, B7).
* ``dedup_first``: the first delivered copy of each message (E1). A
  ``row_number() = 1`` filter; Catalyst plans it as a partial
  ``WindowGroupLimit`` before the shuffle and a final one after, so a message
  redelivered many times is cut to one row per map partition before it moves.
* ``with_distance``: previous odometer per vehicle and the distance rule
  (E3, B5), exactly ``lag`` over the vehicle's full history ordered by
  (recorded_at, message_id). A window over a vehicle would put a hot vehicle
  into one task; ``carry_previous`` instead sorts all rows over range
  partitions and hands the last row of each to the next, so neither a hot
  vehicle nor a stuck clock makes a large task. ``with_previous`` is the form
  in SQL windows, split by (vehicle, time bucket).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetspark.model import STAGING_COLUMNS
from fleetspark.session import work_path

#: Edges of range partitions (one or two rows each) that are broadcast; more are joined.
MOST_EDGES = 200_000


def _cols(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in names]


def flatten_readings(decoded: DataFrame) -> DataFrame:
    """Decoded messages (+ Kafka columns) -> flat readings with staging column names."""
    return decoded.select(
        "message_id",
        "vehicle_id",
        "vin",
        F.lower("vehicle_type").alias("vehicle_type"),
        F.col("timestamp").alias("recorded_at"),
        F.to_date("timestamp").alias("event_date"),
        F.col("position.lat").alias("latitude"),
        F.col("position.lon").alias("longitude"),
        "heading_deg",
        "speed_kmh",
        "rpm",
        "gear",
        "engine_temp_c",
        "fuel_level_pct",
        "battery_voltage",
        "odometer_km",
        F.col("tire_pressure_kpa.front_left").alias("tire_front_left_kpa"),
        F.col("tire_pressure_kpa.front_right").alias("tire_front_right_kpa"),
        F.col("tire_pressure_kpa.rear_left").alias("tire_rear_left_kpa"),
        F.col("tire_pressure_kpa.rear_right").alias("tire_rear_right_kpa"),
        "check_engine_light",
        "dtc_codes",
        F.transform("events", lambda e: F.lower(e)).alias("events"),
        "kafka_partition",
        "kafka_offset",
        "ingested_at",
    )


def _top1(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def dedup_first(df: DataFrame, keys: Sequence[str] = ("message_id",), order: Sequence[str | Column] | None = None) -> DataFrame:
    """First copy per key: earliest ingested_at (NULL first, as Spark sorts), then partition, offset."""
    if order is None:
        order = [F.col("ingested_at").asc_nulls_first(), F.col("kafka_partition").asc(), F.col("kafka_offset").asc()]
    return _top1(df, keys, _cols(order))


def latest_per_key(df: DataFrame, keys: Sequence[str] = ("vehicle_id",), order: Sequence[str | Column] | None = None) -> DataFrame:
    """Latest row per key: greatest recorded_at (NULL last), then greatest message_id."""
    if order is None:
        order = [F.col("recorded_at").desc_nulls_last(), F.col("message_id").desc()]
    return _top1(df, keys, _cols(order))


def with_previous(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    value: str,
    out: str,
    bucket: str = "hour",
) -> DataFrame:
    """``lag(value) over (partition by key order by *order)``, split by time bucket.

    ``order[0]`` must be a timestamp; ``bucket`` is a ``date_trunc`` unit. Rows
    are windowed per (key, bucket); the first row of a bucket gets the last
    ``value`` of the key's previous non-empty bucket.
    """
    ts = order[0]
    ordering = [F.col(c).asc_nulls_first() for c in order]
    b = df.withColumn("_bucket", F.date_trunc(bucket, F.col(ts)))
    w = Window.partitionBy(key, "_bucket").orderBy(*ordering)
    inner = b.withColumn("_prev", F.lag(value).over(w)).withColumn("_pos", F.row_number().over(w))

    last = b.groupBy(key, "_bucket").agg(F.max_by(F.col(value), F.struct(*[F.col(c) for c in order])).alias("_last"))
    carry = last.select(
        key,
        "_bucket",
        F.lag("_last").over(Window.partitionBy(key).orderBy(F.col("_bucket").asc_nulls_first())).alias("_carry"),
    )
    carry = carry.withColumnsRenamed({key: "_key", "_bucket": "_at"})
    joined = inner.join(carry, inner[key].eqNullSafe(carry["_key"]) & inner["_bucket"].eqNullSafe(carry["_at"]), "left")
    prev = F.when(F.col("_pos") == 1, F.col("_carry")).otherwise(F.col("_prev"))
    return joined.withColumn(out, prev).drop("_bucket", "_prev", "_pos", "_carry", "_key", "_at")


def distance_rule(current: Column, previous: Column, lower: float = 0, upper: float = 1) -> Column:
    """Step between consecutive odometer readings when it lies in [lower, upper], else 0."""
    delta = current - previous
    return F.when(delta.between(lower, upper), delta).otherwise(F.lit(0).cast("double"))


def _same_as_before(key: pa.Array, before: pa.Array) -> pa.Array:
    """Whether keys equal the ones before them, null being a key too."""
    both_null = pc.and_(pc.is_null(key), pc.is_null(before))
    return pc.or_(pc.fill_null(pc.equal(key, before), False), both_null)


def _previous_in_partition(key: str, value: str, out: str):
    """Adds the value of the row before (if it has the same key) to sorted rows, the partition's number and its edges: 1 first row, 2 last, 3 both."""

    def previous(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held, last = None, None
        for batch in rows:
            n = len(batch)
            if not n:
                continue
            keys, values = batch.column(key), batch.column(value)
            head = last or (pa.nulls(1, keys.type), pa.nulls(1, values.type))
            before = [pa.concat_arrays([h, c.slice(0, n - 1)]) for h, c in zip(head, (keys, values), strict=True)]
            same = _same_as_before(keys, before[0])
            edge = [0] * n
            if last is None:
                edge[0] = 1
                same = pa.concat_arrays([pa.array([False]), same.slice(1)])
            prev = pc.if_else(same, before[1], pa.scalar(None, values.type))
            if held is not None:
                yield held
            held = pa.RecordBatch.from_arrays([*batch.columns, prev, pa.array([part] * n, pa.int32()), pa.array(edge, pa.int32())], [*batch.schema.names, out, "_part", "_edge"])
            last = (keys.slice(n - 1), values.slice(n - 1))
        if held is not None:
            edge = held.column("_edge").to_pylist()
            edge[-1] += 2
            yield held.set_column(len(held.schema.names) - 1, "_edge", pa.array(edge, pa.int32()))

    return previous


def carry_previous(df: DataFrame, key: str, order: Sequence[str], value: str, out: str, partitions: int | None = None) -> DataFrame:
    """``lag(value) over (partition by key order by *order)`` by a carry between sorted partitions.

    The rows are sorted over range partitions of (key, order), so a key with very
    many rows, or very many rows of one time, span as many partitions as they
    fill. Each partition takes the value before from within itself in one pass
    and is written; only its first row may miss one, and finds it in the last row
    of the partition before: two rows per partition are looked at for that.
    ``order`` should make the order total, as in any ``lag``.
    """
    spark = df.sparkSession
    ordering = [F.col(c).asc_nulls_first() for c in (key, *order)]
    ranged = df.repartitionByRange(partitions, *ordering) if partitions else df.repartitionByRange(*ordering)
    kind = T.StructField(out, df.schema[value].dataType)
    schema = T.StructType([*df.schema.fields, kind, T.StructField("_part", T.IntegerType()), T.StructField("_edge", T.IntegerType())])
    path = work_path(spark, "carried")
    ranged.sortWithinPartitions(*ordering).mapInArrow(_previous_in_partition(key, value, out), schema).write.parquet(path)
    table = spark.read.schema(schema).parquet(path)

    edges = table.where("_edge > 0").select(F.col("_part").alias("_at"), "_edge", F.struct(F.col(key).alias("k"), F.col(value).alias("v")).alias("row"))
    ends = edges.groupBy("_at").agg(
        F.max_by("row", F.when(F.col("_edge") != 2, 1)).alias("first"), F.max_by("row", F.when(F.col("_edge") >= 2, 1)).alias("last")
    )
    # One row per partition of the sort: a window without keys over so few rows is no bottleneck.
    before = F.lag("last").over(Window.orderBy("_at"))
    patch = ends.withColumn("before", before).where("before is not null and before.k <=> first.k").select("_at", F.col("before.v").alias("_carry"))
    side = F.broadcast(patch) if ends.count() <= MOST_EDGES else patch
    joined = table.join(side, (F.col("_part") == F.col("_at")) & F.col("_edge").isin(1, 3), "left")
    return joined.withColumn(out, F.coalesce(out, "_carry")).drop("_at", "_carry", "_part", "_edge")


def with_distance(df: DataFrame, key: str = "vehicle_id", lower: float = 0, upper: float = 1) -> DataFrame:
    """Previous odometer and distance of every reading of a key."""
    prev = carry_previous(df, key, ["recorded_at", "message_id"], "odometer_km", "previous_odometer_km")
    return prev.withColumn("distance_km", distance_rule(F.col("odometer_km"), F.col("previous_odometer_km"), lower, upper))


def first_readings(decoded: DataFrame) -> DataFrame:
    """Decoded messages -> one reading per message, without distance; a plain plan, so a caller's columns and filters reach the scan."""
    return dedup_first(flatten_readings(decoded))


def stage_readings(decoded: DataFrame) -> DataFrame:
    """Decoded messages -> staging readings (M7): flatten, first copy per message, distance.

    The distance needs all readings in order, so they are sorted and written
    once, by a job of this call; whoever needs no distance takes ``first_readings``.
    """
    return with_distance(first_readings(decoded)).select(*STAGING_COLUMNS)
