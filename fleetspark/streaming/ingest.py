"""Structured Streaming forms of ingestion, de-duplication, upsert and state.

* ``stream_archive`` (S7): the archive as a file stream; the source's
  checkpoint remembers which files were read, so each run reads only new
  files (``availableNow`` for scheduled runs).
* ``stream_messages``: archive stream -> decoded messages (same Arrow codec
  as batch).
* ``archive_stream`` (A6, S1, S2, S5): Kafka-shaped stream -> archive files,
  one ``foreachBatch`` write per micro-batch; files are named after the batch
  id, so a replayed batch rewrites the same files (at-least-once input,
  idempotent output). Progress is committed by the checkpoint only after the
  batch's files are written.
* ``stream_dedup`` (S6): first arrival per message_id within the watermark.
* ``upsert_stream`` (S3, S4): ``foreachBatch`` keyed merge; redelivery and
  replay from the earliest offset leave the target unchanged.
* ``stream_daily`` (S8): daily aggregates, update mode, upserted per batch
  so the table always holds the current value of each open day.
* ``stream_distance`` (S9): previous odometer per vehicle kept in state.
* ``latest_state`` / ``stream_latest_state`` (S10): compacted changelog.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from fleetspark.operators.incremental import merge_upsert
from fleetspark.sources.archive import decode_messages, explode_records, write_archive

BINARY_FILE_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
        T.StructField("date", T.DateType()),
    ]
)


def stream_archive(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """New archive files as a stream: ``file_path``, ``content``, ``date``."""
    reader = spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA).option("pathGlobFilter", "*.pb")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path).select(F.col("path").alias("file_path"), "content", "date")


def stream_messages(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    return decode_messages(explode_records(stream_archive(spark, path, max_files_per_trigger)))


def spark_property(df: DataFrame, name: str) -> str:
    """A property that Spark sets for the running job."""
    return df.sparkSession.sparkContext.getLocalProperty(name) or "batch"


def archive_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    max_records: int = 5000,
    interval: str | None = "60 seconds",
    available_now: bool = False,
) -> StreamingQuery:
    """Kafka-shaped stream -> archive files, one write per micro-batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        # The query's id belongs to its checkpoint: a repeated batch replaces its own files and no other query's.
        query = spark_property(batch, "sql.streaming.queryId")
        write_archive(batch, path, max_records=max_records, prefix=f"part-{query}-{batch_id:010d}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif interval:
        writer = writer.trigger(processingTime=interval)
    return writer.start()


def stream_dedup(messages: DataFrame, key: str = "message_id", time_col: str = "ingested_at", delay: str = "1 hour") -> DataFrame:
    """First arrival per key, with state kept for ``delay`` past the watermark."""
    timed = messages.withColumn(time_col, F.col(time_col).cast("timestamp"))
    return timed.withWatermark(time_col, delay).dropDuplicatesWithinWatermark([key])


def upsert_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    key: Sequence[str],
    partition_by: Sequence[str],
    available_now: bool = True,
    interval: str | None = None,
) -> StreamingQuery:
    """Keyed upsert of every micro-batch into the parquet table at ``path``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        merge_upsert(batch.sparkSession, batch, path, key, partition_by)

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval or "60 seconds")
    return writer.start()


def daily_aggregates(stream: DataFrame, delay: str = "1 day") -> DataFrame:
    """Per vehicle and UTC day, the additive daily measures (S8); ``recorded_at`` is the event time."""
    timed = stream.withColumn("recorded_at", F.col("recorded_at").cast("timestamp")).withWatermark("recorded_at", delay)
    agg = timed.groupBy("vehicle_id", F.window("recorded_at", "1 day").alias("day")).agg(
        F.count(F.lit(1)).alias("reading_count"),
        F.min("recorded_at").alias("first_reading_at"),
        F.max("recorded_at").alias("last_reading_at"),
        F.sum("distance_km").alias("distance_km"),
        F.avg("speed_kmh").alias("avg_speed_kmh"),
        F.max("speed_kmh").alias("max_speed_kmh"),
        F.max("engine_temp_c").alias("max_engine_temp_c"),
        F.min("fuel_level_pct").alias("min_fuel_level_pct"),
    )
    return agg.select("vehicle_id", F.to_date(F.col("day.start")).alias("event_date"), *[c for c in agg.columns if c not in ("vehicle_id", "day")])


def stream_daily(stream: DataFrame, path: str, checkpoint: str, delay: str = "1 day", available_now: bool = True) -> StreamingQuery:
    """Daily fact kept current by a stream: update mode, upserted on (vehicle_id, event_date)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        merge_upsert(batch.sparkSession, batch.withColumn("kafka_offset", F.lit(batch_id)), path, ["vehicle_id", "event_date"], ["event_date"])

    writer = daily_aggregates(stream, delay).writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="60 seconds")
    return writer.start()


DISTANCE_STATE = T.StructType([T.StructField(n, T.BinaryType()) for n in ("vehicle_ids", "recorded_us", "odometers_km")])


def stream_distance(stream: DataFrame, lower: float = 0, upper: float = 1, buckets: int = 512) -> DataFrame:
    """Previous odometer and distance per vehicle across micro-batches.

    Within a batch a vehicle's rows are ordered by (recorded_at, message_id); the
    first row continues from the newest reading kept in state. A row older than
    that reading is compared with it (a negative step, so distance 0) and does not
    move the state back. The state is one reading per vehicle. Vehicles are dealt
    over ``buckets`` groups, as a call per vehicle costs more than its rows do; a
    group handed to pandas is its vehicles' rows of one micro-batch, bounded by
    the trigger. A checkpoint keeps the number of groups it began with.
    """
    cols = stream.columns
    src = stream.withColumn("recorded_at", F.col("recorded_at").cast("timestamp"))
    out_fields = list(src.schema.fields) + [
        T.StructField("previous_odometer_km", T.DoubleType()),
        T.StructField("distance_km", T.DoubleType()),
    ]
    out_schema = T.StructType(out_fields)
    names = [f.name for f in out_fields]

    def step(key, pdfs, state):
        pdf = pd.concat(list(pdfs), ignore_index=True)
        seen, seen_us, seen_odo = [], np.zeros(0, "int64"), np.zeros(0)
        if state.exists:
            ids, us, odometers = state.get
            seen, seen_us, seen_odo = json.loads(bytes(ids)), np.frombuffer(us, "int64"), np.frombuffer(odometers, "float64")
        # Vehicles in state come first, so a vehicle's code is its place there.
        vehicles = np.empty(len(seen) + len(pdf), object)
        vehicles[:] = seen + pdf["vehicle_id"].astype(object).tolist()
        codes, known = pd.factorize(vehicles, use_na_sentinel=False)
        pdf["_vehicle"] = codes[len(seen) :]
        pdf = pdf.sort_values(["_vehicle", "recorded_at", "message_id"], kind="mergesort", na_position="first").reset_index(drop=True)
        at = pdf["_vehicle"].to_numpy()
        us = pdf["recorded_at"].astype("datetime64[us]").astype("int64").to_numpy()
        odo = pdf["odometer_km"].astype("float64").to_numpy()
        # Without a reading in state every time counts as later and nothing comes before.
        new = len(known) - len(seen)
        last_us = np.concatenate([seen_us, np.full(new, np.iinfo("int64").min)])
        last_odo = np.concatenate([seen_odo, np.full(new, np.nan)])
        on_time = us >= last_us[at]
        follows = np.concatenate([[False], (at[1:] == at[:-1]) & on_time[:-1]]) & on_time
        prev = np.where(follows, np.concatenate([[np.nan], odo[:-1]]), last_odo[at])
        delta = odo - prev
        pdf["previous_odometer_km"] = prev
        pdf["distance_km"] = np.where((delta >= lower) & (delta <= upper), delta, 0.0)
        end = np.flatnonzero(np.concatenate([at[1:] != at[:-1], [True]]) & on_time)
        last_us[at[end]], last_odo[at[end]] = us[end], odo[end]
        state.update((json.dumps(known.tolist()).encode(), last_us.tobytes(), last_odo.tobytes()))
        yield pdf[names]

    grouped = src.withColumn("_bucket", F.pmod(F.xxhash64("vehicle_id"), F.lit(buckets)).cast("int")).groupBy("_bucket")
    result = grouped.applyInPandasWithState(step, out_schema, DISTANCE_STATE, "append", GroupStateTimeout.NoTimeout)
    return result.select(*cols, "previous_odometer_km", "distance_km")


def latest_state(changelog: DataFrame, key: str = "key", value: str = "value", offset: str = "offset") -> DataFrame:
    """Compacted changelog (S10): latest value per key by offset; a NULL latest value deletes the key; NULL keys ignored."""
    latest = changelog.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.max_by(F.struct(F.col(value).alias("v")), F.col(offset)).alias("_latest"), F.max(offset).alias(offset)
    )
    return latest.where(F.col("_latest.v").isNotNull()).select(key, F.col("_latest.v").alias(value), offset)


def stream_latest_state(changelog: DataFrame, path: str, checkpoint: str, key: str = "key", value: str = "value", offset: str = "offset") -> StreamingQuery:
    """Keeps ``latest_state`` of a changelog stream in a table: per batch, upsert live keys, drop deleted ones."""
    from fleetspark.operators.incremental import read_if_exists
    from fleetspark.session import work_path

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        keyed = batch.where(F.col(key).isNotNull())
        last = keyed.groupBy(key).agg(F.max_by(F.struct(F.col(value).alias("v")), F.col(offset)).alias("_l"), F.max(offset).alias(offset))
        last = last.select(key, F.col("_l.v").alias(value), offset)
        current = read_if_exists(spark, path)
        if current is not None:
            merged = current.join(last.select(key), on=key, how="left_anti").unionByName(last)
        else:
            merged = last
        staged = work_path(spark, "latest_state")
        merged.where(F.col(value).isNotNull()).write.mode("overwrite").parquet(staged)
        spark.read.parquet(staged).write.mode("overwrite").parquet(path)

    return changelog.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


# ---------------------------------------------------------------------------
# Documents
# ---------------------------------------------------------------------------


def rfc3339(ts_col) -> F.Column:
    """Timestamp as RFC 3339 text in UTC with 0, 3 or 6 fraction digits, as protobuf's JSON printer writes it."""
    ts = F.col(ts_col).cast("timestamp") if isinstance(ts_col, str) else ts_col.cast("timestamp")
    micros = F.unix_micros(ts) % 1_000_000
    frac = (
        F.when(micros == 0, F.lit(""))
        .when(micros % 1000 == 0, F.concat(F.lit("."), F.lpad((micros / 1000).cast("long").cast("string"), 3, "0")))
        .otherwise(F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0")))
    )
    return F.when(ts.isNotNull(), F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), frac, F.lit("Z")))


def with_defaults(value: F.Column, kind: T.DataType, zero: str = "") -> F.Column:
    """A field as proto3 prints it: unset scalars as zeros, unset arrays empty, unset messages left out."""
    if isinstance(kind, T.StructType):
        inner = F.struct(*[with_defaults(value.getField(f.name), f.dataType).alias(f.name) for f in kind.fields])
        return F.when(value.isNotNull(), inner)
    if isinstance(kind, T.ArrayType):
        return F.coalesce(value, F.array().cast(kind))
    if isinstance(kind, T.TimestampType):
        return value
    default = zero if isinstance(kind, T.StringType) else False if isinstance(kind, T.BooleanType) else 0
    return F.coalesce(value, F.lit(default).cast(kind))


def to_documents(decoded: DataFrame, topic: str = "vehicle-telemetry", index_prefix: str = "vehicle-telemetry-") -> DataFrame:
    """Search documents (A8): id, index (daily by event time), and the JSON body.

    The body holds every message field under its proto name, zeros and empty
    arrays included, enum names, the timestamp in RFC 3339, unset nested
    messages left out, plus ``kafka{topic, partition, offset}``. The topic is
    the message's own if ``decoded`` has a ``topic`` column, else ``topic``.
    """
    from fleetspark.model import TELEMETRY_SCHEMA, VEHICLE_TYPES

    fields = []
    for f in TELEMETRY_SCHEMA.fields:
        if f.name == "timestamp":
            fields.append(rfc3339(F.col("timestamp")).alias("timestamp"))
        else:
            fields.append(with_defaults(F.col(f.name), f.dataType, VEHICLE_TYPES[0] if f.name == "vehicle_type" else "").alias(f.name))
    own = F.coalesce(F.col("topic"), F.lit(topic)) if "topic" in decoded.columns else F.lit(topic)
    kafka = F.struct(own.alias("topic"), F.col("kafka_partition").alias("partition"), F.col("kafka_offset").alias("offset"))
    body = F.to_json(F.struct(*fields, kafka.alias("kafka")))
    event_time = F.col("timestamp").cast("timestamp")
    return decoded.select(
        F.col("message_id").alias("id"),
        F.concat(F.lit(index_prefix), F.date_format(event_time, "yyyy.MM.dd")).alias("index"),
        event_time.alias("event_time"),
        F.col("kafka_partition"),
        F.col("kafka_offset"),
        body.alias("document"),
    )


def upsert_documents(spark: SparkSession, docs: DataFrame, path: str) -> None:
    """Idempotent document store: one row per id, partitioned by daily index (S3)."""
    merge_upsert(spark, docs, path, ["id"], ["index"])
