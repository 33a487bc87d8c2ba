"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver's tables (telemetry derived from ``events``)
in full. Output columns are scalar and aliased so they line up with the SQL
in ``plans.oracle``; sums and averages of doubles are rounded to 6 digits
there and here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspark.model import STAGING_COLUMNS
from fleetspark.operators import marts
from fleetspark.operators.staging import first_readings, flatten_readings, stage_readings
from fleetspark.sources.readings import load_messages

Query = Callable[[SparkSession, str], DataFrame]


def staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_readings(load_messages(spark, sf_dir))


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging without the distance, for marts that need none: nothing is written for them."""
    return first_readings(load_messages(spark, sf_dir))


def _round(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if c in cols else F.col(c) for c in df.columns])


def _arrays_as_text(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*[F.array_join(c, ",").alias(c) if c in cols else F.col(c) for c in df.columns])


def q_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _arrays_as_text(staging(spark, sf_dir).select(*STAGING_COLUMNS), ["dtc_codes", "events"])


def q_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = marts.daily(staging(spark, sf_dir))
    return _round(d, ["distance_km", "avg_speed_kmh", "avg_moving_speed_kmh", "avg_engine_temp_c"])


def q_dim_vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.dim_vehicles(readings(spark, sf_dir))


def q_latest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _arrays_as_text(marts.latest_status(readings(spark, sf_dir)), ["dtc_codes"])


def q_vehicle_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.vehicle_events(readings(spark, sf_dir))


def q_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(marts.hourly(readings(spark, sf_dir)), ["avg_speed_kmh"])


def q_time_chart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(marts.time_chart(readings(spark, sf_dir), "speed_kmh", "15 minutes"), ["avg_speed_kmh"])


def q_count_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.count_by(readings(spark, sf_dir), ["vehicle_type"])


def q_search_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = marts.search_events(readings(spark, sf_dir), event="speeding", min_engine_temp=150, check_engine_light=True)
    return _arrays_as_text(
        found.select("message_id", "vehicle_id", "recorded_at", "speed_kmh", "engine_temp_c", "check_engine_light", "events"),
        ["events"],
    )


def q_redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.duplicates(flatten_readings(load_messages(spark, sf_dir)), ["message_id"])


QUERIES: dict[str, Query] = {
    "M7_staging": q_staging,
    "D2_daily": q_daily,
    "D1_dim_vehicles": q_dim_vehicles,
    "E2_latest_status": q_latest_status,
    "B12_vehicle_events": q_vehicle_events,
    "D9_hourly_speed": q_hourly,
    "D10_time_chart": q_time_chart,
    "D8_count_by_type": q_count_by_type,
    "B8_search_events": q_search_events,
    "D7_redelivered_messages": q_redelivered,
}


VALIDATION_NOW = "2024-01-30 00:00:00"


def q_field_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule violations of every delivered message (Q1-Q22, Q24), ``now`` fixed so results are stable."""
    from fleetspark.plans.quality import strict_values, validate

    msgs = load_messages(spark, sf_dir)
    return validate(strict_values(msgs), now=VALIDATION_NOW)


def q_model_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model checks of staging and marts (Q26-Q31, C2) with failing-row counts."""
    from fleetspark.model import ACCEPTED_EVENT_TYPES, ACCEPTED_VEHICLE_TYPES
    from fleetspark.plans import quality as q

    from fleetspark.session import materialize

    stg = materialize(staging(spark, sf_dir))
    fct = marts.vehicle_events(stg)
    dim = marts.dim_vehicles(stg)
    daily = marts.daily(stg)
    stg_rows = q.count_failures(
        stg,
        {
            "stg_message_id_not_null": F.col("message_id").isNull(),
            "stg_vehicle_id_not_null": F.col("vehicle_id").isNull(),
            "stg_vehicle_type_accepted": ~F.col("vehicle_type").isin(ACCEPTED_VEHICLE_TYPES),
            "stg_recorded_at_not_null": F.col("recorded_at").isNull(),
            "stg_latitude_not_null": F.col("latitude").isNull(),
            "stg_longitude_not_null": F.col("longitude").isNull(),
            "stg_speed_not_negative": F.col("speed_kmh") < 0,
            "stg_readings_over_limits": (F.col("speed_kmh") > 250) | (F.col("engine_temp_c") > 150),
        },
    )
    fct_rows = q.count_failures(
        fct,
        {
            "events_event_id_not_null": F.col("event_id").isNull(),
            "events_event_type_accepted": ~F.col("event_type").isin(ACCEPTED_EVENT_TYPES),
        },
    )
    table_checks = [
        ("stg_message_id_unique", q.check_unique(stg, "message_id")),
        ("events_event_id_unique", q.check_unique(fct, "event_id")),
        ("events_vehicle_in_dim", q.check_relationship(fct, "vehicle_id", dim, "vehicle_id")),
        ("daily_unique_vehicle_day", q.check_unique_combination(daily, ["vehicle_id", "event_date"])),
    ]
    tables = q.run_checks(stg, [q.Check(name, (lambda _df, failing=failing: failing)) for name, failing in table_checks])
    return stg_rows.unionByName(fct_rows).unionByName(tables)


QUERIES["Q24_field_violations"] = q_field_violations
QUERIES["Q31_model_checks"] = q_model_checks


# The archive "as of" this ingestion time is loaded first, then everything, then everything again.
INCREMENT_CUT = "2024-01-16 00:00:00"
# Snapshot runs: the dimension as of each cut (None = all readings).
SNAPSHOT_CUTS = ("2024-01-10 00:00:00", "2024-01-20 00:00:00", None)
AS_OF = "2024-01-15 00:00:00"


def q_incremental_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event fact loaded in increments and merged on event_id (C1, C3, D6, I1, I2); end state."""
    from fleetspark.operators.incremental import incremental_events
    from fleetspark.session import work_path

    msgs = load_messages(spark, sf_dir)
    path = work_path(spark, "fct_vehicle_events")
    first = msgs.where(F.col("ingested_at") < F.lit(INCREMENT_CUT).cast("timestamp_ntz"))
    incremental_events(spark, first_readings(first), path)
    everything = first_readings(msgs)
    incremental_events(spark, everything, path)
    incremental_events(spark, everything, path)  # a rerun changes nothing
    return spark.read.parquet(path)


def scd2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fleetspark.operators.snapshot import scd2
    from fleetspark.session import materialize

    stg = materialize(readings(spark, sf_dir))
    history = None
    for cut in SNAPSHOT_CUTS:
        rows = stg if cut is None else stg.where(F.col("recorded_at") < F.lit(cut).cast("timestamp_ntz"))
        history = materialize(scd2(history, marts.dim_vehicles(rows), "vehicle_id", updated_at="last_seen_at"))
    return history


def q_scd2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type 2 history of the vehicle dimension after three snapshot runs."""
    return scd2_history(spark, sf_dir)


def q_scd2_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicle versions valid at a point in time."""
    from fleetspark.operators.snapshot import as_of

    return as_of(scd2_history(spark, sf_dir), AS_OF)


def q_scd2_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current vehicle versions (I8)."""
    from fleetspark.operators.snapshot import current_rows

    return current_rows(scd2_history(spark, sf_dir))


QUERIES["I1_incremental_events"] = q_incremental_events
QUERIES["I5_scd2_history"] = q_scd2_history
QUERIES["I7_scd2_as_of"] = q_scd2_as_of
QUERIES["I8_scd2_current"] = q_scd2_current


def q_archive_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages -> binary archive (A6) -> read, explode, decode (A1-A3, A5) -> staging readings.

    proto3 semantics show in the result: unset repeated fields read back as
    empty arrays and a missing tire reading as 0.
    """
    from fleetspark.session import work_path
    from fleetspark.sources.archive import telemetry_archive, to_kafka_records, write_archive

    path = work_path(spark, "archive")
    write_archive(to_kafka_records(load_messages(spark, sf_dir)), path)
    stg = stage_readings(telemetry_archive(spark, path))
    out = _arrays_as_text(stg.select(*STAGING_COLUMNS), ["dtc_codes", "events"])
    return out.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c in ("recorded_at", "ingested_at") else F.col(c) for c in out.columns])


QUERIES["A3_archive_roundtrip"] = q_archive_roundtrip


def control_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A compacted-topic changelog derived from ``events``: key per vehicle, tombstones, unkeyed records."""
    events = load_messages(spark, sf_dir, redeliver=False).select("vehicle_id", "kafka_offset", "timestamp", "events", "check_engine_light")
    value = F.when(
        ~F.col("check_engine_light"),
        F.struct(F.coalesce(F.array_contains("events", "SPEEDING"), F.lit(False)).alias("paused"), F.col("timestamp").alias("updated_at")),
    )
    key = F.when(~F.coalesce(F.array_contains("events", "HARSH_ACCELERATION"), F.lit(False)), F.col("vehicle_id"))
    return events.select(key.alias("key"), value.alias("value"), F.col("kafka_offset").alias("offset"))


def q_latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest value per key of a compacted changelog; tombstones delete, NULL keys are ignored."""
    from fleetspark.streaming.ingest import latest_state

    latest = latest_state(control_changelog(spark, sf_dir))
    return latest.select("key", F.col("value.paused").alias("paused"), F.col("value.updated_at").alias("updated_at"), "offset")


def _lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fleetspark.sources.offsets import ARCHIVE_GROUP, DOCUMENT_GROUP, offset_samples
    from fleetspark.streaming.monitoring import lag_report

    samples, commits = offset_samples(load_messages(spark, sf_dir))
    return lag_report(samples, commits, (ARCHIVE_GROUP, DOCUMENT_GROUP))


def q_lag_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly consumer-lag report per group."""
    return _lag(spark, sf_dir)


RATE_WINDOW_SECONDS = 7200


def q_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Produced and consumed messages per second over a trailing window, per group."""
    from fleetspark.streaming.monitoring import rates

    r = rates(_lag(spark, sf_dir), ["produced", "consumed"], window_seconds=RATE_WINDOW_SECONDS)
    return _round(r, ["produced_rate", "consumed_rate"])


HISTORY_MINUTES = 600


def q_lag_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lag report of the last minutes before the newest sample."""
    from fleetspark.streaming.monitoring import lag_history

    return lag_history(_lag(spark, sf_dir), HISTORY_MINUTES)


QUERIES["S10_latest_state"] = q_latest_state
QUERIES["S11_lag_report"] = q_lag_report
QUERIES["S12_rates"] = q_rates
QUERIES["S13_lag_history"] = q_lag_history


# Streaming runs: the derived input arrives as three chunks in event-time order, each processed by
# its own availableNow run (one micro-batch per chunk, distributed like any batch job).
STREAM_CHUNKS = 3


def _chunk(df: DataFrame, col: str) -> F.Column:
    """Equal parts of the time that the column spans; rows without a time come first."""
    ends = df.agg(F.min(F.unix_micros(F.col(col).cast("timestamp"))).alias("a"), F.max(F.unix_micros(F.col(col).cast("timestamp"))).alias("b")).first()
    if ends.a is None:
        return F.lit(0)
    part = (F.unix_micros(F.col(col).cast("timestamp")) - ends.a) * STREAM_CHUNKS / (ends.b - ends.a + 1)
    return F.coalesce(F.floor(part).cast("int"), F.lit(0))


def _feed_in_chunks(spark: SparkSession, df: DataFrame, chunk: F.Column, name: str, run) -> None:
    """Appends ``df`` to one folder chunk by chunk; after each chunk ``run(stream)`` processes the new files.

    ``df`` is checkpointed first so the chunks do not recompute it.
    """
    from fleetspark.session import materialize, work_path

    src = work_path(spark, f"{name}-src")
    data = materialize(df.withColumn("_chunk", chunk))
    schema = data.drop("_chunk").schema
    for c in range(STREAM_CHUNKS):
        data.where(F.col("_chunk") == c).drop("_chunk").write.mode("append").parquet(src)
        run(spark.readStream.schema(schema).parquet(src))


def q_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First arrival per message_id in a stream, state bounded by a watermark on ingested_at."""
    from fleetspark.session import work_path
    from fleetspark.streaming.ingest import stream_dedup, upsert_stream

    out, ckpt = work_path(spark, "dedup-out"), work_path(spark, "dedup-ckpt")

    def run(stream: DataFrame) -> None:
        upsert_stream(stream_dedup(stream, delay="7 days"), out, ckpt, ["message_id"], ["event_date"]).awaitTermination()

    readings = flatten_readings(load_messages(spark, sf_dir))
    _feed_in_chunks(spark, readings, _chunk(readings, "ingested_at"), "dedup", run)
    return spark.read.parquet(out).select("message_id", "vehicle_id", "recorded_at", "kafka_partition", "kafka_offset")


def q_stream_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Previous odometer and distance with per-vehicle state across micro-batches (S9); equals batch."""
    from fleetspark.operators.staging import dedup_first
    from fleetspark.session import work_path
    from fleetspark.streaming.ingest import stream_distance

    out, ckpt = work_path(spark, "dist-out"), work_path(spark, "dist-ckpt")

    def run(stream: DataFrame) -> None:
        writer = stream_distance(stream).writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
        writer.trigger(availableNow=True).start().awaitTermination()

    readings = dedup_first(flatten_readings(load_messages(spark, sf_dir)))
    _feed_in_chunks(spark, readings, _chunk(readings, "recorded_at"), "dist", run)
    return spark.read.parquet(out).select("message_id", "vehicle_id", "previous_odometer_km", "distance_km")


def q_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search documents of every delivered message, upserted by id into daily indexes (A8, S3, S4), read back from their JSON."""
    from fleetspark.session import work_path
    from fleetspark.streaming.ingest import to_documents, upsert_documents

    path = work_path(spark, "documents")
    docs = to_documents(load_messages(spark, sf_dir))
    upsert_documents(spark, docs, path)
    upsert_documents(spark, docs, path)  # redelivery / replay: same documents
    stored = spark.read.parquet(path)
    text = lambda p: F.get_json_object("document", f"$.{p}")
    names = lambda p: F.array_join(F.from_json(text(p), "array<string>"), ",")
    return stored.select(
        "id",
        "index",
        "kafka_partition",
        "kafka_offset",
        text("kafka.topic").alias("topic"),
        text("kafka.offset").cast("bigint").alias("json_offset"),
        text("timestamp").cast("timestamp").cast("timestamp_ntz").alias("json_timestamp"),
        text("vehicle_type").alias("vehicle_type"),
        text("speed_kmh").cast("double").alias("speed_kmh"),
        text("gear").cast("int").alias("gear"),
        text("check_engine_light").cast("boolean").alias("check_engine_light"),
        text("tire_pressure_kpa.rear_right").cast("double").alias("rear_right"),
        names("dtc_codes").alias("dtc_codes"),
        names("events").alias("events"),
    )


def q_archive_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries per message after two writers wrote one archive (A6): none is lost."""
    from fleetspark.session import work_path
    from fleetspark.sources.archive import telemetry_archive, to_kafka_records, write_archive

    path = work_path(spark, "archive-append")
    messages = load_messages(spark, sf_dir)
    for part in (0, 1):
        write_archive(to_kafka_records(messages.where(F.col("kafka_offset") % 2 == part)), path)
    return telemetry_archive(spark, path).groupBy("message_id").agg(F.count("*").alias("deliveries"))


def q_merge_null_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A merge into partitions, one of which has no date (C3, I2): rows the source lacks stay."""
    from fleetspark.operators.incremental import merge_upsert
    from fleetspark.operators.staging import dedup_first
    from fleetspark.session import work_path

    firsts = dedup_first(flatten_readings(load_messages(spark, sf_dir)))
    day = F.when(F.col("kafka_offset") % 5 != 0, F.col("event_date"))
    rows = firsts.select("message_id", "kafka_offset", day.alias("event_date"))
    path = work_path(spark, "merge-null")
    turn = F.col("kafka_offset") % 3
    merge_upsert(spark, rows.where(turn < 2).withColumn("version", F.lit(1)), path, ["message_id"], ["event_date"])
    merge_upsert(spark, rows.where(turn > 0).withColumn("version", F.lit(2)), path, ["message_id"], ["event_date"])
    return spark.read.parquet(path).select("message_id", "kafka_offset", "event_date", "version")


def q_full_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table published twice (A10): dates that the second run lacks are gone."""
    from fleetspark.plans.quality import publish_if_valid
    from fleetspark.session import work_path

    rows = readings(spark, sf_dir).select("message_id", "event_date")
    path = work_path(spark, "rebuild")
    for run in (rows, rows.where(F.dayofmonth("event_date") % 2 == 1)):
        publish_if_valid(spark, run, {}, path, partition_by=["event_date"])
    return spark.read.parquet(path).select("message_id", "event_date")


def q_previous_reading(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Previous odometer and distance when redelivered copies differ (E3): only the first copy counts."""
    late = F.col("ingested_at") > F.col("timestamp") + F.expr("interval 1 minute")
    odometer = F.col("odometer_km") + F.when(late, 1000.0).otherwise(0.0)
    messages = load_messages(spark, sf_dir).withColumn("odometer_km", odometer)
    return stage_readings(messages).select("message_id", "previous_odometer_km", "distance_km")


QUERIES["S6_stream_dedup"] = q_stream_dedup
QUERIES["S9_stream_distance"] = q_stream_distance
QUERIES["A8_documents"] = q_documents
def q_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a build publishes and skips (Q33): input as it is, without the messages that break rules, and with a doubled vehicle type."""
    from fleetspark.plans.build import build
    from fleetspark.plans.quality import strict_values, validate
    from fleetspark.session import work_path

    messages = load_messages(spark, sf_dir)
    broken = validate(strict_values(messages), keys=["kafka_partition", "kafka_offset"]).select("kafka_partition", "kafka_offset").distinct()
    clean = messages.join(broken, ["kafka_partition", "kafka_offset"], "left_anti")
    odd = messages.withColumn("vehicle_type", F.when(F.col("vehicle_type") == "BUS", "TRAM").otherwise(F.col("vehicle_type")))
    rows = []
    for name, given, mode in (("raw", messages, "error"), ("clean", clean, "error"), ("odd_types", odd, "report")):
        report = build(spark, given, work_path(spark, f"gate-{name}"), source_checks=mode)
        rows += [(name, step, r["published"], r["skipped"]) for step, r in report.items() if step != "timings"]
    return spark.createDataFrame(rows, "input string, step string, published boolean, skipped boolean")


QUERIES["Q33_gate"] = q_gate
QUERIES["A6_archive_append"] = q_archive_append
QUERIES["I2_merge_null_partition"] = q_merge_null_partition
QUERIES["A10_full_rebuild"] = q_full_rebuild
QUERIES["E3_previous_reading"] = q_previous_reading


PUBLISH_CUT = "2024-01-16 00:00:00"
SPEED_LIMIT = 250


def q_publish_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What publishers put into a versioned table and what readers see of it (Q33, A10).

    A first load; one that breaks a check; a full load; a publisher that began
    before that and lost; a replacement of the odd days. Two versions are kept.
    """
    from fleetspark.operators.staging import dedup_first
    from fleetspark.plans.quality import publish_version
    from fleetspark.session import work_path
    from fleetspark.sources.versioned import Conflict, VersionedTable

    readings = dedup_first(flatten_readings(load_messages(spark, sf_dir))).select("message_id", "vehicle_id", "event_date", "ingested_at", "speed_kmh")
    within = {"speed_within_limit": F.col("speed_kmh") <= SPEED_LIMIT}
    fine = readings.where(F.col("speed_kmh") <= SPEED_LIMIT)
    path = work_path(spark, "published")
    table = VersionedTable(spark, path)
    rows: dict[int, int] = {}
    attempts: list[tuple[str, int | None]] = []

    def attempt(name: str, run) -> None:
        try:
            version = run()
        except Conflict:
            version = None
        if version is not None:
            rows[version] = table.read(version).count()
        attempts.append((name, version))

    gate = lambda df, base=None: publish_version(spark, df, within, path, partition_by=["event_date"], base=base)["version"]
    early = fine.where(F.col("ingested_at") < F.lit(PUBLISH_CUT).cast("timestamp_ntz"))
    attempt("first", lambda: gate(early))
    attempt("unchecked", lambda: gate(readings))
    attempt("full", lambda: gate(fine))
    attempt("late", lambda: gate(early, base=1))
    odd = fine.where((F.dayofmonth("event_date") % 2 == 1) & (F.col("speed_kmh") <= 100))
    attempt("odd_days", lambda: table.replace_partitions(odd, ["event_date"]).number)
    table.expire(2)
    known = table.versions()
    out = [(name, v, rows.get(v), bool(v) and v == known[-1], v in known) for name, v in attempts]
    return spark.createDataFrame(out, "attempt string, version int, rows bigint, visible boolean, readable boolean")


QUERIES["Q33_publish_versions"] = q_publish_versions


def q_carry_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Previous odometer where one vehicle sends a third of all readings and a quarter of them have one time."""
    from fleetspark.operators.staging import carry_previous

    rows = first_readings(load_messages(spark, sf_dir))
    hot = F.when(F.col("kafka_offset") % 3 == 0, F.lit("vehicle-hot")).otherwise(F.col("vehicle_id"))
    stuck = F.when(F.col("kafka_offset") % 12 < 3, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).otherwise(F.col("recorded_at"))
    rows = rows.select("message_id", hot.alias("vehicle_id"), stuck.alias("recorded_at"), "odometer_km")
    return carry_previous(rows, "vehicle_id", ["recorded_at", "message_id"], "odometer_km", "previous_odometer_km")


QUERIES["E3_carry_scan"] = q_carry_scan


# -- streams with keyed state ----------------------------------------------

HEARTBEAT = "heartbeat"


def _feed_out_of_order(spark: SparkSession, rows: DataFrame, name: str, run) -> None:
    """Feeds readings in three parts by a time of arrival up to four hours after their own, then a heartbeat that lets the watermark pass them."""
    from fleetspark.session import materialize, work_path

    rows = materialize(rows.withColumn("arrived", F.col("recorded_at") + F.make_dt_interval(hours=(F.col("kafka_offset") % 5).cast("int"))))
    part = _chunk(rows, "arrived")
    src = work_path(spark, f"{name}-src")
    schema = rows.drop("arrived").schema
    for c in range(STREAM_CHUNKS + 1):
        if c < STREAM_CHUNKS:
            new = rows.where(part == c).drop("arrived")
        else:
            beat = {"vehicle_id": F.lit(HEARTBEAT), "message_id": F.lit(HEARTBEAT), "recorded_at": F.col("last") + F.expr("interval 3 days")}
            last = rows.agg(F.max("recorded_at").alias("last"))
            new = last.select(*[beat.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])
        new.write.mode("append").parquet(src)
        run(spark.readStream.schema(schema).parquet(src))


def _stream_fact(spark: SparkSession, sf_dir: str, name: str, fact) -> DataFrame:
    from fleetspark.session import work_path
    from fleetspark.sources.versioned import VersionedTable
    from fleetspark.streaming.keyed_state import append_once, start

    table, ckpt = VersionedTable(spark, work_path(spark, f"{name}-out")), work_path(spark, f"{name}-ckpt")

    def write(batch: DataFrame, batch_id: int) -> None:
        append_once(table, batch, batch_id)

    _feed_out_of_order(spark, readings(spark, sf_dir), name, lambda stream: start(fact(stream), write, ckpt).awaitTermination())
    return table.read()


def _without_zone(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c in cols else F.col(c) for c in df.columns])


def q_stream_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole daily fact from a stream that is out of order: keyed distances, then windows in append mode."""
    from fleetspark.streaming.keyed_state import daily_fact, fact_measures, stream_steps

    daily = _stream_fact(spark, sf_dir, "stream-daily", lambda stream: daily_fact(stream_steps(fact_measures(stream))))
    daily = _round(daily, ["distance_km", "avg_speed_kmh", "avg_moving_speed_kmh", "avg_engine_temp_c"])
    return _without_zone(daily, ["first_reading_at", "last_reading_at"])


def q_stream_chart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The time chart from the same stream."""
    from fleetspark.streaming.keyed_state import chart_fact

    chart = _stream_fact(spark, sf_dir, "stream-chart", chart_fact)
    return _without_zone(_round(chart, ["avg_speed_kmh"]), ["window_start", "window_end"])


def _feed_parts(spark: SparkSession, df: DataFrame, part: str, name: str, run) -> None:
    _feed_in_chunks(spark, df.withColumnRenamed(part, "_part"), F.col("_part"), name, lambda stream: run(stream.drop("_part")))


def q_stream_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The compacted changelog kept by a stream with replays and late tombstones, folded once in between."""
    from fleetspark.session import work_path
    from fleetspark.streaming.keyed_state import ChangeLog

    log, ckpt = ChangeLog(spark, work_path(spark, "changelog"), buckets=8), work_path(spark, "changelog-ckpt")
    records = control_changelog(spark, sf_dir).withColumn("at", F.timestamp_seconds("offset"))
    # A seventh comes only in the last part, and a fifth of the first part comes again there.
    part = F.when(F.col("offset") % 7 == 0, STREAM_CHUNKS - 1).otherwise(_chunk(records, "at"))
    parts = F.when((part == 0) & (F.col("offset") % 5 == 0), F.array(part, F.lit(STREAM_CHUNKS - 1))).otherwise(F.array(part))
    fed = records.select("key", "value", "offset", F.explode(parts).alias("part"))
    runs = iter(range(STREAM_CHUNKS))

    def run(stream: DataFrame) -> None:
        log.start(stream, ckpt).awaitTermination()
        if next(runs) == 1:
            log.compact()

    _feed_parts(spark, fed, "part", "changelog", run)
    return log.read().select("key", F.col("value.paused").alias("paused"), F.col("value.updated_at").alias("updated_at"), "offset")


def q_stream_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates per sample from a ring of samples per group."""
    from fleetspark.session import work_path
    from fleetspark.sources.versioned import VersionedTable
    from fleetspark.streaming.keyed_state import append_once, start, stream_rates

    table, ckpt = VersionedTable(spark, work_path(spark, "rates-out")), work_path(spark, "rates-ckpt")

    def run(stream: DataFrame) -> None:
        rates = stream_rates(stream, ["produced", "consumed"], window_seconds=RATE_WINDOW_SECONDS)
        start(rates, lambda batch, n: append_once(table, batch, n), ckpt, idle_batches=False).awaitTermination()

    report = _lag(spark, sf_dir).withColumn("at", F.timestamp_seconds("t"))
    _feed_in_chunks(spark, report, _chunk(report, "at"), "rates", run)
    return _round(table.read(), ["produced_rate", "consumed_rate"])


QUERIES["S8_stream_daily"] = q_stream_daily
QUERIES["S8_stream_chart"] = q_stream_chart
QUERIES["S10_stream_state"] = q_stream_state
QUERIES["S12_stream_rates"] = q_stream_rates
