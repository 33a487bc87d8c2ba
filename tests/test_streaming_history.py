"""Streaming results equal batch results; merges, snapshots and monitoring edge cases."""

import datetime as dt
import os

from pyspark.sql import functions as F

from fleetspark.operators import marts
from fleetspark.operators.incremental import incremental_events, merge_upsert, read_if_exists
from fleetspark.operators.snapshot import as_of, scd2
from fleetspark.operators.staging import dedup_first, flatten_readings, stage_readings
from fleetspark.sources import archive as A
from fleetspark.sources.readings import load_messages
from fleetspark.streaming import ingest as S
from fleetspark.streaming.monitoring import lag_report, rates
from table_dirs import SF_SMALL


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def _write_archive(spark, path, msgs, prefix="part"):
    A.write_archive(A.to_kafka_records(msgs), path, prefix=prefix)


def test_archive_stream_reads_only_new_files_and_dedups(spark, tmp_dir):
    msgs = load_messages(spark, SF_SMALL)
    first = msgs.where(F.col("kafka_offset") < 500)
    rest = msgs.where(F.col("kafka_offset") >= 500)
    archive, out, ckpt = f"{tmp_dir}/archive", f"{tmp_dir}/readings", f"{tmp_dir}/ckpt"
    _write_archive(spark, archive, first, "part-a")

    def run():
        stream = S.stream_dedup(S.stream_messages(spark, archive), delay="7 days")
        q = S.upsert_stream(flatten_readings(stream), out, ckpt, ["message_id"], ["event_date"])
        q.awaitTermination()

    run()
    n_first = spark.read.parquet(out).count()
    _write_archive(spark, archive, rest, "part-b")
    run()  # a second run sees only the new files
    got = spark.read.parquet(out)
    batch = dedup_first(flatten_readings(msgs))
    assert n_first < got.count() == batch.count()
    assert _rows(got, ["message_id", "kafka_offset"]) == _rows(batch, ["message_id", "kafka_offset"])
    run()  # nothing new: unchanged
    assert spark.read.parquet(out).count() == batch.count()


def test_upsert_replay_from_earliest_leaves_target_unchanged(spark, tmp_dir):
    msgs = load_messages(spark, SF_SMALL)
    docs = S.to_documents(msgs)
    path = f"{tmp_dir}/docs"
    S.upsert_documents(spark, docs, path)
    before = _rows(spark.read.parquet(path), ["id", "kafka_offset", "document"])
    S.upsert_documents(spark, docs, path)  # replay everything
    after = spark.read.parquet(path)
    assert _rows(after, ["id", "kafka_offset", "document"]) == before
    assert after.select("id").distinct().count() == after.count()
    doc = after.orderBy("id").first()
    assert doc["index"].startswith("vehicle-telemetry-2024.")
    assert '"kafka":{"topic":"vehicle-telemetry"' in doc["document"] and doc["document"].count('"timestamp":"2024-') == 1


def test_stream_distance_and_daily_equal_batch(spark, tmp_dir):
    msgs = load_messages(spark, SF_SMALL)
    stg = stage_readings(msgs)
    src = f"{tmp_dir}/src"
    # three micro-batches in event-time order
    dedup = dedup_first(flatten_readings(msgs)).withColumn("part", F.when(F.dayofmonth("recorded_at") < 11, 0).when(F.dayofmonth("recorded_at") < 21, 1).otherwise(2))
    for p in range(3):
        dedup.where(F.col("part") == p).drop("part").write.mode("overwrite").parquet(f"{src}/p={p}")
    schema = spark.read.parquet(f"{src}/p=0").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{src}/p=*")
    with_dist = S.stream_distance(stream)
    q = with_dist.writeStream.format("parquet").option("path", f"{tmp_dir}/dist").option("checkpointLocation", f"{tmp_dir}/c1").trigger(availableNow=True).start()
    q.awaitTermination()
    got = spark.read.parquet(f"{tmp_dir}/dist")
    assert _rows(got, ["message_id", "distance_km"]) == _rows(stg, ["message_id", "distance_km"])

    stream2 = spark.readStream.schema(got.schema).parquet(f"{tmp_dir}/dist")
    q2 = S.stream_daily(stream2, f"{tmp_dir}/daily", f"{tmp_dir}/c2")
    q2.awaitTermination()
    daily_stream = spark.read.parquet(f"{tmp_dir}/daily")
    daily_batch = marts.daily(stg)
    cols = ["vehicle_id", "event_date", "reading_count", "max_speed_kmh", "min_fuel_level_pct"]
    assert _rows(daily_stream, cols) == _rows(daily_batch, cols)


def test_stream_distance_of_vehicles_that_share_a_group(spark, tmp_dir):
    at = lambda m: dt.datetime(2024, 1, 1, 0, m)
    parts = [
        [("a", at(1), "1", 1.0), ("a", at(3), "2", 1.5), ("b", at(2), "3", 7.0), (None, at(1), "4", 2.0), ("c", at(5), "5", None)],
        # Older than a's newest reading, then one of the same time; b goes on; a vehicle that is new.
        [("a", at(2), "6", 1.2), ("a", at(3), "7", 2.0), ("b", at(4), "8", 7.25), ("d", at(1), "9", 3.0), (None, at(2), "10", 2.5), ("c", at(6), "11", 4.0)],
        [("a", at(9), "12", 2.5), ("c", at(7), "13", 4.5), ("d", at(1), "14", 3.5)],
    ]
    schema = "vehicle_id string, recorded_at timestamp, message_id string, odometer_km double"
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/shared-src")
        stream = spark.readStream.schema(schema).parquet(f"{tmp_dir}/shared-src")
        writer = S.stream_distance(stream, buckets=1).writeStream.format("parquet").option("path", f"{tmp_dir}/shared").option("checkpointLocation", f"{tmp_dir}/shared-ckpt")
        writer.trigger(availableNow=True).start().awaitTermination()
    got = {r.message_id: (r.vehicle_id, r.previous_odometer_km, r.distance_km) for r in spark.read.parquet(f"{tmp_dir}/shared").collect()}
    assert got == {
        "1": ("a", None, 0.0), "2": ("a", 1.0, 0.5), "3": ("b", None, 0.0), "4": (None, None, 0.0), "5": ("c", None, 0.0),
        "6": ("a", 1.5, 0.0), "7": ("a", 1.5, 0.5), "8": ("b", 7.0, 0.25), "9": ("d", None, 0.0), "10": (None, 2.0, 0.5), "11": ("c", None, 0.0),
        "12": ("a", 2.0, 0.5), "13": ("c", 4.0, 0.5), "14": ("d", 3.0, 0.5),
    }


def test_incremental_runs_are_idempotent_and_pick_up_new_partitions(spark, tmp_dir):
    msgs = load_messages(spark, SF_SMALL)
    path = f"{tmp_dir}/fct"
    only_p0 = stage_readings(msgs.where(F.col("kafka_partition") == 0))
    incremental_events(spark, only_p0, path)
    n0 = spark.read.parquet(path).count()
    everything = stage_readings(msgs)
    incremental_events(spark, everything, path)  # partitions 1, 2 unseen -> read fully
    full = marts.vehicle_events(everything)
    assert n0 < spark.read.parquet(path).count() == full.count()
    incremental_events(spark, everything, path)
    incremental_events(spark, only_p0, path)  # only lower offsets: nothing new
    assert _rows(spark.read.parquet(path), ["event_id", "kafka_offset"]) == _rows(full, ["event_id", "kafka_offset"])


def test_merge_updates_matches_and_inserts_new(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    a = spark.createDataFrame([("k1", 1, "2024-01-01"), ("k2", 1, "2024-01-02")], "event_id string, v int, event_date string")
    merge_upsert(spark, a, path, ["event_id"], ["event_date"])
    b = spark.createDataFrame([("k2", 2, "2024-01-02"), ("k3", 3, "2024-01-03")], "event_id string, v int, event_date string")
    merge_upsert(spark, b, path, ["event_id"], ["event_date"])
    got = {r["event_id"]: r["v"] for r in spark.read.parquet(path).collect()}
    assert got == {"k1": 1, "k2": 2, "k3": 3}


def test_scd2_cases(spark):
    t = lambda d: dt.datetime(2024, 1, d)
    dim = "vehicle_id string, vin string, last_seen_at timestamp"
    v1 = spark.createDataFrame([("a", "A1", t(1)), ("b", "B1", t(1)), ("c", "C1", t(1))], dim)
    h1 = scd2(None, v1, "vehicle_id", updated_at="last_seen_at")
    # a unchanged, b newer, c missing from the source, d new
    v2 = spark.createDataFrame([("a", "A1", t(1)), ("b", "B2", t(5)), ("d", "D1", t(6))], dim)
    h2 = scd2(h1, v2, "vehicle_id", updated_at="last_seen_at").cache()
    rows = sorted((r["vehicle_id"], r["vin"], r["valid_from"], r["valid_to"]) for r in h2.collect())
    assert rows == [
        ("a", "A1", t(1), None),
        ("b", "B1", t(1), t(5)),
        ("b", "B2", t(5), None),
        ("c", "C1", t(1), None),
        ("d", "D1", t(6), None),
    ]
    assert sorted(r["vin"] for r in as_of(h2, t(3)).collect()) == ["A1", "B1", "C1"]
    again = scd2(h2, v2, "vehicle_id", updated_at="last_seen_at")
    assert again.count() == h2.count()
    # check strategy: a change of vin opens a version at `now`
    c1 = scd2(None, v1, "vehicle_id", check_cols=["vin"], now="2024-02-01 00:00:00")
    c2 = scd2(c1, v2, "vehicle_id", check_cols=["vin"], now="2024-02-02 00:00:00")
    open_b = [r for r in c2.collect() if r["vehicle_id"] == "b" and r["valid_to"] is None][0]
    assert open_b["vin"] == "B2" and open_b["valid_from"] == dt.datetime(2024, 2, 2)
    assert [r["valid_to"] for r in c2.collect() if r["vehicle_id"] == "a"] == [None]


def test_lag_starts_at_earliest_and_single_sample_rate_is_zero(spark):
    samples = spark.createDataFrame([(100, 0, 5, 20), (100, 1, 0, 10)], "t long, partition int, earliest long, end long")
    commits = spark.createDataFrame(
        [(100, "g", 0, None), (100, "g", 1, 4), (100, "stranger", 0, None), (100, "stranger", 1, None)],
        "t long, group_id string, partition int, committed long",
    )
    rep = {r["group_id"]: r for r in lag_report(samples, commits, known_groups=["g"]).collect()}
    assert set(rep) == {"g"}
    assert rep["g"]["lag"] == (20 - 5) + (10 - 4) and rep["g"]["consumed"] == 4
    assert rep["g"]["produced"] == 30 and rep["g"]["retained"] == 25
    r = rates(lag_report(samples, commits, ["g"]), ["consumed"]).collect()[0]
    assert r["consumed_rate"] == 0.0


def test_latest_state_overwrite_delete_and_null_key(spark):
    cl = spark.createDataFrame(
        [("a", "x", 1), ("a", "y", 2), ("b", "z", 3), ("b", None, 4), (None, "w", 5)],
        "key string, value string, offset long",
    )
    got = {r["key"]: r["value"] for r in S.latest_state(cl).collect()}
    assert got == {"a": "y"}


def test_lag_counts_silent_partitions_and_partial_commits(spark):
    samples = spark.createDataFrame([(10, 0, 0, 50), (20, 0, 0, 60), (20, 1, 5, 50), (30, 1, 5, 55)], "t long, partition int, earliest long, end long")
    commits = spark.createDataFrame([(10, "g", 0, 50), (30, "g", 1, 20)], "t long, group_id string, partition int, committed long")
    rows = sorted((r["t"], r["produced"], r["retained"], r["consumed"], r["lag"]) for r in lag_report(samples, commits).collect())
    assert rows == [(10, 55, 50, 50, 0), (20, 110, 105, 50, 55), (30, 115, 110, 70, 45)]
    assert min(r["produced_rate"] for r in rates(lag_report(samples, commits), ["produced"]).collect()) >= 0
    assert {r["group_id"] for r in lag_report(samples, commits.limit(0), ["h"]).collect()} == {"h"}
