"""Writers that share a place: appended archives, merges with missing dates, rebuilds, late copies."""

import datetime as dt

from pyspark.sql import functions as F

from fleetspark.model import VEHICLE_TYPES
from fleetspark.operators.incremental import merge_upsert, replace_where
from fleetspark.operators.staging import with_distance
from fleetspark.plans.quality import publish_if_valid
from fleetspark.sources.archive import explode_records, read_archive, to_kafka_records, write_archive
from fleetspark.sources.readings import load_messages
from fleetspark.streaming.ingest import to_documents

SMALL = "/root/testdata/sf0.001"
DAY = dt.date(2026, 1, 2)


def test_two_writers_keep_all_records(spark, tmp_dir):
    records = to_kafka_records(load_messages(spark, SMALL))
    write_archive(records, tmp_dir)
    write_archive(records, tmp_dir)
    assert explode_records(read_archive(spark, tmp_dir)).count() == 2 * records.count()


def test_repeated_batch_replaces_its_files(spark, tmp_dir):
    records = to_kafka_records(load_messages(spark, SMALL)).coalesce(1)
    write_archive(records, tmp_dir, prefix="part-a")
    write_archive(records, tmp_dir, prefix="part-a")
    assert explode_records(read_archive(spark, tmp_dir)).count() == records.count()


def test_merge_keeps_rows_without_a_date(spark, tmp_dir):
    table = lambda rows: spark.createDataFrame(rows, "id string, v int, day date")
    path = f"{tmp_dir}/t"
    merge_upsert(spark, table([("a", 1, None), ("b", 1, DAY), (None, 1, None)]), path, ["id"], ["day"])
    merge_upsert(spark, table([("c", 2, None), ("b", 2, DAY), (None, 2, None)]), path, ["id"], ["day"])
    got = {(r.id, r.v, r.day) for r in spark.read.parquet(path).collect()}
    assert got == {("a", 1, None), ("b", 2, DAY), ("c", 2, None), (None, 2, None)}


def test_replace_where_empties_the_partition_without_a_date(spark, tmp_dir):
    table = lambda rows: spark.createDataFrame(rows, "id string, v int, day date")
    path = f"{tmp_dir}/t"
    merge_upsert(spark, table([("a", 1, None), ("b", 1, DAY), ("c", 5, DAY)]), path, ["id"], ["day"])
    replace_where(spark, table([]), path, F.col("v") == 1, ["day"])
    assert [(r.id, r.day) for r in spark.read.parquet(path).collect()] == [("c", DAY)]


def test_rebuild_drops_stale_partitions(spark, tmp_dir):
    table = spark.createDataFrame([("a", DAY), ("b", DAY + dt.timedelta(days=1))], "id string, day date")
    path = f"{tmp_dir}/t"
    for rows in (table, table.where("id = 'b'")):
        assert publish_if_valid(spark, rows, {}, path, partition_by=["day"])["published"]
    assert [r.id for r in spark.read.parquet(path).collect()] == ["b"]


def test_distance_over_missing_times_and_keys(spark):
    at = lambda h: dt.datetime(2026, 1, 1, h)
    rows = [("v", at(1), "a", 5.0), ("v", at(1), "b", 5.5), ("v", at(3), "c", 6.0), (None, at(1), "d", 1.0), (None, at(2), "e", 1.5), ("v", None, "f", 4.5)]
    df = spark.createDataFrame(rows, "vehicle_id string, recorded_at timestamp, message_id string, odometer_km double")
    got = {r.message_id: (r.previous_odometer_km, r.distance_km) for r in with_distance(df).collect()}
    assert got == {"f": (None, 0.0), "a": (4.5, 0.5), "b": (5.0, 0.5), "c": (5.5, 0.5), "d": (None, 0.0), "e": (1.0, 0.5)}


def test_documents_hold_defaults(spark):
    bare = load_messages(spark, SMALL).limit(1)
    bare = bare.select(*[F.lit(None).cast(bare.schema[c].dataType).alias(c) if c in ("vehicle_type", "rpm", "dtc_codes", "events", "check_engine_light", "position") else F.col(c) for c in bare.columns])
    body = to_documents(bare).select(F.from_json("document", "vehicle_type string, rpm int, dtc_codes array<string>, events array<string>, check_engine_light boolean, position string").alias("b")).first().b
    assert (body.vehicle_type, body.rpm, body.dtc_codes, body.events, body.check_engine_light, body.position) == (VEHICLE_TYPES[0], 0, [], [], False, None)
