"""Versioned tables: failures between steps, lost races, clean-up; history that only grows; the carry scan."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from fleetspark.operators.snapshot import OPEN, History, as_of, scd2
from fleetspark.operators.staging import carry_previous
from fleetspark.plans.quality import Check, check_unique, publish_version
from fleetspark.sources import versioned as V


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, v int, d string")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


OLD, NEW = [("a", 1, "x"), ("b", 1, "y"), ("n", 1, None)], [("a", 2, "x"), ("c", 2, "z")]


class Stop(Exception):
    pass


@pytest.mark.parametrize("step", ["_listed", "put", "_put_if_absent", "_text", "discard", "expire", "_delete"])
def test_old_version_stays_readable_whatever_step_fails(spark, tmp_dir, monkeypatch, step):
    table = V.VersionedTable(spark, tmp_dir)
    table.replace(frame(spark, OLD), ["d"])
    table.replace(frame(spark, OLD), ["d"])

    def fail(*a, **k):
        raise Stop

    monkeypatch.setattr(V.VersionedTable, step, fail)
    checks = {"v_small": F.col("v") < 2} if step == "discard" else {}
    with pytest.raises(Stop):
        publish_version(spark, frame(spark, NEW), checks, tmp_dir, partition_by=["d"])
    monkeypatch.undo()
    put = step in ("expire", "_delete")  # these come after the manifest: the new version is out
    assert rows_of(V.VersionedTable(spark, tmp_dir).read()) == sorted(NEW if put else OLD, key=str)
    assert publish_version(spark, frame(spark, NEW), {}, tmp_dir, partition_by=["d"])["published"]
    assert rows_of(table.read()) == sorted(NEW, key=str)
    table.expire(1)
    table.vacuum(0)
    named = {e.commit for n in table.versions() for e in table.version(n).entries}
    assert {n for n in os.listdir(tmp_dir) if n.startswith(V.COMMIT)} == named


def test_a_write_that_dies_leaves_nothing(spark, tmp_dir):
    table = V.VersionedTable(spark, tmp_dir)
    table.replace(frame(spark, OLD), ["d"])
    broken = frame(spark, NEW).withColumn("v", F.when(F.col("k") == "c", F.raise_error(F.lit("broken")).cast("int")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="broken"):
        table.replace(broken, ["d"])
    assert rows_of(table.read()) == sorted(OLD, key=str)
    assert sum(n.startswith(V.COMMIT) for n in os.listdir(tmp_dir)) == 1


@pytest.mark.parametrize("renames", [False, True])
def test_only_one_publisher_wins_a_version(spark, tmp_dir, monkeypatch, renames):
    table = V.VersionedTable(spark, tmp_dir)
    base = table.replace(frame(spark, OLD), ["d"]).number
    first, second = (table.write(frame(spark, [(k, 9, "x")]), ["d"]) for k in "pq")
    if renames:  # the put of file systems without hard links
        monkeypatch.setattr(V.os, "link", lambda a, b: table._rename_if_absent(table._path(V.VERSIONS, os.path.basename(a)), table._path(V.VERSIONS, os.path.basename(b))))
    # Both saw version 1 as the newest when they began.
    monkeypatch.setattr(V.VersionedTable, "versions", lambda self, n=base: [n])
    table.replace(first, ["d"], base=base)
    with pytest.raises(V.Conflict):
        table.replace(second, ["d"], base=base)
    monkeypatch.undo()
    assert rows_of(table.read()) == [("p", 9, "x")] and table.versions() == [1, 2]
    with pytest.raises(V.Conflict):
        publish_version(spark, frame(spark, NEW), {}, tmp_dir, partition_by=["d"], base=1)
    # A change that does not depend on its base is tried again.
    assert table.append(frame(spark, [("r", 1, "y")]), ["d"]).number == 3


def test_versions_share_files_and_old_ones_expire(spark, tmp_dir):
    table = V.VersionedTable(spark, tmp_dir)
    table.replace(frame(spark, OLD), ["d"])
    table.append(frame(spark, [("c", 1, "x")]), ["d"])
    table.replace_partitions(frame(spark, [("a", 5, "x")]), ["d"], emptied=["d=y"])
    assert rows_of(table.read(1)) == sorted(OLD, key=str)
    assert rows_of(table.read()) == [("a", 5, "x"), ("n", 1, None)]
    first, last = table.version(1), table.version(3)
    assert {e.path for e in first.entries} & {e.path for e in last.entries}
    reader = table.read(2)
    assert table.expire(2) == [1] and reader.count() == 4
    assert table.expire(1) == [2] and table.versions() == [3]
    assert rows_of(table.read()) == [("a", 5, "x"), ("n", 1, None)]
    files = sum(len(f) for d, _, f in os.walk(tmp_dir) if V.COMMIT in d for f in [[x for x in f if x.endswith(".parquet")]])
    assert files == len(last.entries)
    with pytest.raises(ValueError, match="differ"):
        table.append(spark.createDataFrame([("a", 1)], "k string, d string"), ["d"])


def test_empty_tables_and_odd_names(spark, tmp_dir):
    table = V.VersionedTable(spark, f"{tmp_dir}/some table")
    assert table.version() is None and table.read_or_none() is None and table.expire() == [] and table.vacuum(0) == []
    with pytest.raises(FileNotFoundError):
        table.read()
    table.replace(frame(spark, []), ["d"])
    assert rows_of(table.read()) == []
    odd = [("a", 1, "x/y=1 %20"), ("b", 2, "{*}[é]"), ("c", 3, "")]
    table.replace(frame(spark, odd), ["d"])
    assert {r.k: r.d for r in table.read().collect()} == {"a": "x/y=1 %20", "b": "{*}[é]", "c": None}


def test_gate_counts_row_and_table_checks(spark, tmp_dir):
    unique = [Check("k_unique", lambda df: check_unique(df, "k"))]
    ok = publish_version(spark, frame(spark, OLD), {"v_positive": F.col("v") > 0}, tmp_dir, unique)
    bad = publish_version(spark, frame(spark, [("a", -1, "x"), ("a", 1, "x"), ("b", None, "x")]), {"v_positive": F.col("v") > 0}, tmp_dir, unique)
    assert ok["published"] and ok["rows"] == 3 and not bad["published"] and bad["failures"] == {"v_positive": 2, "k_unique": 1}
    assert rows_of(V.VersionedTable(spark, tmp_dir).read()) == sorted(OLD, key=str)


def test_merge_is_one_version(spark, tmp_dir):
    table = V.VersionedTable(spark, tmp_dir)
    for rows in (OLD, [("a", 7, "x"), ("z", 7, "x"), ("n", 7, None)]):
        version, failures = V.merge_into(table, frame(spark, rows), ["k"], ["d"], lambda df: {"bad": df.where("v > 50").count()})
        assert version is not None and failures == {"bad": 0}
    want = [("a", 7, "x"), ("b", 1, "y"), ("n", 7, None), ("z", 7, "x")]
    assert rows_of(table.read()) == sorted(want, key=str)
    assert V.merge_into(table, frame(spark, [("a", 99, "x")]), ["k"], ["d"], lambda df: {"bad": df.where("v > 50").count()}) == (None, {"bad": 1})
    assert rows_of(table.read()) == sorted(want, key=str)


# -- history ----------------------------------------------------------------


def at(day, month=1):
    return dt.datetime(2024, month, day)


DIM = "vehicle_id string, vin string, last_seen_at timestamp_ntz"


def test_history_equals_scd2_and_closed_versions_are_written_once(spark, tmp_dir):
    history = History(spark, tmp_dir, "vehicle_id")
    whole = None
    rng = random.Random(1)
    closed_files = set()
    for month in range(1, 7):
        state = spark.createDataFrame([(f"v{i}", f"{i}-{month}", at(rng.randrange(1, 28), month)) for i in range(20) if rng.random() < 0.7], DIM)
        version = history.run(state, updated_at="last_seen_at")
        whole = scd2(whole, state, "vehicle_id", updated_at="last_seen_at").checkpoint()
        now = {e.path for e in version.entries if not e.partition.endswith(f"={OPEN}")}
        assert closed_files <= now
        closed_files = now
    assert rows_of(history.read().select(*whole.columns)) == rows_of(whole)
    for t in ("2024-02-15 00:00:00", "2024-06-01 00:00:00", "2025-01-01 00:00:00"):
        assert rows_of(history.at(t).select(*whole.columns)) == rows_of(as_of(whole, t))
    plan = history.table.read().where(F.col("closed_in") >= "2024-05")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "closed_in" in plan.split("PartitionFilters")[1][:200]


def test_bytes_of_a_run_do_not_depend_on_closed_versions(spark, tmp_dir):
    history = History(spark, tmp_dir, "vehicle_id")
    sizes = []
    for month in range(1, 10):
        state = spark.createDataFrame([(f"v{i:04d}", "x", at(3, month)) for i in range(300)], DIM)
        before = {e.path for e in history.table.version().entries} if month > 1 else set()
        version = history.run(state, updated_at="last_seen_at")
        sizes.append(sum(e.size for e in version.entries if e.path not in before))
    assert max(sizes[1:]) < 1.2 * min(sizes[1:])


def test_version_without_a_time_closes(spark):
    one = scd2(None, spark.createDataFrame([("a", "1", None)], DIM), "vehicle_id", updated_at="last_seen_at")
    two = scd2(one, spark.createDataFrame([("a", "2", at(5))], DIM), "vehicle_id", updated_at="last_seen_at")
    assert rows_of(two.select("vin", "valid_from", "valid_to")) == rows_of(spark.createDataFrame([("1", None, at(5)), ("2", at(5), None)], "a string, b timestamp_ntz, c timestamp_ntz"))


# -- carry scan --------------------------------------------------------------


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_carry_equals_lag(spark, partitions):
    rng = random.Random(partitions)
    t = [None, *[at(d) for d in range(1, 6)]]
    rows = [(rng.choice(["hot", "hot", "hot", "a", "b", None]), rng.choice(t), f"m{i:04d}", rng.choice([None, float(rng.randrange(50))])) for i in range(700)]
    rows += [("stuck", at(1), f"s{i:04d}", float(i)) for i in range(700)] + [("one", at(1), "o", 1.0)]
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, id string, v double").repartition(5)
    got = carry_previous(df, "k", ["t", "id"], "v", "prev", partitions)
    assert got.columns == [*df.columns, "prev"]
    df.createOrReplaceTempView("carry_input")
    want = spark.sql("select *, lag(v) over (partition by k order by t nulls first, id) as prev from carry_input")
    assert rows_of(got) == rows_of(want)


def test_carry_splits_a_hot_key_and_a_stuck_clock(spark):
    rows = spark.range(90_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), (F.col("id") % 97).cast("string"))).alias("k"), F.lit(at(1)).alias("t"), F.col("id").alias("m"), F.col("id").cast("double").alias("v"))
    ordering = [F.col(c).asc_nulls_first() for c in ("k", "t", "m")]
    sizes = [r["count"] for r in rows.repartitionByRange(12, *ordering).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 12 and max(sizes) < 2 * sorted(sizes)[6]
    got = carry_previous(rows, "k", ["t", "m"], "v", "prev", 12)
    assert got.where("k = 'hot' and m > 0 and prev <> v - 3").count() == 0 and got.where("prev is null").count() == 98


def test_carry_of_nothing(spark):
    assert carry_previous(spark.createDataFrame([], "k string, t timestamp, id string, v double"), "k", ["t", "id"], "v", "prev").collect() == []
