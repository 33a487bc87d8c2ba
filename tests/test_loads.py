"""Interval joins, batches of event time, merges of moved keys, streams' seen ids, footers: edge cases and failures."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fleetspark.operators import incremental
from fleetspark.operators.intervals import versions_at
from fleetspark.operators.keyindex import IndexedTable
from fleetspark.operators.microbatch import DONE, FAILED, Microbatches
from fleetspark.sources.versioned import VersionedTable
from fleetspark.streaming.seen import FirstArrivals


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def at(day, hour=0):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=day - 1, hours=hour)


class Stop(Exception):
    pass


# -- interval join -----------------------------------------------------------


@pytest.mark.parametrize("hot", [10, 1_000_000])
def test_versions_at_equals_a_range_join(spark, hot):
    rng = random.Random(hot)
    key = lambda: rng.choice(["hot", "hot", "a", "b", "c", None])
    readings = [(i, key(), rng.choice([None, at(rng.randrange(1, 60), rng.randrange(24)) + dt.timedelta(microseconds=rng.randrange(3))])) for i in range(400)]
    versions = []
    for k in ("hot", "a", "b", None):
        start = at(rng.randrange(1, 10))
        for n in range(25):  # from seconds to years, ends included
            end = start + rng.choice([dt.timedelta(seconds=5), dt.timedelta(hours=7), dt.timedelta(days=9), dt.timedelta(days=4000)])
            versions.append((k, f"{k}{n}", start, None if n == 24 else end))
            start = end if n != 3 else start
    versions += [("a", "ever", None, at(3)), ("b", "empty", at(4), at(4))]
    r = spark.createDataFrame(readings, "id long, k string, t timestamp_ntz").repartition(3)
    h = spark.createDataFrame(versions, "k string, name string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    r.createOrReplaceTempView("r")
    h.createOrReplaceTempView("h")
    on = "h.k = r.k and (h.valid_from is null or h.valid_from <= r.t) and (h.valid_to is null or r.t < h.valid_to) and r.t is not null"
    for how in ("left", "inner"):
        want = spark.sql(f"select r.*, h.name from r {how} join h on {on}")
        assert rows_of(versions_at(r, h, "k", "t", ["name"], how=how, hot=hot, salts=4)) == rows_of(want)


def test_versions_at_of_nothing(spark):
    r = spark.createDataFrame([(1, "a", at(1))], "id long, k string, t timestamp")
    h = spark.createDataFrame([], "k string, name string, valid_from timestamp, valid_to timestamp")
    assert rows_of(versions_at(r, h, "k", "t", ["name"])) == rows_of(r.withColumn("name", F.lit(None)))
    assert versions_at(r.limit(0), h, "k", "t", ["name"]).collect() == []


# -- batches of event time ----------------------------------------------------


def test_ledger_states_lookback_and_single_reruns(spark, tmp_dir):
    source = lambda rows: spark.createDataFrame(rows, "id long, t timestamp_ntz")
    load = Microbatches(spark, tmp_dir, "t", at(1), dt.timedelta(days=1), lookback=1)

    def refuse(day):
        def transform(part):
            if part.where(F.col("t") >= at(day)).where(F.col("t") < at(day + 1)).count():
                raise Stop("no")
            return part

        return transform

    first = [(1, at(1)), (2, at(2)), (3, at(3)), (9, None)]
    assert list(load.run(source(first), refuse(1), at(4)).values()) == [FAILED, DONE, DONE]
    assert rows_of(load.read()) == [(2, at(2)), (3, at(3))]
    states = {r.batch_start[:10]: (r.state, r.attempts, r.rows, r.error) for r in load.ledger().collect()}
    assert states == {"2024-01-01": (FAILED, 1, 0, "no"), "2024-01-02": (DONE, 1, 1, None), "2024-01-03": (DONE, 1, 1, None)}
    # The failed one and the newest done one are due; a late row of day 2 is beyond the lookback, one of day 3 is not.
    late = [*first, (4, at(2, 5)), (5, at(3, 5)), (6, at(4))]
    assert [b.day for b in load.due(at(5))] == [1, 3, 4]
    load.run(source(late), lambda p: p, at(5))
    assert rows_of(load.read()) == sorted([(1, at(1)), (2, at(2)), (3, at(3)), (5, at(3, 5)), (6, at(4))], key=str)
    assert load.run(source(late), lambda p: p, at(5), only=[at(2)]) == {"2024-01-02 00-00-00": DONE}
    assert rows_of(load.read()) == rows_of(source(late).where("t is not null"))
    # A batch that has lost all its rows ends empty.
    load.run(source([]), lambda p: p, at(5), only=[at(1)])
    assert 1 not in {r.id for r in load.read().collect()}


def test_a_run_that_dies_leaves_rows_and_ledger_alike(spark, tmp_dir, monkeypatch):
    source = spark.createDataFrame([(1, at(1)), (2, at(2))], "id long, t timestamp_ntz")
    load = Microbatches(spark, tmp_dir, "t", at(1), lookback=0)
    load.run(source, lambda p: p, at(2))

    def dies(*a, **k):
        raise KeyboardInterrupt

    monkeypatch.setattr(VersionedTable, "put", dies)
    with pytest.raises(KeyboardInterrupt):
        load.run(source, lambda p: p, at(3))
    monkeypatch.undo()
    assert rows_of(load.read()) == [(1, at(1))] and load.ledger().count() == 1
    load.run(source, lambda p: p, at(3))
    assert load.read().count() == 2


# -- merge by key index -------------------------------------------------------


def test_merge_finds_old_copies_and_reads_few_files(spark, tmp_dir):
    rng = random.Random(2)
    table = IndexedTable(spark, tmp_dir, ["k"], ["day"], buckets=4)
    frame = lambda rows: spark.createDataFrame(rows, "k long, day string, v long")
    want = {}
    reports = []
    for turn in range(6):
        keys = range(200) if not turn else rng.sample(range(230), 6)
        rows = [(k, f"d {(k if not turn else rng.randrange(20)) % 20}%", turn) for k in keys]
        want |= {r[0]: r for r in rows}
        reports.append(table.merge(frame(rows)))
        assert rows_of(table.read()) == sorted(want.values(), key=str)
    assert all(len(r["files_read"]) <= 6 < r["files"] for r in reports[1:])


def test_index_catches_up_after_a_merge_that_died(spark, tmp_dir, monkeypatch):
    table = IndexedTable(spark, tmp_dir, ["k"], ["day"], buckets=2)
    frame = lambda rows: spark.createDataFrame(rows, "k string, day string, v long")
    table.merge(frame([("a", "x", 1), ("b", "x", 1), (None, "y", 1)]))
    calls = []

    def dies(self):
        calls.append(1)
        if len(calls) == 2:
            raise Stop
        return original(self)

    original = IndexedTable._catch_up
    monkeypatch.setattr(IndexedTable, "_catch_up", dies)
    with pytest.raises(Stop):
        table.merge(frame([("a", "z", 2)]))
    monkeypatch.undo()
    table.merge(frame([("a", "y", 3), (None, "x", 3)]))
    assert rows_of(table.read()) == sorted([("a", "y", 3), ("b", "x", 1), (None, "x", 3)], key=str)


def test_index_buckets_are_thinned(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr("fleetspark.operators.keyindex.MOST_FILES", 2)
    table = IndexedTable(spark, tmp_dir, ["k"], ["day"], buckets=1)
    for turn in range(5):
        table.merge(spark.createDataFrame([("a", f"d{turn}", turn), (f"n{turn}", "d0", turn)], "k string, day string, v int"))
    assert len(table.index.version().entries) <= 3
    assert {r.k: r.day for r in table.read().collect()} == {"a": "d4", **{f"n{t}": "d0" for t in range(5)}}


# -- ids seen by a stream -----------------------------------------------------

ARRIVAL = "message_id string, kafka_partition int, kafka_offset long, ingested_at timestamp"


def test_repeated_and_interrupted_batches_write_nothing_twice(spark, tmp_dir, monkeypatch):
    out = FirstArrivals(spark, tmp_dir, buckets=2)
    batch = lambda *ids: spark.createDataFrame([(i, 0, n, at(1, n)) for n, i in enumerate(ids)], ARRIVAL)
    out.take(batch("a", "b", "a", None), 0)
    out.take(batch("a", "b"), 0)  # the same batch again
    monkeypatch.setattr(FirstArrivals, "_thin", lambda self: (_ for _ in ()).throw(Stop()))
    original = VersionedTable.append

    def dies(self, df, *a, **k):
        if self.path.endswith("seen"):
            raise Stop
        return original(self, df, *a, **k)

    monkeypatch.setattr(VersionedTable, "append", dies)
    with pytest.raises(Stop):
        out.take(batch("c", "a"), 1)  # rows are out, their ids not yet noted
    monkeypatch.undo()
    out.take(batch("c", "a"), 1)
    out.take(batch("c", "d", "b", None), 2)
    assert sorted((r.message_id for r in out.read().collect()), key=str) == sorted(["a", "b", None, "c", "d"], key=str)


def test_seen_buckets_are_thinned(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr("fleetspark.streaming.seen.MOST_FILES", 2)
    out = FirstArrivals(spark, tmp_dir, buckets=1)
    for n in range(5):
        out.take(spark.createDataFrame([(f"m{n}", 0, n, at(1)), ("m0", 0, n, at(2))], ARRIVAL), n)
    assert len(out.seen.version().entries) <= 3 and out.read().count() == 5


# -- footers -------------------------------------------------------------------


def test_watermarks_come_from_footers(spark, tmp_dir):
    table = VersionedTable(spark, tmp_dir)
    frame = lambda rows: spark.createDataFrame(rows, "kafka_partition int, kafka_offset long, day string")
    assert incremental.footer_watermarks(table).collect() == []
    table.append(frame([(0, 5, "a"), (1, 7, "a"), (None, 3, "b")]), ["kafka_partition"])
    table.append(frame([(0, 4, "b"), (0, None, "b")]), ["kafka_partition"])
    marks = incremental.footer_watermarks(table)
    assert rows_of(marks) == sorted([(0, 5), (1, 7), (None, 3)], key=str)
    with incremental.settings(spark, **{"spark.sql.sources.useV1SourceList": incremental.V1_SOURCES, "spark.sql.parquet.aggregatePushdown": "true"}):
        plan = incremental.footer_maxima(table, table.version(), "kafka_offset")._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MAX(kafka_offset)]" in plan
    new = incremental.new_since(frame([(0, 5, "c"), (0, 6, "c"), (7, 0, "c")]), None, watermarks=marks)
    assert rows_of(new.select("kafka_partition", "kafka_offset")) == [(0, 6), (7, 0)]
    with pytest.raises(ValueError):
        incremental.footer_watermarks(table, "day")
    # A file whose offsets are all null has no statistics; the column is read then.
    table.append(frame([(2, None, "b")]), ["kafka_partition"])
    assert rows_of(incremental.footer_watermarks(table)) == sorted([(0, 5), (1, 7), (2, None), (None, 3)], key=str)
