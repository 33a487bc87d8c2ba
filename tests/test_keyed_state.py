"""Streams with keyed state against the batch, fed in many small batches out of order."""

import datetime as dt
import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from fleetspark.sources.versioned import VersionedTable
from fleetspark.streaming import keyed_state as K


class Value:
    """A state variable in memory."""

    def __init__(self):
        self.held = None

    def exists(self):
        return self.held is not None

    def get(self):
        return self.held

    def update(self, value):
        self.held = value

    put = update

    def clear(self):
        self.held = None


class Handle:
    def __init__(self):
        self.states = {}

    def getValueState(self, name, *a):
        return self.states.setdefault(name, Value())

    getListState = getValueState


class Clock:
    def __init__(self, ms=-(1 << 40)):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def steps_of(rows):
    """Distances by plain lag: id -> (previous, distance)."""
    out, last = {}, None
    for t, i, o in sorted(rows):
        step = 0.0 if last is None else o - last
        out[i] = (last, step if 0 <= step <= 1 else 0.0)
        last = o
    return out


def test_steps_and_corrections_equal_lag_whatever_the_order():
    rng = random.Random(7)
    for case in range(60):
        base = dt.datetime(2024, 1, 1)
        rows = [(base + dt.timedelta(minutes=rng.randrange(40)), f"m{n}", rng.choice([n / 4, float(rng.randrange(5))])) for n in range(rng.randrange(1, 25))]
        # Arrival at most 10 minutes late; the watermark follows 10 minutes behind the newest time.
        arrival = sorted(rows, key=lambda r: r[0] + dt.timedelta(minutes=rng.random() * 10))
        processor, clock, handle = K._Steps(["vehicle_id", "recorded_at", "message_id", "odometer_km", "speed"], 0, 1), Clock(), Handle()
        processor.init(handle)
        got = []
        while arrival:
            n = rng.randrange(1, 6)
            part, arrival = arrival[:n], arrival[n:]
            frame = pd.DataFrame({"vehicle_id": "v", "recorded_at": pd.to_datetime([r[0] for r in part]), "message_id": [r[1] for r in part], "odometer_km": [r[2] for r in part], "speed": 1.0})
            cut = rng.randrange(len(part)) if len(part) > 1 else 0
            got.append(pd.concat(list(processor.handleInputRows(("v",), iter([x for x in (frame[:cut], frame[cut:]) if len(x)]), clock))))
            newest = max(r[0] for r in part)
            clock.ms = max(clock.ms, int((newest - dt.timedelta(minutes=10) - dt.datetime(1970, 1, 1)).total_seconds() * 1000) - 1)
        got = pd.concat(got)
        want = steps_of(rows)
        assert sorted(got[got.is_reading == 1].message_id) == sorted(i for _, i, _ in rows)
        total = got.groupby("message_id").distance_km.sum()
        assert all(abs(total[i] - want[i][1]) < 1e-9 for i in want)
        fixes = got[got.is_reading == 0]
        assert fixes.speed.isna().all()
        assert len(np.frombuffer(handle.states["recent"].get()[0], "int64")) <= len(rows)


def test_one_group_of_many_vehicles_equals_lag_per_vehicle():
    rng = random.Random(11)
    for case in range(20):
        base = dt.datetime(2024, 1, 1)
        rows = [(rng.choice(["a", "b", "a\x00b", None]), base + dt.timedelta(minutes=rng.randrange(30)), f"m{n}", float(rng.randrange(4))) for n in range(40)]
        processor, clock, handle = K._Steps(["vehicle_id", "recorded_at", "message_id", "odometer_km"], 0, 1), Clock(), Handle()
        processor.init(handle)
        arrival, got = sorted(rows, key=lambda r: r[1] + dt.timedelta(minutes=rng.random() * 10)), []
        for at in range(0, len(arrival), 9):
            part = arrival[at : at + 9]
            frame = pd.DataFrame(part, columns=["vehicle_id", "recorded_at", "message_id", "odometer_km"])
            got.extend(processor.handleInputRows((0,), iter([frame]), clock))
            newest = max(r[1] for r in arrival[: at + 9])
            clock.ms = int((newest - dt.timedelta(minutes=10) - dt.datetime(1970, 1, 1)).total_seconds() * 1000) - 1
        got = pd.concat([g.astype(object) for g in got])
        want = {i: x for v in {r[0] for r in rows} for i, x in steps_of([r[1:] for r in rows if r[0] == v]).items()}
        vehicle = {r[2]: r[0] for r in rows}
        total = got.groupby("message_id").distance_km.sum()
        assert len(want) == len(rows) and all(abs(total[i] - want[i][1]) < 1e-9 for i in want)
        assert all((v if isinstance(v, str) else None) == vehicle[i] for v, i in zip(got.vehicle_id, got.message_id))


def test_state_keeps_only_what_may_still_matter():
    processor, clock, handle = K._Steps(["vehicle_id", "recorded_at", "message_id", "odometer_km"], 0, 1), Clock(), Handle()
    processor.init(handle)
    base = pd.Timestamp("2024-01-01")
    for n in range(50):
        frame = pd.DataFrame({"vehicle_id": ["v"], "recorded_at": [base + pd.Timedelta(minutes=n)], "message_id": [f"m{n}"], "odometer_km": [n / 2]})
        list(processor.handleInputRows(("v",), iter([frame]), clock))
        clock.ms = int((base + pd.Timedelta(minutes=n - 3)).value // 1_000_000)
    assert len(np.frombuffer(handle.states["recent"].get()[0], "int64")) <= 6


def test_rates_ring_equals_window():
    rng = random.Random(5)
    samples = sorted((float(rng.randrange(300)), float(rng.randrange(1000))) for _ in range(120))
    processor, handle = K._Rates("t", ["produced"], 10, 1000), Handle()
    processor.init(handle)
    got, most = [], 0
    for at in range(0, len(samples), 7):
        part = samples[at : at + 7]
        frame = pd.DataFrame({"group_id": "g", "t": [s[0] for s in part], "produced": [s[1] for s in part]})
        got += [(r.t, r.produced_rate) for out in processor.handleInputRows(("g",), iter([frame]), Clock()) for r in out.itertuples()]
        most = max(most, len(handle.states["ring"].get()))
    distinct = {}
    for t, v in samples:
        distinct.setdefault(t, []).append(v)
    for t, rate in got:
        first = min(x for x in distinct if x >= t - 10)
        if first == t:
            assert rate == 0.0
        else:
            assert any(abs(rate - (b - a) / (t - first)) < 1e-9 for a in distinct[first] for b in distinct[t])
    assert len(got) == len(samples) and most <= 40


def write(spark, rows, schema, path):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def test_changelog_with_replays_and_late_tombstones(spark, tmp_dir):
    schema = "key string, value string, offset long"
    log = K.ChangeLog(spark, f"{tmp_dir}/log", buckets=2)
    batches = [
        [("a", "x", 1), ("b", "y", 2), ("c", "z", 3), (None, "w", 4), ("a", "x2", 5)],
        [("a", None, 8), ("b", "y", 2), ("d", "d", 9)],
        [("a", "x", 1), ("a", "x2", 5), ("c", None, 2), ("b", None, 10), ("d", "d", None)],
    ]
    for n, rows in enumerate(batches):
        write(spark, rows, schema, f"{tmp_dir}/in")
        log.start(spark.readStream.schema(schema).parquet(f"{tmp_dir}/in"), f"{tmp_dir}/ckpt").awaitTermination()
        if n < 2:
            log.compact()
            assert not log.log.version().entries
    assert sorted(tuple(r) for r in log.read().collect()) == [("c", "z", 3), ("d", "d", 9)]
    log.compact()
    assert sorted(tuple(r) for r in log.read().collect()) == [("c", "z", 3), ("d", "d", 9)]
    # The log has only real changes, and a batch taken in twice is appended once.
    assert log.log.version().notes["batch"] == 2 and K.append_once(log.log, spark.createDataFrame([("q", "q", 1)], schema), 2) is None


def test_late_rows_are_counted(spark, tmp_dir):
    schema = "vehicle_id string, recorded_at timestamp, speed_kmh double"
    t = lambda d: dt.datetime(2024, 1, d)
    table = VersionedTable(spark, f"{tmp_dir}/out")
    late = []
    for rows in ([("v", t(1), 1.0), ("v", t(9), 2.0)], [("v", t(2), 3.0), ("v", t(3), 3.0), ("v", t(9), 4.0)], [("v", t(20), 0.0)]):
        write(spark, rows, schema, f"{tmp_dir}/in")
        stream = spark.readStream.schema(schema).parquet(f"{tmp_dir}/in")
        query = K.start(K.chart_fact(stream, interval="1 day", delay="1 day"), lambda b, n: K.append_once(table, b, n) and None, f"{tmp_dir}/ckpt")
        query.awaitTermination()
        late += K.late_rows(query, spark).collect()
    assert sum(r.late_rows for r in late) == 2 and {r.query_id for r in late} == {query.id}
    got = {r.window_start.day: (r.reading_count, r.avg_speed_kmh) for r in table.read().collect()}
    assert got == {1: (1, 1.0), 9: (2, 3.0)}


def test_settings_come_back(spark):
    before = spark.conf.get(K.PROVIDER, None)
    try:
        with K.settings(spark, **{K.PROVIDER: K.ROCKSDB, "spark.sql.shuffle.partitions": "3"}):
            assert spark.conf.get(K.PROVIDER) == K.ROCKSDB and spark.range(9).groupBy(F.col("id") % 2).count().count() == 2
            raise KeyError
    except KeyError:
        pass
    assert spark.conf.get(K.PROVIDER, None) == before and spark.conf.get("spark.sql.shuffle.partitions") == "8"
