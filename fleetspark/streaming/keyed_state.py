"""Streaming operators that keep state per key with ``transformWithState``.

* ``changes`` / ``ChangeLog`` (S10): the newest value or tombstone per key is
  state, so a replay or a late record never brings back what it has replaced;
  only real changes come out. They are appended to a log and folded into a
  bucketed table now and then.
* ``stream_steps`` (S8, S9): distance per reading for input that is out of order
  within the watermark. State is the recent places of a vehicle's readings; a
  reading that slips between two earlier ones comes out with a correction of the
  later one's distance, so sums over the stream equal the batch ``lag``.
* ``daily_fact`` / ``chart_fact`` (S8): all measures of the batch facts over those
  steps, in append mode; a day comes out once, when the watermark has passed it.
* ``stream_rates`` (E4, S12): rates over the trailing window of each sample from
  a ring of samples per group, in a list state that holds one window.

State lives in RocksDB, so it is bounded by disk, not by an executor's memory.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from fleetspark.operators.marts import min_tire_pressure
from fleetspark.session import settings
from fleetspark.sources.versioned import Version, VersionedTable

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
IDLE = "spark.sql.streaming.noDataMicroBatches.enabled"


def start(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, interval: str | None = None, idle_batches: bool = True) -> StreamingQuery:
    """Starts a stream that hands each micro-batch to ``write``; without ``interval`` it ends when what is there is done.

    Batches without new data let a watermark pass. State that ages by the clock
    would ask for one after another, so such a stream does without them.
    """
    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    with settings(df.sparkSession, **{PROVIDER: ROCKSDB, IDLE: str(idle_batches).lower()}):
        return writer.start()


def append_once(table: VersionedTable, batch: DataFrame, batch_id: int, partition_by: tuple[str, ...] = ()) -> Version | None:
    """Appends a micro-batch; one that the table has already taken in (a retry after a lost commit) is left out."""
    now = table.version()
    if now is not None and now.notes.get("batch", -1) >= batch_id:
        return None
    return table.append(batch, partition_by, base=now.number if now else 0, notes={"batch": batch_id})


# -- compacted changelog (S10) --------------------------------------------


class _Newest(StatefulProcessor):
    """Lets a record through if its offset is above all that its key has seen."""

    def __init__(self, value: T.StructField, tombstone_ms: int):
        self.value, self.tombstone_ms = value, tombstone_ms

    def init(self, handle) -> None:
        offset = T.StructField("offset", T.LongType())
        self.live = handle.getValueState("live", T.StructType([offset, T.StructField("value", self.value.dataType)]))
        self.gone = handle.getValueState("gone", T.StructType([offset]), self.tombstone_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        newest = max(rows, key=lambda r: r["offset"])
        seen = [s.get()[0] for s in (self.live, self.gone) if s.exists()]
        if seen and newest["offset"] <= max(seen):
            return
        if newest["value"] is None:
            self.live.clear()
            self.gone.update((newest["offset"],))
        else:
            self.live.update((newest["offset"], newest["value"]))
            self.gone.clear()
        yield Row(key=key[0], value=newest["value"], offset=newest["offset"])

    def close(self) -> None:
        pass


def _newest_in_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One record per key of each batch, so that a key with very many records sends few of them on."""
    for batch in batches:
        key = pc.dictionary_encode(batch.column("key")).indices.to_numpy()
        order = np.lexsort((batch.column("offset").to_numpy(), key))
        last = np.flatnonzero(np.append(key[order][1:] != key[order][:-1], True)) if len(order) else order
        yield batch.take(pa.array(order[last]))


def changes(changelog: DataFrame, key: str = "key", value: str = "value", offset: str = "offset", tombstone_ttl: str = "7 days") -> DataFrame:
    """Changes of a compacted changelog: key, value (null: deleted), offset, each newer than what its key had.

    Records may come again or late; null keys are ignored. A deleted key is
    remembered for ``tombstone_ttl``: a record older than the deletion that comes
    later than that counts as new.
    """
    rows = changelog.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.col(value).alias("value"), F.col(offset).cast("bigint").alias("offset"))
    rows = rows.where("offset is not null")
    field = rows.schema["value"]
    ttl = pd.Timedelta(tombstone_ttl).value // 1_000_000
    newest = rows.mapInArrow(_newest_in_batch, rows.schema).groupBy("key")
    return newest.transformWithState(_Newest(field, ttl), rows.schema, "Update", "ProcessingTime")


class ChangeLog:
    """The stored state of a changelog: a log of changes and a table, bucketed by key, that it is folded into.

    ``read`` takes the newest of both by key. ``compact`` folds what the log holds
    into the buckets it touches, puts them, and then drops those files from the
    log; a run that dies in between folds them again, which changes nothing.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.log = VersionedTable(spark, f"{path}/log")
        self.table = VersionedTable(spark, f"{path}/table")
        self.buckets = buckets

    def start(self, changelog: DataFrame, checkpoint: str, interval: str | None = None, **options) -> StreamingQuery:
        """Follows a changelog stream; see ``changes`` for the options."""

        def write(batch: DataFrame, batch_id: int) -> None:
            append_once(self.log, batch, batch_id)

        return start(changes(changelog, **options), write, checkpoint, interval, idle_batches=False)

    def _newest(self, rows: DataFrame) -> DataFrame:
        latest = rows.groupBy("key").agg(F.max_by(F.struct("value"), "offset").alias("latest"), F.max("offset").alias("offset"))
        return latest.select("key", F.col("latest.value").alias("value"), "offset")

    def read(self) -> DataFrame:
        """Key, value and offset of every key that is not deleted."""
        stored, new = self.table.read_or_none(), self.log.read_or_none()
        if new is None:
            raise FileNotFoundError(f"{self.log.path} has no version")
        both = new if stored is None else new.unionByName(stored.drop("bucket"))
        return self._newest(both).where("value is not null")

    def compact(self, keep: int = 2) -> None:
        log, base = self.log.version(), self.table.version()
        if log is None or not log.entries:
            return
        bucket = F.pmod(F.xxhash64("key"), F.lit(self.buckets)).cast("int")
        rows = self.log.rows(log.schema, log.entries).withColumn("bucket", bucket)
        touched = sorted(r.bucket for r in rows.select("bucket").distinct().collect())
        if base is not None:
            rows = rows.unionByName(self.table.rows(base.schema, base.entries).where(F.col("bucket").isin(touched)))
        live = self._newest(rows).where("value is not null").withColumn("bucket", bucket)
        self.table.replace_partitions(live, ["bucket"], base=base.number if base else 0, emptied=[f"bucket={b}" for b in touched])
        folded = {e.path for e in log.entries}
        now = self.log.version()
        self.log.put(now.number, now.schema, now.partition_by, [e for e in now.entries if e.path not in folded], "drop folded", now.notes)
        self.log.expire(keep)
        self.table.expire(keep)


# -- distance and facts over event time (S8, S9) --------------------------

STEP_INPUTS = ("vehicle_id", "recorded_at", "message_id", "odometer_km")
RECENT = "times binary, ids binary, odometers binary, vehicles binary, vehicle_ids binary"
#: Vehicles are dealt over so many groups; a checkpoint keeps the number it began with.
BUCKETS = 512


def bucket_of(key: str, buckets: int) -> Column:
    """The group of a key: many keys share a call of a stateful function, its state and its output batch."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _rule(step: np.ndarray, lower: float, upper: float) -> np.ndarray:
    return np.where((step >= lower) & (step <= upper), step, 0.0)


def _packed(values: np.ndarray) -> bytes:
    return json.dumps(values.tolist()).encode()


def _unpacked(data: bytes) -> np.ndarray:
    values = json.loads(bytes(data))
    out = np.empty(len(values), object)
    out[:] = values
    return out


class _Steps(StatefulProcessor):
    """Distance of each reading to its vehicle's one before it by (time, id), and corrections of distances already given.

    A group is a bucket of vehicles. Its state is the recent readings of all of
    them, ordered by vehicle, time and id.
    """

    def __init__(self, names: list[str], lower: float, upper: float):
        self.names, self.lower, self.upper = names, lower, upper

    def init(self, handle) -> None:
        self.recent = handle.getValueState("recent", RECENT)

    def _before(self) -> tuple[np.ndarray, ...]:
        held = self.recent.get()
        if held is None:
            return np.zeros(0, object), np.zeros(0, "int64"), np.zeros(0, object), np.zeros(0)
        times, ids, odometers, vehicles, vehicle_ids = held
        return _unpacked(vehicle_ids)[np.frombuffer(vehicles, "int32")], np.frombuffer(times, "int64"), _unpacked(ids), np.frombuffer(odometers, "float64")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows), ignore_index=True)
        old_v, old_t, old_i, old_o = self._before()
        new_t = new["recorded_at"].astype("datetime64[us]").astype("int64").to_numpy()
        new_v, new_i, new_o = new["vehicle_id"].astype(object).to_numpy(), new["message_id"].astype(object).to_numpy(), new["odometer_km"].astype("float64").to_numpy()
        t, i, o = np.concatenate([old_t, new_t]), np.concatenate([old_i, new_i]), np.concatenate([old_o, new_o])
        v, vehicle_ids = pd.factorize(np.concatenate([old_v, new_v]), use_na_sentinel=False)
        place = np.concatenate([np.full(len(old_t), -1), np.arange(len(new_t))])
        order = pd.DataFrame({"v": v, "t": t, "i": i}).sort_values(["v", "t", "i"], kind="mergesort").index.to_numpy()
        v, t, i, o, place = v[order], t[order], i[order], o[order], place[order]
        first = np.concatenate([[True], v[1:] != v[:-1]])
        previous = np.where(first, np.nan, np.concatenate([[np.nan], o[:-1]]))
        step = _rule(o - previous, self.lower, self.upper)
        fresh = place >= 0
        out = new.iloc[place[fresh]].assign(previous_odometer_km=previous[fresh], distance_km=step[fresh], is_reading=1)
        columns = [*self.names, "previous_odometer_km", "distance_km", "is_reading"]
        # Nothing older than the watermark can still come: of that only each vehicle's newest reading is needed.
        passed = t < timerValues.getCurrentWatermarkInMs() * 1000
        keep = ~(passed & np.concatenate([passed[1:] & ~first[1:], [False]]))
        codes, known = pd.factorize(v[keep])
        self.recent.update((t[keep].tobytes(), _packed(i[keep]), o[keep].tobytes(), codes.astype("int32").tobytes(), _packed(vehicle_ids[known])))
        yield out[columns]
        # Readings given before whose reading before is now another one.
        at = np.flatnonzero(~fresh & ~first & np.concatenate([[False], fresh[:-1]]))
        if len(at):
            # Their reading before was the last one held before the new ones in between; none if those came first.
            held = np.where(fresh, -1, np.arange(len(t)))
            last = np.concatenate([[-1], np.maximum.accumulate(held)[:-1]])[at]
            was = np.where((last >= 0) & (v[last] == v[at]), o[last], np.nan)
            change = step[at] - _rule(o[at] - was, self.lower, self.upper)
            blank = pd.DataFrame({n: pd.Series([None] * len(at), dtype=object) for n in self.names})
            fix = blank.assign(vehicle_id=vehicle_ids[v[at]], recorded_at=pd.to_datetime(t[at], unit="us"), message_id=i[at], odometer_km=o[at], previous_odometer_km=previous[at], distance_km=change, is_reading=0)
            yield fix[columns]

    def close(self) -> None:
        pass


def stream_steps(readings: DataFrame, delay: str = "1 day", lower: float = 0, upper: float = 1, buckets: int = BUCKETS) -> DataFrame:
    """Readings with previous odometer and distance (``is_reading`` 1), and corrections of earlier distances (0).

    ``readings`` has vehicle_id, recorded_at, message_id, odometer_km and numeric
    measures; one row per message. Within ``delay`` the order of arrival does not
    matter: the sums of ``distance_km`` by reading time equal those of the batch.
    A correction has the id and time of the reading it corrects and nulls for
    measures. Later rows are dropped by the watermark (see ``late_rows``), rows
    without a time too; a missing id counts as an empty one. State is 20 bytes and
    the id of each reading of the last ``delay``, and one reading per vehicle; it
    is kept and handled by ``buckets`` groups of vehicles, as a call and an output
    batch per vehicle cost more than its readings do. A task holds one group's
    rows of one micro-batch, which the trigger's limits bound.
    """
    timed = readings.withColumn("recorded_at", F.col("recorded_at").cast("timestamp")).withColumn("message_id", F.coalesce("message_id", F.lit("")))
    timed = timed.where("recorded_at is not null").withWatermark("recorded_at", delay)
    out = T.StructType([*timed.schema.fields, T.StructField("previous_odometer_km", T.DoubleType()), T.StructField("distance_km", T.DoubleType()), T.StructField("is_reading", T.IntegerType())])
    out = T.StructType([T.StructField(f.name, f.dataType) for f in out.fields])
    steps = _Steps(timed.columns, lower, upper)
    grouped = timed.withColumn("_bucket", bucket_of("vehicle_id", buckets)).groupBy("_bucket")
    return grouped.transformWithStateInPandas(steps, out, "Append", "EventTime", eventTimeColumnName="recorded_at")


def fact_measures(readings: DataFrame) -> DataFrame:
    """What the daily fact needs of flat readings, as numbers."""
    has = lambda e: F.coalesce(F.array_contains("events", e), F.lit(False)).cast("int")
    return readings.select(
        *STEP_INPUTS, "speed_kmh", "engine_temp_c", "fuel_level_pct", "battery_voltage", min_tire_pressure().alias("tire_kpa"),
        has("harsh_braking").alias("braking"), has("harsh_acceleration").alias("acceleration"), has("speeding").alias("speeding"), has("engine_overheating").alias("overheating"),
        F.coalesce(F.col("check_engine_light"), F.lit(False)).cast("int").alias("light"),
    )


def daily_fact(steps: DataFrame) -> DataFrame:
    """The daily fact (D2) over ``stream_steps``: all 17 measures, out once per vehicle and day."""
    own = lambda c: F.when(F.col("is_reading") == 1, c)
    day = F.window("recorded_at", "1 day")
    speed = own(F.col("speed_kmh"))
    agg = steps.groupBy("vehicle_id", day.alias("day")).agg(
        F.sum("is_reading").alias("reading_count"),
        F.min(own(F.col("recorded_at"))).alias("first_reading_at"),
        F.max(own(F.col("recorded_at"))).alias("last_reading_at"),
        F.sum("distance_km").alias("distance_km"),
        F.avg(speed).alias("avg_speed_kmh"),
        F.max(speed).alias("max_speed_kmh"),
        F.avg(F.when(speed > 1, speed)).alias("avg_moving_speed_kmh"),
        F.avg(own(F.col("engine_temp_c"))).alias("avg_engine_temp_c"),
        F.max(own(F.col("engine_temp_c"))).alias("max_engine_temp_c"),
        F.min(own(F.col("fuel_level_pct"))).alias("min_fuel_level_pct"),
        F.min(own(F.col("battery_voltage"))).alias("min_battery_voltage"),
        F.min(own(F.col("tire_kpa"))).alias("min_tire_pressure_kpa"),
        F.sum("braking").alias("harsh_braking_count"),
        F.sum("acceleration").alias("harsh_acceleration_count"),
        F.sum("speeding").alias("speeding_readings"),
        F.sum("overheating").alias("overheating_readings"),
        F.max("light").alias("_light"),
    )
    rest = [c for c in agg.columns if c not in ("vehicle_id", "day", "_light")]
    return agg.select("vehicle_id", F.to_date("day.start").alias("event_date"), *rest, (F.col("_light") == 1).alias("had_check_engine_light"))


def chart_fact(readings: DataFrame, measure: str = "speed_kmh", interval: str = "15 minutes", delay: str = "1 day") -> DataFrame:
    """The time chart (D10) as a stream: average and maximum of a measure per vehicle and interval, out once."""
    timed = readings.withColumn("recorded_at", F.col("recorded_at").cast("timestamp")).withWatermark("recorded_at", delay)
    agg = timed.groupBy("vehicle_id", F.window("recorded_at", interval).alias("w")).agg(
        F.avg(measure).alias(f"avg_{measure}"), F.max(measure).alias(f"max_{measure}"), F.count(F.lit(1)).alias("reading_count")
    )
    return agg.select("vehicle_id", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), f"avg_{measure}", f"max_{measure}", "reading_count")


LATE = "query_id string, batch_id bigint, operator string, late_rows bigint"


def late_rows(query: StreamingQuery, spark: SparkSession) -> DataFrame:
    """How many rows each micro-batch lost to the watermark, by operator: the side table of late data."""
    rows = []
    for progress in query.recentProgress:
        for op in progress["stateOperators"]:
            if op["numRowsDroppedByWatermark"]:
                rows.append((progress["id"], progress["batchId"], op["operatorName"], op["numRowsDroppedByWatermark"]))
    return spark.createDataFrame(rows, LATE)


# -- rates over a ring of samples (E4, S12) -------------------------------


class _Rates(StatefulProcessor):
    def __init__(self, t: str, values: list[str], seconds: int, ttl_ms: int):
        self.t, self.values, self.seconds, self.ttl_ms = t, values, seconds, ttl_ms

    def init(self, handle) -> None:
        fields = [T.StructField("t", T.DoubleType()), *[T.StructField(f"v{n}", T.DoubleType()) for n in range(len(self.values))]]
        self.ring = handle.getListState("ring", T.StructType(fields), self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows), ignore_index=True).sort_values(self.t, kind="mergesort", ignore_index=True)
        held = [tuple(r) for r in self.ring.get()] if self.ring.exists() else []
        first = len(held)
        samples = np.array(held + [tuple(r) for r in new[[self.t, *self.values]].astype("float64").to_numpy()])
        samples = samples[np.argsort(samples[:, 0], kind="stable")] if first and len(new) and samples[first, 0] < samples[first - 1, 0] else samples
        t = samples[:, 0]
        own = new[self.t].to_numpy("float64")
        at = np.searchsorted(t, own, "right") - 1
        begin = np.searchsorted(t, own - self.seconds, "left")
        elapsed = t[at] - t[begin]
        out = new[[new.columns[0]]].assign(**{self.t: new[self.t]})
        for n, name in enumerate(self.values, 1):
            moved = samples[at, n] - samples[begin, n]
            out[f"{name}_rate"] = np.where(elapsed > 0, moved / np.where(elapsed > 0, elapsed, 1), 0.0)
        self.ring.put([tuple(map(float, r)) for r in samples[t >= t[-1] - self.seconds]])
        yield out

    def close(self) -> None:
        pass


def stream_rates(samples: DataFrame, values: list[str], key: str = "group_id", t: str = "t", window_seconds: int = 10, idle: str = "1 day") -> DataFrame:
    """Rate of change per second of each value over the trailing window of every sample (E4, S12), one row per sample.

    State per group is the samples of one window; a group that is silent for
    ``idle`` loses it. A sample that comes after later ones is rated among those
    the ring still holds.
    """
    rows = samples.select(key, t, *[F.col(v).cast("double").alias(v) for v in values])
    fields = [rows.schema[key], rows.schema[t], *[T.StructField(f"{v}_rate", T.DoubleType()) for v in values]]
    processor = _Rates(t, list(values), window_seconds, pd.Timedelta(idle).value // 1_000_000)
    return rows.groupBy(key).transformWithStateInPandas(processor, T.StructType(fields), "Update", "ProcessingTime")
