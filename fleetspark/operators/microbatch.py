"""Loads in batches of event time, with a ledger of what is done (I4).

A table is filled interval by interval. Each interval is a partition of a
versioned table; the ledger, one entry per interval, travels in the manifest of
the version that the interval's load put, so rows and ledger change together: a
run that dies in an interval leaves both as they were before it. A failed
interval is noted and the others go on; the next run takes up failed and missing
intervals, and the last ``lookback`` done ones again, for rows that came late.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetspark.sources.versioned import VersionedTable

BATCH = "batch_start"
PENDING, DONE, FAILED = "pending", "done", "failed"


class Microbatches:
    def __init__(self, spark: SparkSession, path: str, time: str, begin: dt.datetime, size: dt.timedelta = dt.timedelta(days=1), lookback: int = 1):
        self.spark, self.table = spark, VersionedTable(spark, path)
        self.time, self.begin, self.size, self.lookback = time, begin, size, lookback

    def _notes(self) -> dict:
        version = self.table.version()
        return dict(version.notes.get("ledger", {})) if version else {}

    def ledger(self) -> DataFrame:
        """batch_start, state, attempts, rows and error of each interval."""
        rows = [(b, e["state"], e["attempts"], e["rows"], e["error"]) for b, e in sorted(self._notes().items())]
        return self.spark.createDataFrame(rows, f"{BATCH} string, state string, attempts int, rows bigint, error string")

    def read(self) -> DataFrame:
        return self.table.read().drop(BATCH)

    def due(self, until: dt.datetime) -> list[dt.datetime]:
        """Intervals to load, oldest first: those not done that begin before ``until``, and the newest done ones."""
        known, out, at = self._notes(), [], self.begin
        every = []
        while at < until:
            every.append(at)
            at += self.size
        done = [b for b in every if known.get(_name(b), {}).get("state") == DONE]
        again = set(done[len(done) - self.lookback :]) if self.lookback else set()
        out = [b for b in every if b in again or b not in done]
        return out

    def run(self, source: DataFrame, transform: Callable[[DataFrame], DataFrame], until: dt.datetime, only: Iterable[dt.datetime] | None = None) -> dict[str, str]:
        """Loads the intervals that are due (or just ``only``); the state of each that was tried."""
        tried = {}
        for begin in self.due(until) if only is None else sorted(only):
            name = _name(begin)
            entry = self._notes().get(name, {"attempts": 0})
            entry = {"state": PENDING, "attempts": entry["attempts"] + 1, "rows": 0, "error": None}
            try:
                inside = (F.col(self.time) >= F.lit(begin)) & (F.col(self.time) < F.lit(begin + self.size))
                written = self.table.write(transform(source.where(inside)).withColumn(BATCH, F.lit(name)), [BATCH])
                entry |= {"state": DONE, "rows": int(written.metrics["rows"])}
                gone = [f"{BATCH}={name}"]
                self.table.replace_partitions(written, [BATCH], emptied=gone, retries=0, notes={"ledger": self._notes() | {name: entry}})
            except Exception as e:  # noqa: BLE001  one interval's failure is noted and the others go on
                entry |= {"state": FAILED, "rows": 0, "error": str(e).split("\n")[0][:500]}
                self._note(name, entry)
            tried[name] = entry["state"]
        self.table.expire()
        return tried

    def _note(self, name: str, entry: dict) -> None:
        now = self.table.version()
        number, schema, parts, files = (now.number, now.schema, now.partition_by, now.entries) if now else (0, T.StructType([]), (), ())
        self.table.put(number, schema, parts, files, "ledger", {"ledger": self._notes() | {name: entry}})


def _name(begin: dt.datetime) -> str:
    return begin.strftime("%Y-%m-%d %H-%M-%S")
