"""De-duplication of a stream over all time (S6): no watermark bounds how late a copy may come.

A table holds every id seen, dealt into buckets by the id's hash. A micro-batch
reads only the buckets its ids fall in, keeps the ids it does not find, appends
their rows to the output and then their ids to the table. In front stands the
usual state within a watermark, which takes away the many copies that come soon.

The output's manifest names the batch and its files. If a run dies before the ids
are noted, the repeated batch takes them from those files and writes nothing twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetspark.operators.staging import dedup_first
from fleetspark.sources.versioned import Entry, VersionedTable
from fleetspark.streaming.ingest import stream_dedup
from fleetspark.streaming.keyed_state import start

BUCKET = "bucket"
#: Files of a bucket from which it is rewritten as one.
MOST_FILES = 32


class FirstArrivals:
    """The first arrival of every id of a stream: ``rows`` is the output, ``seen`` the ids."""

    def __init__(self, spark: SparkSession, path: str, key: str = "message_id", buckets: int = 64):
        self.rows, self.seen = VersionedTable(spark, f"{path}/rows"), VersionedTable(spark, f"{path}/seen")
        self.key, self.buckets = key, buckets

    def read(self) -> DataFrame:
        return self.rows.read()

    def take(self, batch: DataFrame, batch_id: int) -> None:
        """Takes in a micro-batch (with kafka_partition, kafka_offset and ingested_at, by which its first copies are chosen)."""
        out = self.rows.version()
        if out is None or out.notes["batch"] < batch_id:
            first = dedup_first(batch, [self.key]).withColumn("_bucket", F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int"))
            seen = self.seen.version()
            if seen is not None:
                touched = {f"{BUCKET}={r[0]}" for r in first.select("_bucket").distinct().collect()}
                known = self.seen.rows(seen.schema, [e for e in seen.entries if e.partition in touched])
                known = known.select(F.col(self.key).alias("_known"), F.col(BUCKET).alias("_in"))
                first = first.join(known, (F.col("_bucket") == F.col("_in")) & F.col(self.key).eqNullSafe(F.col("_known")), "left_anti")
            written = self.rows.write(first.drop("_bucket"))
            notes = {"batch": batch_id, "files": [[e.path, e.size] for e in written.entries]}
            out = self.rows.append(written, base=out.number if out else 0, notes=notes)
        seen = self.seen.version()
        if seen is None or seen.notes["batch"] < batch_id:
            new = self.rows.rows(out.schema, [Entry(*f) for f in out.notes["files"]])
            ids = new.select(self.key).withColumn(BUCKET, F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int"))
            self.seen.append(ids, [BUCKET], base=seen.number if seen else 0, notes={"batch": batch_id})
            self._thin()
        self.rows.expire()
        self.seen.expire()

    def _thin(self) -> None:
        """Buckets of many small files become one file each."""
        now = self.seen.version()
        files: dict[str, list[Entry]] = {}
        for e in now.entries:
            files.setdefault(e.partition, []).append(e)
        many = [e for es in files.values() if len(es) > MOST_FILES for e in es]
        if many:
            self.seen.replace_files(self.seen.rows(now.schema, many), many, now.number, [BUCKET], notes=now.notes)

    def start(self, stream: DataFrame, checkpoint: str, delay: str = "1 hour", interval: str | None = None) -> StreamingQuery:
        """Follows a stream; copies within ``delay`` go in front, all others against the ids seen."""
        return start(stream_dedup(stream, self.key, delay=delay), self.take, checkpoint, interval)
