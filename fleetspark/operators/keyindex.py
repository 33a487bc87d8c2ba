"""Upsert by key into a versioned table whose rows may move to another partition.

An index tells for each key which file holds it. It is a table of its own, dealt
into buckets by the key's hash, to which every change of the table adds a row per
key written (key, file, version); the row of the highest version counts. A merge
looks its keys up in the buckets they fall in, rewrites just the files that hold
one of them, wherever they lie, and puts the new rows into their own partitions:
the old copy of a moved key goes with the file it was in.

The index notes the table version it covers. If a run dies between the two, the
next one reads the files that came since and goes on.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspark.sources.versioned import COMMIT, Entry, Version, VersionedTable, Written

BUCKET = "bucket"
#: Files of a bucket from which it is rewritten with one row per key.
MOST_FILES = 16


class IndexedTable:
    def __init__(self, spark: SparkSession, path: str, key: Sequence[str], partition_by: Sequence[str], buckets: int = 256):
        self.table, self.index = VersionedTable(spark, f"{path}/rows"), VersionedTable(spark, f"{path}/keys")
        self.key, self.partition_by, self.buckets = list(key), list(partition_by), buckets

    def read(self) -> DataFrame:
        return self.table.read()

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    def _same(self, left: DataFrame, right: DataFrame, mark: str) -> Column:
        return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"{mark}{k}"]) for k in self.key])

    def _catch_up(self) -> Version | None:
        """Takes the files that came since the index's version into it."""
        now, known = self.table.version(), self.index.version()
        if now is None:
            return None
        covered = known.notes["covers"] if known else 0
        if covered == now.number:
            return known
        before = {e.path for e in self.table.version(covered).entries} if covered in self.table.versions() else set()
        new = [e for e in now.entries if e.path not in before]
        # A file's name is a URI: what is escaped in it is read back.
        where = F.expr(f"url_decode(replace(regexp_extract(input_file_name(), '{COMMIT}=.*$', 0), '+', '%2B'))")
        rows = self.table.rows(now.schema, new).select(*self.key, where.alias("file")).withColumn("version", F.lit(now.number)).withColumn(BUCKET, self._bucket())
        known = self.index.append(rows, [BUCKET], base=known.number if known else 0, notes={"covers": now.number})
        return self._thin(known)

    def _thin(self, known: Version) -> Version:
        """Rewrites buckets of many files with the newest row of each key."""
        files: dict[str, list[Entry]] = {}
        for e in known.entries:
            files.setdefault(e.partition, []).append(e)
        long = [e for es in files.values() if len(es) > MOST_FILES for e in es]
        if not long:
            return known
        rows = self._newest(self.index.rows(known.schema, long)).withColumn(BUCKET, self._bucket())
        return self.index.replace_files(rows, long, known.number, [BUCKET], notes=known.notes)

    def _newest(self, rows: DataFrame) -> DataFrame:
        latest = rows.groupBy(*self.key).agg(F.max_by("file", "version").alias("file"), F.max("version").alias("version"))
        return latest.select(*self.key, "file", "version")

    def merge(self, source: DataFrame, keep: int = 2) -> dict:
        """Updates on key match, inserts otherwise; ``source`` has one row per key. Reports the files read, of how many."""
        known = self._catch_up()
        now = self.table.version()
        given = self.table.write(source, self.partition_by)
        rows = self.table.rows(given.schema, given.entries)
        keys = rows.select(*[F.col(k).alias(f"_{k}") for k in self.key])
        hit: set[str] = set()
        if known is not None:
            touched = {f"{BUCKET}={r[0]}" for r in rows.select(self._bucket()).distinct().collect()}
            looked_at = self._newest(self.index.rows(known.schema, [e for e in known.entries if e.partition in touched]))
            found = looked_at.join(keys, self._same(looked_at, keys, "_"), "left_semi")
            hit = {r.file for r in found.select("file").distinct().collect()}
        met = [e for e in now.entries if e.path in hit] if now else []
        both = given
        if met:
            old = self.table.rows(now.schema, met)
            kept = self.table.write(old.join(keys, self._same(old, keys, "_"), "left_anti"), self.partition_by)
            both = Written(given.schema, given.partition_by, kept.entries + given.entries, kept.folders + given.folders, given.metrics)
        version = self.table.replace_files(both, met, now.number if now else 0, self.partition_by)
        self._catch_up()
        self.table.expire(keep)
        self.index.expire(keep)
        return {"version": version.number, "files_read": sorted(e.path for e in met), "files": len(now.entries) if now else 0}
