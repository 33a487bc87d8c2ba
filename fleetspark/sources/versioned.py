"""Tables published by version: data folders that never change and a manifest per version.

A publisher writes its rows into a folder of its own and then puts one small
manifest that lists the files of the new version. The manifest of version n + 1
can be put only once, so of two publishers that started from version n one wins
and the other gets a ``Conflict``; nothing else is ever overwritten. A reader
resolves the newest manifest and reads just its files: whatever step a publisher
dies in, the last version stays readable, and a reader that has begun goes on
reading its version until ``expire`` removes it.

    table/table_commit_id=<id>/<partition folders>/part-*.parquet
    table/_versions/000000000001.json

Files carry over from version to version by name: appending, replacing some
partitions or dropping files writes no file again. The manifest has a line per
file, so its size is that of a file listing.

The put needs a file system on which creating a name that exists fails: a hard
link locally, a rename without overwrite (HDFS and alike) elsewhere.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMMIT = "table_commit_id"
VERSIONS = "_versions"


class Conflict(Exception):
    """Another publisher has put this version."""


@dataclass(frozen=True)
class Entry:
    """A file of a version: its path below the table, its size, and what the writer noted about it."""

    path: str
    size: int
    notes: dict = field(default_factory=dict, hash=False, compare=False)

    @property
    def commit(self) -> str:
        return self.path.split("/", 1)[0]

    @property
    def partition(self) -> str:
        """The partition folders between the commit's folder and the file."""
        return "/".join(self.path.split("/")[1:-1])


@dataclass(frozen=True)
class Version:
    number: int
    schema: T.StructType
    partition_by: tuple[str, ...]
    operation: str
    at: float
    entries: tuple[Entry, ...]
    notes: dict

    def text(self) -> str:
        head = {"version": self.number, "schema": self.schema.jsonValue(), "partition_by": list(self.partition_by), "operation": self.operation, "at": self.at, "notes": self.notes}
        return "\n".join([json.dumps(head), *[json.dumps([e.path, e.size, e.notes]) for e in self.entries]])

    @staticmethod
    def parse(text: str) -> Version:
        first, *rest = text.split("\n")
        head = json.loads(first)
        entries = tuple(Entry(*json.loads(line)) for line in rest)
        return Version(head["version"], T.StructType.fromJson(head["schema"]), tuple(head["partition_by"]), head["operation"], head["at"], entries, head["notes"])


@dataclass(frozen=True)
class Written:
    """Rows written into a folder of their own, not yet part of any version."""

    schema: T.StructType
    partition_by: tuple[str, ...]
    entries: tuple[Entry, ...]
    folders: tuple[str, ...]
    metrics: dict


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._fs = self._path().getFileSystem(spark._jsc.hadoopConfiguration())

    # -- files ------------------------------------------------------------

    def _path(self, *below: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *below]))

    def _names(self, *below: str) -> list:
        """File states in a folder; none if it does not exist."""
        folder = self._path(*below)
        return list(self._fs.listStatus(folder)) if self._fs.exists(folder) else []

    def _text(self, *below: str) -> str:
        stream = self._fs.open(self._path(*below))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _put_if_absent(self, text: str, *below: str) -> bool:
        """Puts a file unless there is one of that name; readers see it whole or not at all."""
        final = self._path(*below)
        draft = self._path(*below[:-1], f".{uuid.uuid4().hex}")
        stream = self._fs.create(draft, False)
        stream.write(bytearray(text.encode("utf-8")))
        stream.close()
        try:
            if self._fs.getScheme() == "file":
                os.link(draft.toUri().getPath(), final.toUri().getPath())
            else:
                self._rename_if_absent(draft, final)
            return True
        except FileExistsError:
            return False
        finally:
            self._fs.delete(draft, False)

    def _rename_if_absent(self, draft, final) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), conf)
        kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        never = self.spark.sparkContext._gateway.new_array(kind, 1)
        never[0] = kind.NONE
        try:
            context.rename(draft, final, never)
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" in str(e.java_exception):
                raise FileExistsError(final.toString()) from e
            raise

    def _delete(self, *below: str) -> None:
        self._fs.delete(self._path(*below), True)

    # -- reading ----------------------------------------------------------

    def versions(self) -> list[int]:
        """Numbers of the versions that can be read, oldest first."""
        names = [s.getPath().getName() for s in self._names(VERSIONS)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and not n.startswith("."))

    def version(self, number: int | None = None) -> Version | None:
        """A version by number, or the newest; None if the table has none."""
        if number is None:
            known = self.versions()
            if not known:
                return None
            number = known[-1]
        return Version.parse(self._text(VERSIONS, _name(number)))

    def read(self, number: int | None = None) -> DataFrame:
        """The rows of a version, the newest unless told otherwise."""
        version = self.version(number)
        if version is None:
            raise FileNotFoundError(f"{self.path} has no version")
        return self.rows(version.schema, version.entries)

    def read_or_none(self) -> DataFrame | None:
        version = self.version()
        return None if version is None else self.rows(version.schema, version.entries)

    def rows(self, schema: T.StructType, entries: Iterable[Entry]) -> DataFrame:
        """The rows of some files."""
        files = [f"{self.path}/{e.path}" for e in entries]
        if not files:
            return self.spark.createDataFrame([], schema)
        stored = T.StructType([*schema.fields, T.StructField(COMMIT, T.StringType())])
        return self.spark.read.schema(stored).option("basePath", self.path).parquet(*files).select(*schema.names)

    # -- publishing -------------------------------------------------------

    def write(self, df: DataFrame, partition_by: Sequence[str] = (), metrics: dict | None = None) -> Written:
        """Writes rows into a new folder. ``metrics`` (name to aggregate) are computed in the same pass, beside ``rows``."""
        folder = f"{COMMIT}={uuid.uuid4().hex}"
        seen = Observation(f"write {folder}")
        observed = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in (metrics or {}).items()])
        # Rows of a partition are brought together first, large partitions staying split.
        writer = (observed.hint("rebalance", *partition_by) if partition_by else observed).write
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        try:
            writer.parquet(f"{self.path}/{folder}")
        except Exception:
            self._delete(folder)
            raise
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields])
        entries = tuple(self._listed(folder))
        try:
            found = dict(seen.get)
        except Py4JJavaError:
            # The optimizer drops the observation from a plan that it knows to have no rows.
            if not self.rows(schema, entries).isEmpty():
                raise
            found = {"rows": 0}
        return Written(schema, tuple(partition_by), entries, (folder,), found)

    def _listed(self, folder: str) -> list[Entry]:
        """The data files of a folder."""
        out, found = [], self._fs.listFiles(self._path(folder), True)
        while found.hasNext():
            state = found.next()
            path = state.getPath().toString()
            if path.endswith(".parquet"):
                out.append(Entry(folder + path.split(folder, 1)[1], state.getLen()))
        return sorted(out, key=lambda e: e.path)

    def discard(self, written: Written) -> None:
        """Deletes rows that no version will take in."""
        for folder in written.folders:
            self._delete(folder)

    def put(self, base: int, schema: T.StructType, partition_by: Sequence[str], entries: Iterable[Entry], operation: str, notes: dict | None = None) -> Version:
        """Makes some files version ``base + 1``; ``Conflict`` if it exists already."""
        if base and base < max(self.versions(), default=0):
            raise Conflict(f"{self.path}: version {base} is no longer the newest")
        version = Version(base + 1, schema, tuple(partition_by), operation, time.time(), tuple(entries), notes or {})
        self._fs.mkdirs(self._path(VERSIONS))
        if not self._put_if_absent(version.text(), VERSIONS, _name(version.number)):
            raise Conflict(f"{self.path}: version {version.number} was put by another publisher")
        return version

    def _publish(self, written: Written, keep: Callable[[Version], Iterable[Entry]], operation: str, base: int | None, retries: int, notes: dict | None) -> Version:
        """Puts a version of ``written`` and the files kept of the version before.

        With ``base`` the caller's version must still be the newest; without, a
        lost race is tried again from the new one, as the change does not depend
        on what it was made from.
        """
        for turn in range(retries + 1):
            now = self.version()
            number = (now.number if now else 0) if base is None else base
            kept = tuple(keep(now)) if now else ()
            if now and kept:
                self._same_shape(now, written)
            try:
                return self.put(number, written.schema, written.partition_by, kept + written.entries, operation, notes)
            except Conflict:
                if base is not None or turn == retries:
                    self.discard(written)
                    raise
        raise AssertionError

    def _same_shape(self, now: Version, written: Written) -> None:
        if now.partition_by != written.partition_by or now.schema.names != written.schema.names:
            raise ValueError(f"{self.path}: columns or partitions differ from those of version {now.number}")

    def replace(self, df: DataFrame | Written, partition_by: Sequence[str] = (), base: int | None = None, retries: int = 0, notes: dict | None = None) -> Version:
        """A version that holds just these rows."""
        return self._publish(self._taken(df, partition_by), lambda now: (), "replace", base, retries, notes)

    def append(self, df: DataFrame | Written, partition_by: Sequence[str] = (), base: int | None = None, retries: int = 5, notes: dict | None = None) -> Version:
        """A version with these rows added; no file is written again."""
        return self._publish(self._taken(df, partition_by), lambda now: now.entries, "append", base, retries, notes)

    def replace_partitions(self, df: DataFrame | Written, partition_by: Sequence[str], base: int | None = None, retries: int = 5, emptied: Iterable[str] = (), notes: dict | None = None) -> Version:
        """A version in which the partitions these rows hold, and the folders in ``emptied``, are replaced."""
        written = self._taken(df, partition_by)
        gone = {e.partition for e in written.entries} | set(emptied)
        return self._publish(written, lambda now: [e for e in now.entries if e.partition not in gone], "replace partitions", base, retries, notes)

    def replace_files(self, df: DataFrame | Written, gone: Iterable[Entry], base: int, partition_by: Sequence[str] = (), notes: dict | None = None) -> Version:
        """A version with some files of version ``base`` replaced by these rows."""
        paths = {e.path for e in gone}
        return self._publish(self._taken(df, partition_by), lambda now: [e for e in now.entries if e.path not in paths], "replace files", base, 0, notes)

    def _taken(self, df: DataFrame | Written, partition_by: Sequence[str]) -> Written:
        return df if isinstance(df, Written) else self.write(df, partition_by)

    # -- cleaning up ------------------------------------------------------

    def expire(self, keep: int = 2) -> list[int]:
        """Drops all but the newest ``keep`` versions and the files that only they hold.

        Manifests go first: a run that dies in between leaves folders that no
        version names, which ``vacuum`` finds.
        """
        known = self.versions()
        old, kept = known[: max(0, len(known) - max(keep, 1))], known[max(0, len(known) - max(keep, 1)) :]
        if not old:
            return []
        live = [e for n in kept for e in self.version(n).entries]
        paths, folders = {e.path for e in live}, {e.commit for e in live}
        dead = {e for n in old for e in self.version(n).entries if e.path not in paths}
        for n in old:
            self._delete(VERSIONS, _name(n))
        for folder in {e.commit for e in dead} - folders:
            self._delete(folder)
        for e in dead:
            if e.commit in folders:
                self._delete(e.path)
        return old

    def vacuum(self, older_than_seconds: float) -> list[str]:
        """Deletes folders that no version names, left by publishers that died; younger ones may still be written."""
        named = {e.commit for n in self.versions() for e in self.version(n).entries}
        limit = (time.time() - older_than_seconds) * 1000
        gone = []
        for state in self._names():
            name = state.getPath().getName()
            if name.startswith(f"{COMMIT}=") and name not in named and state.getModificationTime() <= limit:
                self._delete(name)
                gone.append(name)
        return gone


def _name(number: int) -> str:
    return f"{number:012d}.json"


def merge_into(
    table: VersionedTable,
    source: DataFrame,
    key: Sequence[str],
    partition_by: Sequence[str],
    checked: Callable[[DataFrame], dict] | None = None,
) -> tuple[Version | None, dict]:
    """Update on key match, insert otherwise, as one new version of the partitions that ``source`` holds.

    The key must determine the partition; keys may be NULL, and NULL equals NULL.
    ``source`` must have one row per key. It is written once; ``checked`` may
    count its failures, and any failure leaves the table as it is.
    """
    key, partition_by = list(key), list(partition_by)
    given = table.write(source, partition_by)
    rows = table.rows(given.schema, given.entries)
    failures = checked(rows) if checked else {}
    if any(failures.values()):
        table.discard(given)
        return None, failures
    now = table.version()
    touched = {e.partition for e in given.entries}
    met = [e for e in now.entries if e.partition in touched] if now else []
    if not met:
        return table.append(given, partition_by, base=now.number if now else 0), failures
    same = lambda old, new: reduce(lambda a, b: a & b, [old[c].eqNullSafe(new[f"_{c}"]) for c in key])
    old = table.rows(now.schema, met)
    keys = rows.select(*[F.col(c).alias(f"_{c}") for c in key])
    kept = table.write(old.join(keys, same(old, keys), "left_anti"), partition_by)
    both = Written(given.schema, given.partition_by, kept.entries + given.entries, kept.folders + given.folders, given.metrics)
    return table.replace_files(both, met, now.number, partition_by), failures
