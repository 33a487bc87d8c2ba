"""Type 2 history of a dimension.

``scd2`` takes the history so far and the dimension's current state and
returns the new history; nothing is rebuilt from the source. The open
versions (``valid_to`` NULL) are full-outer-joined with the new state on the
key (one shuffle of two tables of one row per key); closed versions are
passed through untouched.

* timestamp strategy: a key changed when its ``updated_at`` is newer than the
  open version's ``valid_from`` (any time is newer than none); the open version closes at the new
  ``updated_at``, which is also the new version's ``valid_from``.
* check strategy: a key changed when any ``check_cols`` value differs
  (NULL-safe); versions open and close at ``now``.
* Keys missing from the new state stay open.

``scd_id`` identifies a version: md5 of the key and ``valid_from`` in
microseconds.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspark.sources.versioned import Version, VersionedTable


def _scd_id(key: Sequence[str], valid_from: Column) -> Column:
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in key], F.unix_micros(valid_from.cast("timestamp")).cast("string")))


def _versions(current: DataFrame, key: Sequence[str], valid_from: Column) -> DataFrame:
    """New open versions: ``valid_from`` given, ``valid_to`` NULL (same type), ``scd_id``."""
    out = current.withColumn("valid_from", valid_from)
    out = out.withColumn("valid_to", F.lit(None).cast(out.schema["valid_from"].dataType))
    return out.withColumn("scd_id", _scd_id(key, F.col("valid_from")))


def scd2(
    history: DataFrame | None,
    current: DataFrame,
    key: Sequence[str] | str,
    updated_at: str | None = None,
    check_cols: Sequence[str] | None = None,
    now: dt.datetime | str | None = None,
) -> DataFrame:
    key = [key] if isinstance(key, str) else list(key)
    if (updated_at is None) == (check_cols is None):
        raise ValueError("give exactly one of updated_at (timestamp strategy) or check_cols (check strategy)")
    if updated_at is not None:
        start = F.col(updated_at)
    else:
        if now is None:
            raise ValueError("the check strategy needs now=")
        start = F.lit(now).cast("timestamp")
        # Keep the timestamp type of the history's validity columns stable across runs.
        if history is not None:
            start = start.cast(history.schema["valid_from"].dataType)
    if history is None:
        return _versions(current, key, start)

    cols = current.columns
    opened = history.where(F.col("valid_to").isNull())
    closed = history.where(F.col("valid_to").isNotNull())
    o = opened.select(*[F.col(c).alias(f"o__{c}") for c in opened.columns])
    c = current.select(*[F.col(x).alias(f"c__{x}") for x in cols], *[F.col(k).alias(f"k__{k}") for k in key])
    cond = None
    for k in key:
        part = F.col(f"o__{k}") == F.col(f"k__{k}")
        cond = part if cond is None else cond & part
    j = o.join(c, cond, "full_outer")

    has_open = F.col("o__scd_id").isNotNull()
    has_new = F.col(f"k__{key[0]}").isNotNull()
    if updated_at is not None:
        new_start = F.col(f"c__{updated_at}")
        older = F.coalesce(F.col("o__valid_from") < new_start, F.col("o__valid_from").isNull() & new_start.isNotNull())
        changed = has_open & has_new & older
    else:
        new_start = start
        diff = None
        for col_name in check_cols:
            d = ~F.col(f"o__{col_name}").eqNullSafe(F.col(f"c__{col_name}"))
            diff = d if diff is None else diff | d
        changed = has_open & has_new & diff

    open_cols = [F.col(f"o__{x}").alias(x) for x in history.columns if x not in ("valid_to",)]
    # Open versions: unchanged or missing from the new state stay as they are; changed ones close.
    kept_open = j.where(has_open).select(
        *open_cols, F.when(changed, new_start.cast(history.schema["valid_to"].dataType)).alias("valid_to")
    )
    inserted = j.where(has_new & (~has_open | changed)).select(*[F.col(f"c__{x}").alias(x) for x in cols], new_start.alias("_start"))
    inserted = _versions(inserted, key, F.col("_start")).drop("_start")
    out_cols = history.columns
    return closed.select(*out_cols).unionByName(kept_open.select(*out_cols)).unionByName(inserted.select(*out_cols))


#: The partition of open versions; closed ones lie in that of the month they closed in.
OPEN = "open"
CLOSED = "closed_in"


class History:
    """A stored history that only grows: closed versions are written once, a run rewrites just the open ones.

    The table is a versioned one, partitioned by the month in which a version
    closed. A run reads the open partition, adds the versions it closes to their
    months and puts the new open partition in place of the old by one manifest,
    so what it writes depends on the number of keys, not on the history behind
    them, and a run that dies changes nothing. ``at`` reads the open partition and
    the months from the asked time on.
    """

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str] | str):
        self.table = VersionedTable(spark, path)
        self.key = [key] if isinstance(key, str) else list(key)

    def run(self, current: DataFrame, updated_at: str | None = None, check_cols: Sequence[str] | None = None, now: dt.datetime | str | None = None, keep: int = 2) -> Version:
        """Takes the dimension's current state in (see ``scd2``); the history's newest version is the base."""
        base = self.table.version()
        opened = [e for e in base.entries if e.partition == f"{CLOSED}={OPEN}"] if base else []
        before = self.table.rows(base.schema, opened).drop(CLOSED) if base else None
        after = scd2(before, current, self.key, updated_at=updated_at, check_cols=check_cols, now=now)
        month = F.coalesce(F.date_format(F.col("valid_to").cast("timestamp"), "yyyy-MM"), F.lit(OPEN))
        version = self.table.replace_files(after.withColumn(CLOSED, month), opened, base.number if base else 0, [CLOSED])
        self.table.expire(keep)
        return version

    def read(self) -> DataFrame:
        return self.table.read().drop(CLOSED)

    def at(self, t: dt.datetime | str) -> DataFrame:
        """Versions valid at ``t``; months that closed before it are not read."""
        month = F.date_format(F.lit(t).cast("timestamp"), "yyyy-MM")
        # The open partition's name sorts after every month.
        return as_of(self.table.read().where(F.col(CLOSED) >= month).drop(CLOSED), t)


def current_rows(history: DataFrame) -> DataFrame:
    """Current versions (I8)."""
    return history.where(F.col("valid_to").isNull())


def as_of(history: DataFrame, t: dt.datetime | str | Column) -> DataFrame:
    """Versions valid at ``t`` (I7): valid_from <= t < coalesce(valid_to, infinity)."""
    tc = t if isinstance(t, Column) else F.lit(t).cast(history.schema["valid_from"].dataType)
    return history.where((F.col("valid_from") <= tc) & (F.col("valid_to").isNull() | (tc < F.col("valid_to"))))


def history_of(history: DataFrame, key_col: str, value) -> DataFrame:
    """All versions of one key, oldest first (F1)."""
    return history.where(F.col(key_col) == value).orderBy("valid_from")
