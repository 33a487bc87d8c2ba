"""Consumer-lag monitoring over offset snapshots.

Offset snapshots are tables: ``samples`` (t epoch seconds, partition,
earliest, end) and ``commits`` (t, group_id, partition, committed; NULL when
the group has committed nothing yet). Offsets only move forward and a snapshot
may leave out partitions without news, so reports are made over the whole grid
of sample times, partitions and groups, each offset carried forward:

* ``lag_report``: per sample time and group: produced = sum(end),
  retained = sum(end - earliest), consumed = sum(committed, NULL as 0),
  lag = sum(end - start) with start = committed, else earliest.
* ``rates``: value change per second over the trailing window: (last - first
  sample inside the window) / elapsed; 0 with one sample or no elapsed time.
* ``lag_history``: the report rows of the last ``minutes`` before the newest
  sample.

Every window is partitioned by Kafka partition or by group. The lists of
partitions and groups, which a topic has thousands of at most, become arrays.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _carried(column: str, *by: str):
    """The last known value at or before a row's time."""
    return F.last(column, ignorenulls=True).over(Window.partitionBy(*by).orderBy("t").rowsBetween(Window.unboundedPreceding, 0))


def complete_samples(samples: DataFrame) -> DataFrame:
    """A row for every sample time and partition.

    A silent partition keeps its offsets; before its first snapshot it is empty
    at the earliest offset that this one shows.
    """
    partitions = samples.select(F.collect_set("partition")).scalar()
    grid = samples.select("t").distinct().select("t", F.explode(partitions).alias("partition"))
    known = grid.join(samples.select("t", "partition", "earliest", "end"), ["t", "partition"], "left")
    start = F.first("earliest", ignorenulls=True).over(Window.partitionBy("partition").orderBy("t").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return known.select("t", "partition", F.coalesce(_carried("earliest", "partition"), start).alias("earliest"), F.coalesce(_carried("end", "partition"), start).alias("end"))


def partition_lag(samples: DataFrame, commits: DataFrame, known_groups: Sequence[str] = ()) -> DataFrame:
    """Per sample time, group and partition: committed, end and lag (start = committed, else earliest)."""
    named = F.array(*[F.lit(g) for g in known_groups]).cast("array<string>")
    groups = F.array_union(commits.select(F.collect_set("group_id")).scalar(), named)
    each = complete_samples(samples).select("*", F.explode(groups).alias("group_id"))
    rows = each.join(commits.select("t", "group_id", "partition", "committed"), ["t", "group_id", "partition"], "left")
    rows = rows.withColumn("committed", _carried("committed", "group_id", "partition"))
    return rows.select("t", "group_id", "partition", "committed", "end", (F.col("end") - F.coalesce("committed", "earliest")).alias("lag"), "earliest")


def lag_report(samples: DataFrame, commits: DataFrame, known_groups: Sequence[str] = ()) -> DataFrame:
    """Per sample time and group: produced, retained, consumed, lag.

    A group with no committed offset at a sample is dropped unless it is one
    of ``known_groups`` (then it starts at the earliest offset).
    """
    pl = partition_lag(samples, commits, known_groups)
    per_group = pl.groupBy("t", "group_id").agg(
        F.sum("end").alias("produced"),
        F.sum(F.col("end") - F.col("earliest")).alias("retained"),
        F.sum(F.coalesce(F.col("committed"), F.lit(0))).alias("consumed"),
        F.sum("lag").alias("lag"),
        F.count("committed").alias("_committed_partitions"),
    )
    keep = (F.col("_committed_partitions") > 0) | F.col("group_id").isin(list(known_groups))
    return per_group.where(keep).drop("_committed_partitions")


def rates(series: DataFrame, value_cols: Sequence[str], key: Sequence[str] = ("group_id",), t: str = "t", window_seconds: int = 10) -> DataFrame:
    """Rate of change per second of each value over the trailing window."""
    w = Window.partitionBy(*key).orderBy(F.col(t)).rangeBetween(-window_seconds, 0)
    first_t = F.first(t).over(w)
    out = series
    for c in value_cols:
        first_v = F.first(c).over(w)
        out = out.withColumn(f"{c}_rate", F.when(F.col(t) > first_t, (F.col(c) - first_v) / (F.col(t) - first_t)).otherwise(F.lit(0.0)))
    return out.select(*key, t, *[f"{c}_rate" for c in value_cols])


def lag_history(report: DataFrame, minutes: int = 10, t: str = "t") -> DataFrame:
    """Report rows of the last ``minutes`` before the newest sample (S13); the newest time is a scalar subquery."""
    newest = report.select(F.max(t)).scalar()
    return report.where(F.col(t) >= newest - F.lit(minutes * 60))
