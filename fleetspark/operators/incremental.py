"""Incremental loads and keyed merge without a transactional table format.

* ``high_watermarks`` (D6): max offset per Kafka partition in the target.
* ``new_since`` (C1, I1): readings above their partition's watermark, or in a
  partition the target has not seen. The watermark table has one row per
  Kafka partition of the topic; it is broadcast only after its row count is
  checked against ``BROADCAST_MAX_ROWS``, else it is an ordinary join.
* ``footer_watermarks`` (D6): the same from the statistics in the files' footers.
* ``merge_upsert`` (C3, I2): update-all on key match, insert otherwise. The
  key must determine the partition column (an event's date never changes),
  so only partitions present in the source are read and rewritten, with
  dynamic partition overwrite. The merged partitions are first written to
  the shared work folder and then swapped in, so the target is never read
  and overwritten by the same job. Not atomic across partitions, but running
  it again gives the same table.
* ``full_refresh`` (I3) and the other strategies (I4): ``append``,
  ``insert_overwrite`` (replace whole partitions), ``replace_where``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from fleetspark.session import discard_path, materialize, settings, work_path
from fleetspark.sources.versioned import COMMIT, Version, VersionedTable

# A watermark table larger than this is joined, not broadcast.
BROADCAST_MAX_ROWS = 100_000
# Partition values that a merge turns into a literal filter at most.
LITERAL_PARTITIONS = 1_000


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, asked through the cluster's Hadoop file system (any scheme)."""
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))
    except Exception:  # no JVM access (e.g. a remote session): fall back to trying the read
        return True


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    if not path_exists(spark, path):
        return None
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def high_watermarks(target: DataFrame, partition_col: str = "kafka_partition", offset_col: str = "kafka_offset") -> DataFrame:
    return target.groupBy(partition_col).agg(F.max(offset_col).alias("max_kafka_offset"))


#: Sources that Spark reads in its older way; Parquet is not among them when its footers are to answer.
V1_SOURCES = "avro,csv,json,kafka,orc,text"


def footer_maxima(table: VersionedTable, version: Version, offset_col: str) -> DataFrame:
    """Greatest offset per folder of partitions; planned under the settings of ``footer_watermarks`` it reads footers only."""
    files = [f"{table.path}/{e.path}" for e in version.entries]
    rows = table.spark.read.option("basePath", table.path).parquet(*files)
    return rows.groupBy(COMMIT, *version.partition_by).agg(F.max(offset_col).alias("max_kafka_offset"))


def footer_watermarks(table: VersionedTable, partition_col: str = "kafka_partition", offset_col: str = "kafka_offset") -> DataFrame:
    """``high_watermarks`` of a versioned table partitioned by ``partition_col`` (and others), without reading a row.

    The greatest offsets come from the statistics in the files' footers: the
    aggregate is pushed into the Parquet scan. One row per Kafka partition comes
    to the driver, of which a topic has thousands at most.
    """
    version = table.version()
    schema = "partition string, max_kafka_offset bigint"
    if version is None or not version.entries:
        return table.spark.createDataFrame([], schema).select(F.col("partition").alias(partition_col), "max_kafka_offset")
    if partition_col not in version.partition_by:
        raise ValueError(f"{table.path} is not partitioned by {partition_col}")
    try:
        with settings(table.spark, **{"spark.sql.sources.useV1SourceList": V1_SOURCES, "spark.sql.parquet.aggregatePushdown": "true"}):
            found = footer_maxima(table, version, offset_col).groupBy(partition_col).agg(F.max("max_kafka_offset").alias("max_kafka_offset")).collect()
    except Py4JJavaError as e:
        # A footer without statistics (a file whose offsets are all NULL) cannot answer: then the column is read.
        if "No min/max found" not in str(e):
            raise
        return high_watermarks(table.read(), partition_col, offset_col)
    kind = version.schema[partition_col].dataType.simpleString()
    rows = [(None if r[0] is None else str(r[0]), r[1]) for r in found]
    return table.spark.createDataFrame(rows, schema).select(F.col("partition").cast(kind).alias(partition_col), "max_kafka_offset")


def new_since(
    readings: DataFrame,
    target: DataFrame | None,
    partition_col: str = "kafka_partition",
    offset_col: str = "kafka_offset",
    watermarks: DataFrame | None = None,
) -> DataFrame:
    """Readings not yet loaded: offset above the target's max for its partition, or an unseen partition.

    ``watermarks`` saves the scan of the target, see ``footer_watermarks``.
    """
    if target is None and watermarks is None:
        return readings
    wm = high_watermarks(target, partition_col, offset_col) if watermarks is None else watermarks
    wm = materialize(wm)
    side = F.broadcast(wm) if wm.count() <= BROADCAST_MAX_ROWS else wm
    joined = readings.join(side, on=partition_col, how="left")
    keep = F.col("max_kafka_offset").isNull() | (F.col(offset_col) > F.col("max_kafka_offset"))
    return joined.where(keep).drop("max_kafka_offset")


def dedup_on_key(df: DataFrame, key: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """One row per key (the merge input must be unique); latest offset wins unless ``order`` says otherwise."""
    if order is None:
        order = [F.col(c).desc_nulls_last() for c in ("kafka_partition", "kafka_offset") if c in df.columns]
        order = order or [F.col(key[0])]
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def _write(df: DataFrame, path: str, mode: str, partition_by: Sequence[str], replace: str = "static") -> None:
    """``replace``: an overwrite replaces the whole table ("static") or the partitions in ``df`` ("dynamic").

    Rows of a partition are brought together first, large partitions staying
    split, so that a write leaves few files per partition.
    """
    writer = (df.hint("rebalance", *partition_by) if partition_by else df).write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", replace)
    writer.parquet(path)


def full_refresh(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Rebuild the whole table (I3, A10): partitions that ``df`` no longer holds go."""
    _write(df, path, "overwrite", partition_by)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    _write(df, path, "append", partition_by)


def _swap_partitions(spark: SparkSession, merged: DataFrame, path: str, partition_by: Sequence[str]) -> str:
    """Writes the merged partitions to the work folder, then over the target's; returns the work table's path."""
    staged = work_path(spark, "merge")
    _write(merged, staged, "overwrite", partition_by)
    # An explicit schema: an empty merge leaves no files, and then there is nothing to replace.
    _write(spark.read.schema(merged.schema).parquet(staged), path, "overwrite", partition_by, replace="dynamic")
    return staged


def insert_overwrite(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace every partition present in ``df`` (I4)."""
    discard_path(df.sparkSession, _swap_partitions(df.sparkSession, df, path, partition_by))


def _equal(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    """Join condition on equal columns, where NULL equals NULL."""
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in columns])


def _in_partitions(target: DataFrame, touched: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Target rows of the touched partitions.

    Up to ``LITERAL_PARTITIONS`` values of a single partition column become a
    literal filter, which prunes folders for certain; more are joined.
    """
    if len(partition_by) == 1:
        column = partition_by[0]
        values = [r[0] for r in touched.limit(LITERAL_PARTITIONS + 1).collect()]
        if len(values) <= LITERAL_PARTITIONS:
            known = [v for v in values if v is not None]
            hit = F.col(column).isin(known) if known else F.lit(False)
            return target.where(hit | F.col(column).isNull() if None in values else hit)
    return target.join(touched, _equal(target, touched, partition_by), "left_semi")


def merge_upsert(spark: SparkSession, source: DataFrame, path: str, key: Sequence[str], partition_by: Sequence[str]) -> None:
    """Upsert ``source`` into the parquet table at ``path`` on ``key``.

    The source is computed once, into the work folder. Keys and partition
    values may be NULL; NULL equals NULL.
    """
    key, partition_by = list(key), list(partition_by)
    target = read_if_exists(spark, path)
    once = work_path(spark, "merge-source")
    deduplicated = dedup_on_key(source, key)
    deduplicated.write.parquet(once)
    src = spark.read.schema(deduplicated.schema).parquet(once)
    if target is None:
        _write(src, path, "overwrite", partition_by)
    else:
        kept = _in_partitions(target, src.select(*partition_by).distinct(), partition_by)
        keys = src.select(*[F.col(c).alias(f"_{c}") for c in key])
        same = reduce(lambda a, b: a & b, [kept[c].eqNullSafe(keys[f"_{c}"]) for c in key])
        merged = kept.join(keys, same, "left_anti").unionByName(src.select(*target.columns))
        discard_path(spark, _swap_partitions(spark, merged, path, partition_by))
    discard_path(spark, once)


def _delete_partitions(spark: SparkSession, path: str, partition_by: Sequence[str], values: list[tuple]) -> None:
    """Removes partition folders (``col=value/...``) through the cluster's Hadoop file system."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    name = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    for vals in values:
        sub = "/".join(name(c, None if v is None else str(v)) for c, v in zip(partition_by, vals))
        p = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{sub}")
        fs = p.getFileSystem(conf)
        if fs.exists(p):
            fs.delete(p, True)


def replace_where(spark: SparkSession, source: DataFrame, path: str, condition: Column, partition_by: Sequence[str]) -> None:
    """Delete target rows matching ``condition``, insert ``source`` rows matching it (I4).

    Only partitions holding a matching row (in the target or the source) are
    rewritten; one left with no rows is removed.
    """
    target = read_if_exists(spark, path)
    src = source.where(condition)
    if target is None:
        _write(src, path, "overwrite", partition_by)
        return
    cols = list(partition_by)
    touched = src.select(*cols).unionByName(target.where(condition).select(*cols)).distinct()
    kept = _in_partitions(target, touched, cols).where(~F.coalesce(condition, F.lit(False)))
    merged = kept.unionByName(src.select(*target.columns))
    # Partitions that lose all their rows are found before anything is replaced; only these reach the driver.
    left = merged.select(*cols).distinct()
    emptied = [tuple(r) for r in touched.join(left, _equal(touched, left, cols), "left_anti").collect()]
    discard_path(spark, _swap_partitions(spark, merged, path, partition_by))
    _delete_partitions(spark, path, cols, emptied)


def incremental_events(spark: SparkSession, stg: DataFrame, path: str, full: bool = False) -> None:
    """The incremental event fact (I1): new readings -> events -> merge on event_id by event_date."""
    from fleetspark.operators.marts import vehicle_events

    if full:
        full_refresh(vehicle_events(stg), path, ["event_date"])
        return
    target = read_if_exists(spark, path)
    events = vehicle_events(new_since(stg, target))
    merge_upsert(spark, events, path, ["event_id"], ["event_date"])
