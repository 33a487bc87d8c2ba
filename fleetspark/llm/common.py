"""Helpers shared by the corpus operators: words, written intermediate tables, cleaning up after them.

Every operator starts by selecting just the columns it names, so extra input
columns never clash with the ones it adds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspark.session import work_path

#: Words are maximal runs of characters other than the six ASCII white-space characters.
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD_RUN = r"[^\x20\x09-\x0D]+"
#: Spark's setting to delete a query's shuffle files at its end.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def text_or_empty(col: str = "text") -> Column:
    """The text, or an empty one for null."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text as an array."""
    return F.filter(F.split(text, SPACE_RUN), lambda w: w != "")


def written(df: DataFrame, name: str, drop_shuffles: bool = False) -> DataFrame:
    """Writes ``df`` as Parquet in the shared work folder and reads it back.

    This cuts the lineage: a lost executor costs only the tasks it ran, and no
    later step computes ``df`` again. ``discard`` deletes it. With
    ``drop_shuffles`` Spark deletes the job's shuffle files as soon as it is
    done, not when the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    if drop_shuffles:
        before = spark.conf.get(DROP_SHUFFLES)
        spark.conf.set(DROP_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        if drop_shuffles:
            spark.conf.set(DROP_SHUFFLES, before)
    table = spark.read.schema(df.schema).parquet(path)
    table.work_path = path
    return table


def small(table: DataFrame, most_rows: int) -> DataFrame:
    """The table marked for broadcast if it has no more than ``most_rows`` rows, else as it is (joined by a shuffle)."""
    return F.broadcast(table) if table.count() <= most_rows else table


def discard(*tables: DataFrame) -> None:
    """Deletes tables made by ``written`` that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.work_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def where_computed(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which a condition over computed columns holds.

    A plain filter is moved below the projections, which would write the
    expressions of those columns into the condition, once for each mention. It
    stays above a projection that is not deterministic, as the partition's id.
    """
    marked = df.withColumn("_ok", condition).withColumn("_at", F.spark_partition_id())
    return marked.filter("_ok and _at >= 0").drop("_ok", "_at")


def release(spark: SparkSession) -> None:
    """Lets Spark's cleaner delete the shuffle files of jobs whose results are written.

    The cleaner works when the driver's JVM collects its garbage, which a small
    driver may not do for half an hour; between two large steps it is asked to.
    """
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()
