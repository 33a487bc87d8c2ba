"""Offset snapshots derived from delivered messages: the input of the lag reports in queries and tests.

Hourly per Kafka partition with deliveries in that hour: the produced end
offset, and for two consumer groups the offset they had committed by the end of
the hour, one of them some minutes late.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ARCHIVE_GROUP = "protobuf-writer"
DOCUMENT_GROUP = "elk-writer"
DOCUMENT_DELAY_MINUTES = 10


def offset_samples(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(samples, commits) per hour and Kafka partition from delivered messages."""
    hour = F.date_trunc("hour", F.col("kafka_timestamp").cast("timestamp"))
    hour_end = hour + F.expr("interval 1 hour")
    ingested = F.col("ingested_at").cast("timestamp")
    off = F.col("kafka_offset")
    hourly = messages.groupBy(F.col("kafka_partition").alias("partition"), hour.alias("h")).agg(
        F.min(off).alias("min_off"),
        F.max(off).alias("max_off"),
        F.max(F.when(ingested < hour_end, off)).alias("archive_off"),
        F.max(F.when(ingested + F.make_dt_interval(mins=F.lit(DOCUMENT_DELAY_MINUTES)) < hour_end, off)).alias("document_off"),
    )
    w = Window.partitionBy("partition").orderBy("h").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = hourly.select(
        (F.unix_seconds(F.col("h")) + 3600).alias("t"),
        "partition",
        F.min("min_off").over(w).alias("earliest"),
        (F.max("max_off").over(w) + 1).alias("end"),
        (F.max("archive_off").over(w) + 1).alias(ARCHIVE_GROUP),
        (F.max("document_off").over(w) + 1).alias(DOCUMENT_GROUP),
    )
    samples = running.select("t", "partition", "earliest", "end")
    commits = running.select(
        "t",
        "partition",
        F.explode(
            F.array(
                F.struct(F.lit(ARCHIVE_GROUP).alias("group_id"), F.col(ARCHIVE_GROUP).alias("committed")),
                F.struct(F.lit(DOCUMENT_GROUP).alias("group_id"), F.col(DOCUMENT_GROUP).alias("committed")),
            )
        ).alias("c"),
    ).select("t", "c.group_id", "partition", "c.committed")
    return samples, commits
