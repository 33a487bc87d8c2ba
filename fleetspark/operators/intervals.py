"""The version of a key that was valid at each of many times: an interval join.

A history has intervals of any length, from minutes to open-ended, so neither a
join on the key alone (all versions times all readings of a hot key) nor one on
fixed time buckets (a long version lies in thousands) works. Here each version is
put at the finest level whose buckets it spans ``MOST_BUCKETS`` of at most; levels
are buckets of 1, 4, 16, ... units. A reading looks up its bucket at each level
that the history uses, so both sides grow by a small bounded factor, and the join
is an equi join on (key, level, bucket) with the exact interval as a filter.

Keys with more readings than ``hot`` are salted: their readings are dealt over
``salts`` groups and their versions copied to each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetspark.operators.incremental import BROADCAST_MAX_ROWS

#: Buckets that a version spans at its level, at most; buckets of a level hold so many of the next finer one.
MOST_BUCKETS, STEP = 8, 4
#: The coarsest level; at 4 ** 16 seconds (136 years) and more anything spans a few buckets.
LEVELS = 17


def _bucket(seconds: Column, level: Column) -> Column:
    """The bucket of a time at a level, whose buckets are STEP ** level seconds long."""
    return F.floor(seconds / F.pow(F.lit(float(STEP)), level)).cast("bigint")


def versions_at(
    readings: DataFrame,
    history: DataFrame,
    key: str,
    time: str,
    columns: Sequence[str],
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    how: str = "left",
    hot: int = 1_000_000,
    salts: int = 16,
) -> DataFrame:
    """``readings`` with the ``columns`` of the version of their key valid at their time: valid_from <= time < valid_to (null: open).

    Readings without a version keep nulls ("inner": are left out, which saves a
    shuffle); where versions of a key overlap, a reading comes once for each. A null valid_from means from ever. Rows without a
    key or a time have no version. Times are compared to the microsecond.
    """
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    span = readings.agg(F.min(micros(time)).alias("low"), F.max(micros(time)).alias("high")).first()
    low, high = (span.low or 0), (span.high or 0)

    # Outside the readings' times a version needs no buckets; that also gives open ends an end.
    begin = F.greatest(F.coalesce(micros(valid_from), F.lit(low)), F.lit(low))
    end = F.least(F.coalesce(micros(valid_to), F.lit(high + 1)), F.lit(high + 1))
    versions = history.select(F.col(key).alias("_k"), begin.alias("_from"), end.alias("_to"), F.struct(*columns).alias("_version")).where("_k is not null and _from < _to")
    first, last = F.col("_from") / 1e6, (F.col("_to") - 1) / 1e6
    fits = F.array(*[F.when(_bucket(last, F.lit(n)) - _bucket(first, F.lit(n)) < MOST_BUCKETS, F.lit(n)) for n in range(LEVELS)])
    versions = versions.withColumn("_level", F.coalesce(F.array_min(fits), F.lit(LEVELS)))
    versions = versions.withColumn("_bucket", F.explode(F.sequence(_bucket(first, F.col("_level")), _bucket(last, F.col("_level")))))

    levels = sorted(r[0] for r in versions.select("_level").distinct().collect())
    rows = readings.withColumn("_t", micros(time)).withColumn("_id", F.monotonically_increasing_id())
    heavy = readings.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_hot")).agg(F.count("*").alias("n")).where(F.col("n") > hot).select("_hot")
    few = heavy.limit(BROADCAST_MAX_ROWS + 1).count()
    side = F.broadcast(heavy) if few <= BROADCAST_MAX_ROWS else heavy
    if few:
        salt = F.pmod(F.xxhash64(time, "_id"), F.lit(salts)).cast("int")
        rows = rows.join(side, F.col(key) == F.col("_hot"), "left").withColumn("_salt", F.when(F.col("_hot").isNotNull(), salt).otherwise(0)).drop("_hot")
        copies = F.when(F.col("_hot").isNotNull(), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
        versions = versions.join(side, F.col("_k") == F.col("_hot"), "left").withColumn("_s", F.explode(copies)).drop("_hot")
    else:
        rows, versions = rows.withColumn("_salt", F.lit(0)), versions.withColumn("_s", F.lit(0))

    # A reading probes every level in use.
    probe = F.explode(F.array(*[F.struct(F.lit(n).alias("l"), _bucket(F.col("_t") / 1e6, F.lit(n)).alias("b")) for n in levels or [0]]))
    probes = rows.select("*", probe.alias("_p"))
    on = (F.col(key) == F.col("_k")) & (F.col("_salt") == F.col("_s")) & (F.col("_p.l") == F.col("_level")) & (F.col("_p.b") == F.col("_bucket"))
    within = (F.col("_t") >= F.col("_from")) & (F.col("_t") < F.col("_to"))
    met = probes.join(versions, on & within, how)
    if how == "left":
        # Matches stay, and of a reading that matched at no level one row.
        mine = Window.partitionBy("_id")
        found = F.max(F.col("_version").isNotNull()).over(mine)
        place = F.row_number().over(mine.orderBy("_p.l"))
        met = met.withColumn("_found", found).withColumn("_place", place).where(F.col("_version").isNotNull() | (~F.col("_found") & (F.col("_place") == 1)))
    return met.select(*readings.columns, *[F.col(f"_version.{c}").alias(c) for c in columns])
