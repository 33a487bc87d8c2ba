"""Publish gate, freshness and the other load strategies."""

from pyspark.sql import functions as F

from fleetspark.operators.incremental import append, full_refresh, insert_overwrite, replace_where
from fleetspark.plans.quality import Check, check_freshness, check_unique, publish_if_valid


def _vals(spark, path):
    return sorted((r["k"], r["v"]) for r in spark.read.parquet(path).collect())


def test_gate_publishes_only_when_checks_pass(spark, tmp_dir):
    good = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    bad = spark.createDataFrame([("a", 1), ("a", -2)], "k string, v int")
    path = f"{tmp_dir}/t"
    rep = publish_if_valid(spark, good, {"v_positive": F.col("v") > 0}, path, [Check("k_unique", lambda df: check_unique(df, "k"))])
    assert rep["published"] and rep["rows"] == 2
    rep = publish_if_valid(spark, bad, {"v_positive": F.col("v") > 0}, path, [Check("k_unique", lambda df: check_unique(df, "k"))])
    assert not rep["published"] and rep["failures"] == {"v_positive": 1, "k_unique": 1}
    assert _vals(spark, path) == [("a", 1), ("b", 2)]  # previous table left in place


def test_freshness(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00",), ("2024-01-01 01:00:00",)], "t string").select(F.col("t").cast("timestamp").alias("t"))
    row = check_freshness(df, "t", "2024-01-01 03:00:00", max_age_seconds=3600).collect()[0]
    assert row["age_seconds"] == 7200 and row["stale"] is True


def test_load_strategies(spark, tmp_dir):
    path = f"{tmp_dir}/s"
    a = spark.createDataFrame([("x", 1, "d1"), ("y", 2, "d2")], "k string, v int, d string")
    full_refresh(a, path, ["d"])
    append(spark.createDataFrame([("z", 3, "d3")], "k string, v int, d string"), path, ["d"])
    assert _vals(spark, path) == [("x", 1), ("y", 2), ("z", 3)]
    insert_overwrite(spark.createDataFrame([("w", 9, "d1")], "k string, v int, d string"), path, ["d"])
    assert _vals(spark, path) == [("w", 9), ("y", 2), ("z", 3)]
    replace_where(spark, spark.createDataFrame([("q", 7, "d2")], "k string, v int, d string"), path, F.col("v") >= 2, ["d"])
    assert _vals(spark, path) == [("q", 7)]  # every row with v >= 2 replaced, emptied partitions removed
    full_refresh(a, path, ["d"])
    assert _vals(spark, path) == [("x", 1), ("y", 2)]
