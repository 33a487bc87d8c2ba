"""Data-quality checks and the publish gate.

``validate`` evaluates every field's rules in one projection over the
messages (the per-field conditions are built once as Columns) and explodes
only the failures, so a full rule set costs one scan, no shuffle.

Generic checks return the failing rows: ``check_unique``, ``check_not_null``,
``check_accepted_values``, ``check_relationship`` (left anti join),
``check_unique_combination``, ``check_freshness``. ``publish_if_valid`` runs
all checks in one pass over a staged write (``Observation``) and only then
moves the staged table into place; ``publish_version`` does the same for a
versioned table, where the checked files become visible by one manifest.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fleetspark.functions.rules import TELEMETRY_RULES, FieldSpec, all_true, conditions, not_true
from fleetspark.operators.marts import duplicates
from fleetspark.session import work_path

KEY_COLUMNS = ("message_id", "kafka_partition", "kafka_offset", "ingested_at")


def _strict(col: Column, spec: FieldSpec) -> Column:
    if spec.repeated or spec.kind in ("timestamp", "map", "bytes"):
        return col
    if spec.kind == "message":
        inner = [_strict(col.getField(n), sub).alias(n) for n, sub in spec.fields.items()]
        return F.when(col.isNotNull(), F.struct(*inner)) if inner else col
    zero = {"string": "", "bool": False, "enum": spec.enum_values[0] if spec.enum_values else None}.get(spec.kind, 0)
    return F.nullif(col, F.lit(zero))


def strict_values(decoded: DataFrame, rules: Mapping[str, FieldSpec] = TELEMETRY_RULES) -> DataFrame:
    """Defaults-on messages -> the strict (no defaults) form: zero scalars become NULL, in nested messages too."""
    return decoded.select(*[_strict(F.col(c), rules[c]).alias(c) if c in rules else F.col(c) for c in decoded.columns])


def rule_conditions(rules: Mapping[str, FieldSpec], now: Column | None = None) -> tuple[dict[str, Column], list[str], dict[str, list[str]]]:
    """Per field: one condition (all its rules), plus the unchecked rules and descriptions."""
    conds, unchecked, descriptions = {}, [], {}
    for name, spec in rules.items():
        checks = conditions(spec, F.col(name), name, now)
        unchecked.extend(checks.unchecked)
        if checks.items:
            conds[name] = all_true(checks.items)
            descriptions[name] = [d for _, d in checks.items]
    return conds, unchecked, descriptions


def _as_timestamp(now: dt.datetime | str | Column | None) -> Column | None:
    if now is None or isinstance(now, Column):
        return now
    return F.lit(now).cast("timestamp") if isinstance(now, str) else F.lit(now)


def validate(
    messages: DataFrame,
    rules: Mapping[str, FieldSpec] = TELEMETRY_RULES,
    now: dt.datetime | str | Column | None = None,
    keys: Sequence[str] = KEY_COLUMNS,
) -> DataFrame:
    """Field violations (Q24): one row per (message, failing field) with ``invalid_value``.

    ``messages`` are strictly decoded messages plus key columns; rows whose
    decode failed (all fields NULL with ``decoded`` NULL) belong to
    ``check_decodes`` and should be filtered out before.
    """
    conds, _, _ = rule_conditions(rules, _as_timestamp(now))
    failures = F.array_compact(
        F.array(
            *[
                F.when(not_true(cond), F.struct(F.lit(name).alias("field"), F.col(name).cast("string").alias("invalid_value")))
                for name, cond in conds.items()
            ]
        )
    )
    present = [k for k in keys if k in messages.columns]
    return messages.select(*present, F.explode(failures).alias("v")).select(*present, "v.field", "v.invalid_value")


def unchecked_rules(rules: Mapping[str, FieldSpec] = TELEMETRY_RULES) -> list[str]:
    """Rules that cannot be checked as conditions (Q22): reported, never silently dropped."""
    return rule_conditions(rules)[1]


def check_decodes(df: DataFrame, decoded_col: str = "decoded", message_type: str | None = None, type_col: str | None = "message_type") -> DataFrame:
    """Rows whose bytes did not decode (Q23)."""
    rows = df if message_type is None or type_col is None else df.where(F.col(type_col) == message_type)
    return rows.where(F.col(decoded_col).isNull())


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULLs are ignored (Q26)."""
    return duplicates(df.where(F.col(column).isNotNull()), [column])


def check_unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return duplicates(df, list(columns))


def check_accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Rows with a value outside the list; NULL passes (Q28)."""
    return df.where(~F.col(column).isin(list(values)))


def check_relationship(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent."""
    keys = parent.select(F.col(parent_column).alias(column)).distinct()
    return child.where(F.col(column).isNotNull()).join(keys, on=column, how="left_anti")


def check_freshness(df: DataFrame, column: str, now: dt.datetime | str | Column, max_age_seconds: float | None = None) -> DataFrame:
    """Age of the newest row in seconds (Q32); ``stale`` when over ``max_age_seconds``."""
    now_col = _as_timestamp(now)
    age = F.unix_micros(now_col.cast("timestamp")) - F.unix_micros(F.max(F.col(column)).cast("timestamp"))
    out = df.agg((age / 1_000_000).alias("age_seconds"))
    if max_age_seconds is not None:
        out = out.withColumn("stale", F.coalesce(F.col("age_seconds") > max_age_seconds, F.lit(True)))
    return out


@dataclass
class Check:
    """A named check: a function from the candidate table to its failing rows."""

    name: str
    failing: Callable[[DataFrame], DataFrame]


def count_failures(df: DataFrame, failing: Mapping[str, Column]) -> DataFrame:
    """Row-level checks in one pass: ``failing`` maps a check name to the condition of a bad row.

    One aggregation (a count per check) then one row per check: (check, failures).
    """
    agg = df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in failing.items()])
    pairs = F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).alias("failures")) for n in failing])
    return agg.select(F.explode(pairs).alias("p")).select("p.check", "p.failures")


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row per check: name and number of failing rows (Q31: any query returning bad rows)."""
    counts = [c.failing(df).agg(F.count(F.lit(1)).alias("failures")).select(F.lit(c.name).alias("check"), "failures") for c in checks]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


def publish_if_valid(
    spark: SparkSession,
    df: DataFrame,
    row_checks: Mapping[str, Column],
    path: str,
    table_checks: Sequence[Check] = (),
    partition_by: Sequence[str] = (),
) -> dict:
    """Gate (Q33): write ``df`` to a staging folder while counting failing rows in the same pass.

    ``row_checks`` map a name to a condition every valid row meets; they are
    counted with an ``Observation`` during the staged write, so the data is
    computed once. ``table_checks`` (uniqueness, relationships) then run on
    the staged copy. Only when every count is zero is the staged copy
    published to ``path`` (overwrite); otherwise ``path`` is left untouched.
    """
    staged = work_path(spark, "staged")
    obs = Observation("quality_gate")
    observed = df.observe(obs, F.count(F.lit(1)).alias("_rows"), *[F.sum(not_true(c).cast("long")).alias(n) for n, c in row_checks.items()])
    writer = observed.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(staged)
    metrics = obs.get
    failures = {n: int(metrics.get(n) or 0) for n in row_checks}
    staged_df = spark.read.parquet(staged)
    for c in table_checks:
        failures[c.name] = c.failing(staged_df).count()
    passed = all(v == 0 for v in failures.values())
    if passed:
        writer = spark.read.parquet(staged).write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "static")
        writer.parquet(path)
    return {"published": passed, "rows": int(metrics.get("_rows") or 0), "failures": failures, "staged": staged}


def publish_version(
    spark: SparkSession,
    df: DataFrame,
    row_checks: Mapping[str, Column],
    path: str,
    table_checks: Sequence[Check] = (),
    partition_by: Sequence[str] = (),
    base: int | None = None,
    keep: int = 2,
) -> dict:
    """Gate (Q33) onto a versioned table: the rows are written once, checked, and then made visible by one manifest.

    ``row_checks`` are counted while the rows are written, ``table_checks`` on
    what was written. If all pass, the written files become the next version;
    otherwise they are deleted and readers never see them. ``base`` is the
    version that ``df`` was made from: a publisher that lost the race to it gets
    ``Conflict`` and its files are deleted too.
    """
    from fleetspark.sources.versioned import VersionedTable

    table = VersionedTable(spark, path)
    written = table.write(df, partition_by, {n: F.count_if(not_true(c)) for n, c in row_checks.items()})
    failures = {n: int(written.metrics.get(n) or 0) for n in row_checks}
    rows = table.rows(written.schema, written.entries)
    failures |= {c.name: c.failing(rows).count() for c in table_checks}
    report = {"published": False, "rows": int(written.metrics.get("rows") or 0), "failures": failures, "version": None}
    if any(failures.values()):
        table.discard(written)
        return report
    version = table.replace(written, base=base)
    table.expire(keep)
    return report | {"published": True, "version": version.number}
