"""The full build (lifecycle L1): source checks, staging once, marts, checks, history.

Staging is computed once and written; the marts read the written table, so the
decode, the de-duplication shuffle and the distance window run once per build.
Staging is partitioned by ``event_date`` so that incremental readers prune.

Every table is a versioned one: its readers see the last version whole until the
next is put. Steps form a graph. A step publishes its table only when its checks pass
(Q33); if they do not, the previous table stays and every step that needs the
failed one is skipped and reported as such. The rule checks of the raw messages
come first.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspark.model import ACCEPTED_EVENT_TYPES, ACCEPTED_VEHICLE_TYPES
from fleetspark.operators import marts
from fleetspark.operators.incremental import new_since
from fleetspark.operators.snapshot import History
from fleetspark.operators.staging import stage_readings
from fleetspark.plans import quality as q
from fleetspark.plans.quality import Check
from fleetspark.sources.versioned import VersionedTable, merge_into


def source_failures(messages: DataFrame) -> dict[str, int]:
    """Messages that break the rules of each field (Q24), counted in one pass; only failing fields are listed."""
    strict = q.strict_values(messages)
    return {r["field"]: r["n"] for r in q.validate(strict).groupBy("field").agg(F.count("*").alias("n")).collect()}


def publish_events(spark: SparkSession, stg: DataFrame, dim: DataFrame, path: str) -> dict:
    """Merges the events of new readings into the event fact if they pass its checks."""
    table = VersionedTable(spark, path)
    new = marts.vehicle_events(new_since(stg, table.read_or_none()))
    checks = [
        q.Check("event_id_unique", lambda df: q.check_unique(df, "event_id")),
        q.Check("vehicle_in_dim", lambda df: q.check_relationship(df, "vehicle_id", dim, "vehicle_id")),
    ]

    def failures(events: DataFrame) -> dict[str, int]:
        rows = {"event_id_not_null": F.col("event_id").isNull(), "event_type_accepted": ~F.col("event_type").isin(ACCEPTED_EVENT_TYPES)}
        counted = q.count_failures(events, rows).unionByName(q.run_checks(events, checks))
        return {r["check"]: r["failures"] for r in counted.collect()}

    version, failed = merge_into(table, new, ["event_id"], ["event_date"], failures)
    table.expire()
    return {"published": version is not None, "failures": failed}


def build(spark: SparkSession, messages: DataFrame, out: str, snapshot_runs: bool = True, source_checks: str = "error") -> dict:
    """Builds staging, dimension, daily fact, latest status, event fact and dimension history under ``out``.

    ``source_checks``: "error" builds nothing while raw messages break rules,
    "report" counts them and goes on. The report has for each step whether it
    was ``published`` or ``skipped``, its failures and its time.
    """
    out = out.rstrip("/")
    report: dict = {"timings": {}}
    table = lambda name: VersionedTable(spark, f"{out}/{name}").read()

    def step(name: str, needs: tuple[str, ...], run) -> None:
        unmet = [n for n in needs if not report[n]["published"]]
        if unmet:
            report[name] = {"published": False, "skipped": True, "because": unmet}
            return
        began = time.time()
        report[name] = {"skipped": False, **run()}
        report["timings"][name] = round(time.time() - began, 3)

    def gated(name: str, make, not_null: tuple[str, ...], unique: Check, extra: dict | None = None, partition_by: tuple[str, ...] = ()):
        rows = {f"{c}_not_null": F.col(c).isNotNull() for c in not_null} | (extra or {})
        return lambda: q.publish_version(spark, make(), rows, f"{out}/{name}", table_checks=[unique], partition_by=partition_by)

    def sources() -> dict:
        failures = source_failures(messages)
        return {"published": source_checks == "report" or not failures, "failures": failures}

    def history() -> dict:
        History(spark, f"{out}/dim_vehicles_snapshot", "vehicle_id").run(table("dim_vehicles"), updated_at="last_seen_at")
        return {"published": True, "failures": {}}

    one_vehicle = q.Check("vehicle_id_unique", lambda df: q.check_unique(df, "vehicle_id"))
    one_message = q.Check("message_id_unique", lambda df: q.check_unique(df, "message_id"))
    one_day = q.Check("vehicle_day_unique", lambda df: q.check_unique_combination(df, ["vehicle_id", "event_date"]))
    known_type = {"vehicle_type_accepted": F.col("vehicle_type").isin(ACCEPTED_VEHICLE_TYPES) | F.col("vehicle_type").isNull()}
    stg, dim = "stg_vehicle_telemetry", "dim_vehicles"
    not_null = ("message_id", "vehicle_id", "recorded_at", "latitude", "longitude")

    step("sources", (), sources)
    step("staging", ("sources",), gated(stg, lambda: stage_readings(messages), not_null, one_message, known_type, ("event_date",)))
    step("dim_vehicles", ("staging",), gated(dim, lambda: marts.dim_vehicles(table(stg)), ("vehicle_id",), one_vehicle))
    step("fct_vehicle_daily", ("staging",), gated("fct_vehicle_daily", lambda: marts.daily(table(stg)), (), one_day))
    step("vehicle_latest_status", ("staging",), gated("vehicle_latest_status", lambda: marts.latest_status(table(stg)), ("vehicle_id",), one_vehicle))
    step("fct_vehicle_events", ("staging", "dim_vehicles"), lambda: publish_events(spark, table(stg), table(dim), f"{out}/fct_vehicle_events"))
    if snapshot_runs:
        step("dim_vehicles_snapshot", ("dim_vehicles",), history)
    return report
