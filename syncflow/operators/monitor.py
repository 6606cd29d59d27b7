"""Monitoring rules over job-status, metric and alert tables.

The rules look at each key in time order, and one key, or one hour of it, may hold a large part of
all rows. Rows are therefore dealt out by ranges of (key, time) of equal size, and ordered within
(key, range) only. What a range passes on is aggregated ahead of the shuffle, and just these
summaries, as many as a key has ranges, are ordered along the whole key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from syncflow.functions.classify import classify
from syncflow.functions.times import as_col
from syncflow.operators.ordered import AT, PART, in_order, within_part

# States, thresholds and levels of the monitoring rules.
RUNNING = "RUNNING"
BROKEN_STATES = ("FAILED", "CANCELED")
NOT_FOUND = "NOT_FOUND"
FAILED_CHECK_STATES = ("ERROR",)
FAILURES_PER_ALERT = 3
RESOURCE_LIMITS = {"disk": 85, "memory": 90, "cpu": 80}
PASSING_INFO_TYPES = ("recovery", "daily_report")
REPORT_HOUR = 8


def _ranges(status: DataFrame, key: str, ts: str, tie: Sequence[str]) -> DataFrame:
    """Rows by ranges of (key, time); without a time there is no order to be part of (see ``untimed``)."""
    return in_order(status.where(F.col(ts).isNotNull()), key, ts, *tie)


def untimed(rows: DataFrame, ts: str) -> DataFrame:
    """The rows that the rules in time order leave out, to be counted or kept elsewhere."""
    return rows.where(F.col(ts).isNull())


def state_transitions(
    status: DataFrame,
    key: str,
    state: str,
    ts: str,
    tie: Sequence[str] = (),
) -> DataFrame:
    """Rows whose state differs from the one before; the first row of a key counts as a change.

    Adds ``previous_state`` and ``alert_level``: info for RUNNING, error for a broken job,
    NULL for a change nobody is told about.
    """
    within = within_part(key)
    seen = _ranges(status, key, ts, tie).select(
        *status.columns,
        AT,
        PART,
        F.lag(state).over(within).alias("previous_state"),
        (F.row_number().over(within) == 1).alias("_first"),
        F.lead(F.lit(True)).over(within).isNull().alias("_last"),
    )
    # Ahead of the first row of a range comes the last row of the range before. So the edge
    # rows, two per key and range at most, are ordered along the key, and the other changes stay
    # in groups of their range.
    is_edge = F.col("_first") | F.col("_last")
    changed = ~F.col(state).eqNullSafe(F.col("previous_state"))
    along = Window.partitionBy(key, "_inner").orderBy(AT)
    found = (
        seen.where(is_edge | changed)
        .withColumn("_inner", F.when(~is_edge, F.col(PART)))
        .withColumn("_before", F.lag(state).over(along))
        .withColumn(
            "previous_state", F.when(F.col("_first"), F.col("_before")).otherwise(F.col("previous_state"))
        )
    )
    level = F.when(F.col(state) == RUNNING, "info").when(F.col(state).isin(*BROKEN_STATES), "error")
    return found.where(changed).select(*status.columns, "previous_state", level.alias("alert_level"))


def job_alerts(
    status: DataFrame,
    key: str,
    state: str,
    ts: str,
    tie: Sequence[str] = (),
) -> DataFrame:
    """Alerts of the status poller: told state changes, and every sighting of a missing job."""
    changes = state_transitions(status, key, state, ts, tie).where("alert_level IS NOT NULL")
    missing = not_found_alerts(status, state)
    return changes.drop("previous_state").unionByName(missing)


def not_found_alerts(status: DataFrame, state: str) -> DataFrame:
    """A job that is not found alerts each time, changed or not."""
    return status.where(F.col(state) == NOT_FOUND).withColumn("alert_level", F.lit("error"))


def metric_rollup(metrics: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Sums per job over its parts, a missing reading counting as 0."""
    return metrics.groupBy(key).agg(
        *[F.sum(F.coalesce(F.col(c), F.lit(0))).alias(f"total_{c}") for c in columns]
    )


def failure_alerts(
    status: DataFrame,
    key: str,
    state: str,
    ts: str,
    tie: Sequence[str] = (),
    every: int = FAILURES_PER_ALERT,
    failed: Sequence[str] = FAILED_CHECK_STATES,
    reset: Sequence[str] = (RUNNING,),
) -> DataFrame:
    """Every ``every``-th failed check in a row; a reset state starts the count again.

    Other states neither count nor reset. ``failures`` numbers the failed check within its
    run, so an alert that sets the counter back to 0 is one whose number divides evenly.
    """
    is_failed, is_reset = F.col(state).isin(*failed), F.col(state).isin(*reset)
    rows = _ranges(status.where(is_failed | is_reset), key, ts, tie)
    so_far = within_part(key).rowsBetween(Window.unboundedPreceding, 0)
    # Failures since the last reset: the running count less its value at that reset.
    counted = (
        rows.withColumn("_fails", F.count_if(is_failed).over(so_far))
        .withColumn("_at_reset", F.max(F.when(is_reset, F.col("_fails"))).over(so_far))
    )
    # What a range hands on: the failures after its last reset, or all if it has none.
    edges = counted.groupBy(key, PART).agg(
        (F.max("_fails") - F.coalesce(F.max("_at_reset"), F.lit(0))).alias("_tail"),
        F.max("_at_reset").isNotNull().alias("_has_reset"),
    )
    along = Window.partitionBy(key).orderBy(PART)
    in_run = Window.partitionBy(key, "_run").orderBy(PART)
    to_here = (Window.unboundedPreceding, Window.currentRow)
    carried = (
        edges.withColumn("_run", F.count_if("_has_reset").over(along.rowsBetween(*to_here)))
        .withColumn("_out", F.sum("_tail").over(in_run.rowsBetween(*to_here)))
        .withColumn("_carry", F.lag("_out", 1, 0).over(along))
        .select(key, PART, "_carry")
    )
    number = F.when(F.col("_at_reset").isNull(), F.col("_fails") + F.col("_carry")).otherwise(
        F.col("_fails") - F.col("_at_reset")
    )
    return (
        counted.where(is_failed)
        .join(
            carried.toDF("_key", "_range", "_carry"),
            F.col(key).eqNullSafe(F.col("_key")) & (F.col(PART) == F.col("_range")),
        )
        .withColumn("failures", number)
        .where(F.col("failures") % every == 0)
        .select(*status.columns, "failures")
    )


def resubmit_actions(
    status: DataFrame,
    expected: DataFrame,
    job: str,
    name: str,
    state: str,
    ts: str,
    tie: Sequence[str] = (),
    keyword: str = "kafka",
) -> DataFrame:
    """What to do about each watched job: ``restart`` a broken one, ``resubmit`` a missing one.

    Watched are the jobs whose name contains ``keyword``. Only the last state of a job
    counts, and a job of ``expected`` without any status is missing.
    """
    order = [ts, *tie]
    last = (
        status.where(F.lower(name).contains(keyword))
        .groupBy(job)
        .agg(F.max(F.struct(*order, name, state)).alias("_last"))
        .select(job, F.col(f"_last.{name}").alias(name), F.col(f"_last.{state}").alias(state))
    )
    broken = last.where(F.col(state).isin(*BROKEN_STATES)).withColumn("action", F.lit("restart"))
    missing = (
        expected.where(F.lower(name).contains(keyword))
        .join(last, job, "left_anti")
        .select(job, name, F.lit(None).cast("string").alias(state), F.lit("resubmit").alias("action"))
    )
    return broken.unionByName(missing)


def route_alerts(alerts: DataFrame, level: str = "level", alert_type: str = "alert_type") -> DataFrame:
    """Alerts that are sent: all but plain info; recoveries and daily reports always pass."""
    passes = F.coalesce(F.col(alert_type).isin(*PASSING_INFO_TYPES), F.lit(False))
    return alerts.where(~F.col(level).eqNullSafe("info") | passes)


def daily_report(
    alerts: DataFrame, ts: str, counts: Mapping[str, Column], hour: int = REPORT_HOUR
) -> DataFrame:
    """One summary per working day, of the 24 hours before it is sent at ``hour``."""
    shifted = F.date_add(F.to_date(F.col(ts) - F.expr(f"INTERVAL {hour} HOURS")), 1)
    return (
        alerts.groupBy(shifted.alias("report_day"))
        .agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(n) for n, c in counts.items()])
        .where(F.weekday("report_day") < 5)
    )


def resource_alerts(
    readings: DataFrame,
    metric: str = "metric",
    value: str = "value",
    limits: Mapping[str, float] = RESOURCE_LIMITS,
) -> DataFrame:
    """Readings above the limit of their metric."""
    above = [(F.col(metric) == m) & (F.col(value) > limit) for m, limit in limits.items()]
    return readings.where(reduce(lambda a, b: a | b, above))


def job_types(jobs: DataFrame, name, **rules) -> DataFrame:
    """Jobs per type, the type being guessed from the job name."""
    return jobs.groupBy(classify(as_col(name), **rules).alias("job_type")).agg(
        F.count(F.lit(1)).alias("jobs")
    )
