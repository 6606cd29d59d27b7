import datetime as dt
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows_of
from syncflow.operators import monitor, ordered, reconcile, suppression
from syncflow.operators.suppression import suppress_repeats

STATES = ["RUNNING", "FAILED", "CANCELED", "NOT_FOUND", "ERROR"]
START = dt.datetime(2024, 1, 1)
SCHEMA = "job string, state string, ts timestamp_ntz, n int"
FEW = settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def history(seed, n=300, jobs=4):
    """A status history in which the first job has about a third more rows than its share."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        job = "hot" if rng.random() < 0.4 else f"j{rng.randrange(jobs)}"
        # Several rows share a time, some chunks are empty.
        at = START + dt.timedelta(seconds=rng.randrange(40) * 900)
        rows.append((job, rng.choice(STATES), at, i))
    return rows


def by_job(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r[2], r[3])):
        out.setdefault(r[0], []).append(r)
    return out


@FEW
@given(st.integers(0, 10_000))
def test_state_transitions(spark, seed):
    rows = history(seed)
    want = []
    for changes in by_job(rows).values():
        last = None
        for r in changes:
            if r[1] != last:
                level = {"RUNNING": "info", "FAILED": "error", "CANCELED": "error"}.get(r[1])
                want.append((*r, last, level))
            last = r[1]
    got = monitor.state_transitions(spark.createDataFrame(rows, SCHEMA), "job", "state", "ts", ["n"])
    assert rows_of(got) == sorted(want, key=repr)


@FEW
@given(st.integers(0, 10_000))
def test_failure_alerts(spark, seed):
    rows = history(seed)
    want = []
    for checks in by_job(rows).values():
        run = 0
        for r in checks:
            if r[1] == "RUNNING":
                run = 0
            elif r[1] == "ERROR":
                run += 1
                if run % 3 == 0:
                    want.append((*r, run))
    got = monitor.failure_alerts(spark.createDataFrame(rows, SCHEMA), "job", "state", "ts", ["n"])
    assert rows_of(got) == sorted(want, key=repr)


def test_every_window_is_bounded_by_a_range_or_by_summaries(spark):
    df = spark.createDataFrame(history(1), SCHEMA)
    plan = monitor.failure_alerts(df, "job", "state", "ts", ["n"])._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if " Window [" in line or "- Window [" in line]
    row_windows = [w for w in windows if "_fails" in w and "_tail" not in w]
    assert row_windows and all("_part" in w for w in row_windows)


def test_one_hour_of_one_job_spreads_over_ranges(spark):
    """All rows of one job within one hour: no range has more than its share, and none is alone."""
    rows = [("hot", STATES[i % 3], START + dt.timedelta(seconds=i % 3600), i) for i in range(8000)]
    df = spark.createDataFrame(rows, SCHEMA)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # these are few bytes
    try:
        sizes = [r["count"] for r in ordered.in_order(df, "job", "ts", "n").groupBy(ordered.PART).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == 4 and max(sizes) < 4000
    got = monitor.failure_alerts(df, "job", "state", "ts", ["n"], failed=["FAILED"], reset=["CANCELED"])
    want, run = [], 0
    for r in sorted(rows, key=lambda r: (r[2], r[3])):
        run = 0 if r[1] == "CANCELED" else run + (r[1] == "FAILED")
        if r[1] == "FAILED" and run % 3 == 0:
            want.append((*r, run))
    assert rows_of(got) == sorted(want, key=repr)


def test_numbers_and_values_along_the_whole_order(spark):
    rows = [(i % 7 if i % 5 else None, i * 37 % 100, i if i % 9 == 0 else None) for i in range(500)]
    placed = ordered.in_order(spark.createDataFrame(rows, "k int, at int, v int"), "k", "at", "v")
    along = sorted(rows, key=lambda r: tuple((x is not None, x or 0) for x in r))
    seen, last, want = {}, None, []
    for k, at, v in along:
        last = v if v is not None else last
        want.append((k, at, v, seen.get(k, 0), last))
        seen[k] = seen.get(k, 0) + 1
    got = ordered.filled(ordered.numbered(placed, "k"), "v", "last").orderBy("_at")
    assert [tuple(r) for r in got.select("k", "at", "v", "_index", "last").collect()] == want


def test_span_functions_compose():
    """The quiet seconds that go through spans one by one, and through the composed function at once."""
    rng = random.Random(3)
    for quiet in (1, 5, 40):
        spans = [sorted(rng.sample(range(50), rng.randrange(1, 12))) for _ in range(6)]
        steps = [suppression.span_steps(np.array(s), quiet, 50) for s in spans]
        whole = steps[0]
        for more in steps[1:]:
            whole = suppression.then(whole, more)
        for given_ in range(quiet):
            left = given_
            for seconds in spans:
                _, ready = suppression.first_after_quiet(np.array(seconds), left, quiet)
                left = max(0, ready - 50)
            assert suppression.value_at(whole, given_) == left


def greedy(rows, quiet):
    """Sequential suppression on whole seconds, alert by alert."""
    last, sent = {}, []
    for kind, at, n in sorted(rows, key=lambda r: (r[1], r[2])):
        second = int((at - dt.datetime(1970, 1, 1)).total_seconds() // 1)
        if kind not in last or second - last[kind] >= quiet:
            last[kind] = second
            sent.append((kind, at, n))
    return sorted(sent, key=repr)


@FEW
@given(st.integers(0, 10_000), st.sampled_from([1, 60, 1800, 40_000]), st.sampled_from([600, 90_000]))
def test_suppression(spark, seed, quiet, span):
    rng = random.Random(seed)
    rows = [
        ("hot" if rng.random() < 0.5 else rng.choice("ab"),
         START + dt.timedelta(milliseconds=rng.randrange(span * 1000)), i)
        for i in range(400)
    ]
    df = spark.createDataFrame(rows, "kind string, ts timestamp_ntz, n int")
    assert rows_of(suppress_repeats(df, "kind", "ts", ["n"], quiet)) == greedy(rows, quiet)


def test_suppression_boundary_is_inclusive(spark):
    rows = [("a", START + dt.timedelta(seconds=s), s) for s in (0, 1799, 1800, 3599, 3600)]
    df = spark.createDataFrame(rows, "kind string, ts timestamp_ntz, n int")
    assert [r[2] for r in rows_of(suppress_repeats(df, "kind", "ts", ["n"]))] == [0, 1800, 3600]


def test_resubmit_actions(spark):
    status = spark.createDataFrame([
        (1, "Kafka a", "RUNNING", 1), (1, "Kafka a", "FAILED", 2),
        (2, "kafka b", "FAILED", 1), (2, "kafka b", "RUNNING", 2),
        (3, "mysql c", "FAILED", 1),
    ], "id int, name string, state string, ts int")
    expected = spark.createDataFrame([(1, "Kafka a"), (4, "to KAFKA"), (5, "mysql e")], "id int, name string")
    got = monitor.resubmit_actions(status, expected, "id", "name", "state", "ts")
    assert rows_of(got) == [(1, "Kafka a", "FAILED", "restart"), (4, "to KAFKA", None, "resubmit")]


def test_routing(spark):
    rows = [
        ("error", "x"), ("warning", "x"), ("info", "x"), ("info", "recovery"), ("info", "daily_report"),
    ]
    df = spark.createDataFrame(rows, "level string, alert_type string")
    assert rows_of(monitor.route_alerts(df)) == sorted(set(rows) - {("info", "x")}, key=repr)


def test_daily_report_is_sent_on_working_days(spark):
    rows = [
        ("2024-01-05 07:59:59", "error"),  # Friday, before the report
        ("2024-01-05 08:00:00", "error"),  # goes to Saturday, which has none
        ("2024-01-07 08:00:00", "info"),  # Sunday, reported on Monday
        ("2024-01-08 07:00:00", "error"),
    ]
    df = spark.createDataFrame(rows, "t string, level string").withColumn("ts", F.col("t").cast("timestamp_ntz"))
    got = monitor.daily_report(df, "ts", {"errors": F.col("level") == "error"})
    assert [(str(d), n, e) for d, n, e in rows_of(got)] == [("2024-01-05", 1, 1), ("2024-01-08", 2, 1)]


def test_resource_limits_are_exclusive(spark):
    rows = [("disk", 85.0), ("disk", 85.1), ("memory", 90.5), ("cpu", 80.0), ("swap", 99.0), ("cpu", None)]
    df = spark.createDataFrame(rows, "metric string, value double")
    assert rows_of(monitor.resource_alerts(df)) == [("disk", 85.1), ("memory", 90.5)]


def test_metric_rollup_counts_missing_as_zero(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", None)], "job string, records int")
    assert rows_of(monitor.metric_rollup(df, "job", ["records"])) == [("a", 1), ("b", 0)]


def test_reconciliation_finds_exactly_the_damage(spark):
    source = spark.range(100).selectExpr("id", "id * 2 AS v", "string(id) AS s")
    target = (
        source.where("id <> 3").withColumn("v", F.expr("if(id = 4, -1, v)"))
        .withColumn("s", F.expr("if(id IN (4, 5), NULL, s)"))
        .unionByName(spark.sql("SELECT 200L id, 0L v, 'x' s"))
        .unionByName(source.where("id = 6"))
    )
    assert rows_of(reconcile.compare_rows(source, target, ["id"], ["v", "s"])) == [
        (200, "extra", None), (3, "missing", None), (4, "changed", "v,s"), (5, "changed", "s"),
        (6, "duplicate", None),
    ]
    assert rows_of(reconcile.compare_counts(source, target, max_diff=0)) == [(100, 101, 1, True)]
    assert rows_of(reconcile.null_counts(source, target, ["v", "s"])) == [
        ("s", 0, 2, True), ("v", 0, 0, False),
    ]
    for unique in (False, True):
        assert rows_of(reconcile.compare_rows(source, source, ["id"], ["v", "s"], unique)) == []
    once = target.dropDuplicates(["id"])
    assert rows_of(reconcile.compare_rows(source, once, ["id"], ["v", "s"], True)) == rows_of(
        reconcile.compare_rows(source, once, ["id"], ["v", "s"])
    )


def test_counts_of_a_side_without_rows(spark):
    empty = spark.range(0).withColumn("day", F.lit("d"))
    some = spark.range(3).withColumn("day", F.lit("d"))
    assert rows_of(reconcile.compare_counts(some, empty)) == [(3, 0, 3, False)]
    assert rows_of(reconcile.compare_counts(some, empty, by=["day"], max_diff=2)) == [("d", 3, 0, 3, True)]


@pytest.mark.parametrize("last, stale", [("2024-01-01 00:00:00", False), ("2023-12-31 23:59:59", True), (None, True)])
def test_freshness(spark, last, stale):
    df = spark.createDataFrame([(last,)], "t string").selectExpr("cast(t as timestamp_ntz) ts").where("ts IS NOT NULL")
    report = reconcile.freshness(df, "ts", "2024-01-01 00:10:00").first()
    assert report.stale is stale


def test_digests_equal_a_comparison_by_key(spark):
    rows = [(i if i else None, i * 0.5 if i % 7 else None, f"s{i}") for i in range(3000)]
    schema = "id int, v double, s string"
    source = spark.createDataFrame(rows, schema)
    changed = [(i, v if (i or 0) % 500 else 9.0, s) for i, v, s in rows if (i or 1) % 700] + [(9999, None, None)]
    target = spark.createDataFrame(changed, schema)
    by_key = rows_of(reconcile.compare_rows(source, target, ["id"], ["v", "s"], True))
    assert len(by_key) > 5 and rows_of(reconcile.compare_digests(source, target, ["id"], ["v", "s"])) == by_key
    # Equal sides differ in no bucket, a NULL key included, so no row of them is exchanged.
    *_, unlike = reconcile.unlike_buckets(source, source, ["id"], ["v", "s"])
    assert unlike.isEmpty()
    assert reconcile.compare_rows(source, source, ["id"], ["v", "s"], True).isEmpty()
    lost = reconcile.compare_rows(source, source.where("id IS NOT NULL"), ["id"], ["v", "s"], True)
    assert rows_of(lost, "id", "status") == [(None, "missing")]
    *_, unlike = reconcile.unlike_buckets(source, target, ["id"], ["v", "s"])
    assert 0 < unlike.count() <= len(by_key)


def test_digest_tells_where_a_null_is(spark):
    source = spark.createDataFrame([(1, None, "a")], "id int, v string, s string")
    target = spark.createDataFrame([(1, "a", None)], "id int, v string, s string")
    assert rows_of(reconcile.compare_digests(source, target, ["id"], ["v", "s"])) == [(1, "changed", "v,s")]
