import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows_of
from syncflow.operators import changelog

SCHEMA = "id int, seq int, v string, day string, kind string"


def log(n=400, keys=20, seed=1):
    rng = random.Random(seed)
    return [
        (rng.randrange(keys), s, f"v{s}", f"2024-01-{1 + rng.randrange(5):02d}",
         "delete" if rng.random() < 0.3 else "upsert")
        for s in range(n)
    ]


def replay(rows, enable_delete=True):
    table = {}
    for row in sorted(rows, key=lambda r: r[1]):
        if row[4] == "upsert":
            table[row[0]] = row[:4]
        elif enable_delete:
            table.pop(row[0], None)
    return sorted(table.values(), key=repr)


@pytest.mark.parametrize("enable_delete", [True, False])
def test_live_rows_equal_a_replay_in_any_input_order(spark, enable_delete):
    rows = log()
    for seed in (1, 2):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, SCHEMA)
        got = changelog.live_rows(df, ["id"], ["seq"], enable_delete=enable_delete)
        assert rows_of(got, "id", "seq", "v", "day") == replay(rows, enable_delete)


def test_hot_key_sends_one_row_per_task(spark):
    df = spark.range(0, 100_000, 1, 8).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k", "id AS seq", "'upsert' AS kind"
    )
    plan = changelog.live_rows(df, ["k"], ["seq"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan
    hot = changelog.live_rows(df, ["k"], ["seq"]).where("k = 0").first()
    assert hot.seq == 99_999


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 10_000), st.integers(0, 399))
def test_merge_is_idempotent(spark, seed, start):
    rows = log(seed=seed)
    df = spark.createDataFrame(rows, SCHEMA)
    whole = changelog.latest_per_key(df, ["id"], ["seq"])
    again = changelog.merge_latest(whole, df.where(F.col("seq") >= start), ["id"], ["seq"])
    assert rows_of(again, *whole.columns) == rows_of(whole)


def test_snapshot_rows_lose_against_any_change(spark):
    snapshot = spark.createDataFrame([(1, 900, "old", "d"), (2, 901, "kept", "d")], "id int, seq int, v string, day string")
    changes = spark.createDataFrame([(1, 5, "new", "d", "upsert")], SCHEMA)
    both = changelog.snapshot_and_changes(snapshot, changes)
    got = changelog.live_rows(both, ["id"], ["phase", "seq"])
    assert rows_of(got, "id", "v") == [(1, "new"), (2, "kept")]
    only = changelog.snapshot_and_changes(snapshot, changes, "initial", "never")
    assert rows_of(only, "id", "v") == [(1, "new")]


def test_append_count_and_unique_count(spark):
    rows = log()
    report = changelog.append_versus_unique(
        spark.createDataFrame(rows, SCHEMA), ["id"], ["seq"], "day"
    ).collect()
    assert sum(r.appended_rows for r in report) == len(rows)
    assert sum(r.live_keys for r in report) == len(replay(rows))


def test_moved_days(spark):
    rows = [
        (1, 1, "a", "d1", "upsert"), (1, 2, "b", "d2", "upsert"),
        (2, 1, "a", "d1", "upsert"), (2, 2, "b", "d1", "upsert"),
        (3, 1, "a", "d1", "upsert"), (3, 2, "b", "d2", "delete"),
    ]
    got = changelog.moved_days(spark.createDataFrame(rows, SCHEMA), ["id"], ["seq"], "day")
    assert rows_of(got) == [(1, "d1", "d2")]


def test_latest_row_with_maps(spark):
    rows = [(1, 1, {"a": 1}, [{"x": 2}]), (1, 3, {"b": 2, "a": 0}, []), (1, 2, {}, None), (2, 1, None, None)]
    df = spark.createDataFrame(rows, "id int, seq int, m map<string,int>, l array<map<string,int>>")
    got = changelog.latest_per_key(df, ["id"], ["seq"]).collect()
    assert sorted((r.id, r.seq, r.m) for r in got) == [(1, 3, {"b": 2, "a": 0}), (2, 1, None)]
    # Rows that tie are told apart in the same way, whatever their order.
    tied = [(1, 1, {"a": n}, None) for n in (3, 1, 2)]
    some = {changelog.latest_per_key(spark.createDataFrame(t, df.schema), ["id"], ["seq"]).first().m["a"] for t in (tied, tied[::-1])}
    assert some == {3}
