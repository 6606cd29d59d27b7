import datetime as dt

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from conftest import rows_of
from syncflow import storage
from syncflow.operators import partitions, transform
from syncflow.sinks import append, outputs
from syncflow.sinks.commits import CommitLog
from syncflow.sinks.keyed import KeyedTable
from syncflow.sources.events import decode_json
from test_changelog import SCHEMA, log, replay

DAYS = "id int, partition_day date"


def lose(*args, **kwargs):
    raise OSError("lost")


def day_rows(spark, ids, day):
    return spark.createDataFrame([(i, dt.date.fromisoformat(day)) for i in ids], DAYS)


def test_append_keeps_duplicates_and_ignores_repeated_labels(spark, tmp_path):
    path = str(tmp_path / "t")
    assert append.append_by_day(day_rows(spark, [1, 1, 2], "2024-01-01"), path, "a")
    assert not append.append_by_day(day_rows(spark, [9], "2024-01-01"), path, "a")
    assert append.append_by_day(day_rows(spark, [1, 3], "2024-01-01"), path, "b")
    assert rows_of(append.read_by_day(spark, path), "id") == [(1,), (1,), (1,), (2,), (3,)]
    assert CommitLog(spark, path).labels() == ["a", "b"]


def test_labels_are_kept_and_found(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "t"))
    assert log.head() == -1 and log.last() == {}
    for n in range(4):
        log.record(f"l{n}", "me", number=n)
    assert log.labels() == ["l0", "l1", "l2", "l3"] and log.last()["number"] == 3
    assert log.has("l0") and log.has("l0", "me") and not log.has("l9")
    with pytest.raises(ValueError):
        log.has("l0", "you")
    # As if the writer had stopped right after the commit file.
    storage.delete(spark, log._label_path("l3"))
    storage.write_text(spark, f"{log.commits}/_head", "2")
    assert log.head() == 3 and log.has("l3")


def test_many_loads_are_listed_and_merged(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(append, "_LISTED_EVERY", 3)
    path = str(tmp_path / "t")
    for n in range(8):
        append.append_by_day(day_rows(spark, [n], f"2024-01-0{n % 2 + 1}"), path, str(n))
    assert append.merge_loads(spark, path) == 8 and append.merge_loads(spark, path) == 0
    append.append_by_day(day_rows(spark, [8], "2024-01-01"), path, "8")
    assert append.drop_replaced(spark, path) == 8
    assert rows_of(append.read_by_day(spark, path), "id") == [(n,) for n in range(9)]
    assert not append.append_by_day(day_rows(spark, [0], "2024-01-01"), path, "3")


def test_reader_sees_one_state(spark, tmp_path):
    path = str(tmp_path / "t")
    append.append_by_day(day_rows(spark, [1], "2024-01-01"), path, "1")
    seen = append.read_by_day(spark, path)
    append.append_by_day(day_rows(spark, [2], "2024-01-01"), path, "2")
    assert rows_of(seen, "id") == [(1,)]


def test_columns_are_kept_added_and_widened(spark, tmp_path):
    path = str(tmp_path / "t")
    append.append_by_day(spark.sql("SELECT 1 AS id, '2024-01-01' AS partition_day"), path, "1")
    append.append_by_day(spark.sql("SELECT 3000000000 AS id, 'x' AS v, '2024-01-02' AS partition_day"), path, "2")
    append.append_by_day(spark.sql("SELECT 3 AS id, '2024-01-02' AS partition_day"), path, "3")
    got = append.read_by_day(spark, path)
    assert got.dtypes == [("id", "bigint"), ("partition_day", "string"), ("v", "string")]
    assert rows_of(got) == [(1, "2024-01-01", None), (3, "2024-01-02", None), (3000000000, "2024-01-02", "x")]
    with pytest.raises(ValueError, match="holds"):
        append.append_by_day(spark.sql("SELECT 'text' AS id, '2024-01-01' AS partition_day"), path, "4")


def test_broken_load_is_invisible_and_repeatable(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    append.append_by_day(day_rows(spark, [1], "2024-01-01"), path, "1")
    with monkeypatch.context() as m:
        m.setattr(CommitLog, "record", lose)
        with pytest.raises(OSError):
            # With other days than the attempt that will succeed.
            append.append_by_day(day_rows(spark, [2, 9], "2024-01-07"), path, "2")
    assert rows_of(append.read_by_day(spark, path), "id") == [(1,)]
    assert append.append_by_day(day_rows(spark, [2, 3], "2024-01-01"), path, "2")
    assert rows_of(append.read_by_day(spark, path), "id") == [(1,), (2,), (3,)]


def test_day_filter_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    for d in ("2024-01-01", "2024-01-02"):
        append.append_by_day(day_rows(spark, [1], d), path, d)
    kept = partitions.retained(append.read_by_day(spark, path), as_of="2024-01-02", days=0)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(partition_day" in plan
    assert kept.count() == 1


def test_retention_drops_old_days_only(spark, tmp_path):
    path = str(tmp_path / "t")
    for d in ("2024-01-01", "2024-01-02", "2024-04-01"):
        append.append_by_day(day_rows(spark, [1], d), path, d)
    assert append.drop_old_days(spark, path, dt.date(2024, 4, 1)) == ["2024-01-01"]
    days = [r[0].isoformat() for r in append.read_by_day(spark, path).select("partition_day").collect()]
    assert sorted(days) == ["2024-01-02", "2024-04-01"]


def test_partition_coverage(spark):
    df = day_rows(spark, [1, 2], "2024-04-01").union(day_rows(spark, [3], "2023-01-01"))
    report = {r[0].isoformat(): r[1] for r in partitions.partition_coverage(df, as_of="2024-04-01").collect()}
    assert len(report) == 94 and report["2024-04-01"] == 2 and report["2024-04-04"] == 0
    assert min(report) == "2024-01-02"


def keyed(spark, tmp_path, buckets=4):
    return KeyedTable(spark, str(tmp_path / "k"), ["id"], ["seq"], buckets)


@pytest.mark.parametrize("enable_delete, max_deltas", [(True, 0), (False, 0), (True, 1), (False, 9)])
def test_keyed_table_equals_a_replay(spark, tmp_path, enable_delete, max_deltas):
    rows = log(n=120)
    table = keyed(spark, tmp_path)
    # Overlapping slices, one of them late and one repeated under another label.
    for number, (lo, hi) in enumerate([(0, 60), (80, 120), (40, 90), (40, 90)]):
        table.upsert(spark.createDataFrame(rows[lo:hi], SCHEMA), f"s{number}", enable_delete, max_deltas)
    assert rows_of(table.read(), "id", "seq", "v", "day") == replay(rows, enable_delete)


def test_keyed_table_ignores_a_repeated_label(spark, tmp_path):
    table = keyed(spark, tmp_path)
    assert table.upsert(spark.createDataFrame([(1, 1, "a", "d", "upsert")], SCHEMA), "x")
    assert not table.upsert(spark.createDataFrame([(1, 2, "b", "d", "upsert")], SCHEMA), "x")
    assert rows_of(table.read(), "v") == [("a",)]


def test_late_change_does_not_bring_a_deleted_key_back(spark, tmp_path):
    table = keyed(spark, tmp_path)
    table.upsert(spark.createDataFrame([(1, 5, "a", "d", "delete")], SCHEMA), "x")
    table.upsert(spark.createDataFrame([(1, 4, "b", "d", "upsert")], SCHEMA), "y")
    assert table.read().isEmpty()


def test_moved_day_leaves_no_copy_behind(spark, tmp_path):
    table = keyed(spark, tmp_path)
    table.upsert(spark.createDataFrame([(1, 1, "a", "2024-01-01", "upsert")], SCHEMA), "x")
    table.upsert(spark.createDataFrame([(1, 2, "a", "2024-01-02", "upsert")], SCHEMA), "y")
    assert rows_of(table.read(), "id", "day") == [(1, "2024-01-02")]


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    table = keyed(spark, tmp_path, buckets=8)
    table.upsert(spark.createDataFrame([(i, 1, "a", "d", "upsert") for i in range(50)], SCHEMA), "x")
    table.upsert(spark.createDataFrame([(7, 2, "b", "d", "upsert")], SCHEMA), "y")
    assert sorted(table.files().values()) == [[0]] * 7 + [[1]]
    assert table.drop_old_versions() == 1
    assert table.read().count() == 50


def test_changes_wait_beside_a_bucket(spark, tmp_path):
    table = keyed(spark, tmp_path, buckets=2)
    for n in range(4):
        table.upsert(spark.createDataFrame([(1, n, f"v{n}", "d", "upsert")], SCHEMA), f"{n}", max_deltas=2)
        assert rows_of(table.read(), "v") == [(f"v{n}",)]
        want = [[0], [0, 1], [0, 1, 2], [3]][n]
        assert list(table.files().values()) == [want]
    assert table.drop_old_versions() == 3
    assert rows_of(table.read(), "v") == [("v3",)]


def test_of_equal_places_the_later_load_counts(spark, tmp_path):
    table = keyed(spark, tmp_path)
    for label, v in (("x", "b"), ("y", "c"), ("z", "a")):
        table.upsert(spark.createDataFrame([(1, 5, v, "d", "upsert")], SCHEMA), label, max_deltas=9)
        assert rows_of(table.read(), "v") == [(v,)]


def test_broken_keyed_load_leaves_the_old_rows(spark, tmp_path, monkeypatch):
    table = keyed(spark, tmp_path)
    table.upsert(spark.createDataFrame([(1, 1, "a", "d", "upsert")], SCHEMA), "x")
    change = spark.createDataFrame([(1, 2, "b", "d", "upsert")], SCHEMA)
    other = spark.createDataFrame([(i, 3, "lost", "d", "upsert") for i in range(20)], SCHEMA)
    with monkeypatch.context() as m:
        m.setattr(CommitLog, "record", lose)
        with pytest.raises(OSError):
            table.upsert(other, "y")
    assert rows_of(table.read(), "v") == [("a",)]
    assert table.upsert(change, "y")
    assert rows_of(table.read(), "v") == [("b",)]


def test_rewritten_buckets_are_scanned_and_shuffled_once(spark, tmp_path):
    table = keyed(spark, tmp_path)
    table.upsert(spark.range(1000).selectExpr("int(id) id", "1 seq", "'a' v"), "x")
    state = table.state()
    schema = StructType.fromJson(state["schema"])
    batch = spark.createDataFrame(
        [(1, 2, "b", "upsert", 1, 0)],
        "id int, seq int, v string, _mirror_kind string, _mirror_version bigint, _mirror_bucket int",
    )
    plan = table._merged(schema, table.files(state), batch)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1 and "Join" not in plan


def test_columns_of_any_name(spark, tmp_path):
    rows = "SELECT id, 1 AS seq, id * 2 AS version, 'b' AS bucket, 'delete' AS kind FROM range(5)"
    table = KeyedTable(spark, str(tmp_path / "k"), ["id"], ["seq"], 3, kind=None)
    table.upsert(spark.sql(rows), "x")
    table.upsert(spark.sql(rows).where("id = 2").withColumn("seq", F.lit(2)), "y", max_deltas=3)
    assert rows_of(table.read(), "id", "version", "bucket", "kind") == [(i, 2 * i, "b", "delete") for i in range(5)]
    with pytest.raises(ValueError):
        table.upsert(spark.sql("SELECT 1 AS id, 1 AS seq, 1 AS _mirror_kind"), "z")


@pytest.mark.parametrize("max_deltas", [0, 5])
def test_new_columns_and_wider_keys(spark, tmp_path, max_deltas):
    table = keyed(spark, tmp_path)
    table.upsert(spark.range(8).selectExpr("int(id) id", "1 seq", "'a' v"), "x", max_deltas=max_deltas)
    table.upsert(spark.range(4, 10).selectExpr("id", "2 seq", "'b' v", "1.5 w"), "y", max_deltas=max_deltas)
    table.upsert(spark.range(4, 5).selectExpr("int(id) id", "3 seq", "'c' v"), "z", max_deltas=max_deltas)
    got = {r.id: (r.v, r.w) for r in table.read().collect()}
    assert table.read().dtypes[0] == ("id", "bigint") and len(got) == 10
    assert got[0] == ("a", None) and got[4] == ("c", None) and got[9][0] == "b" and got[9][1] is not None
    with pytest.raises(ValueError):
        KeyedTable(spark, table.path, ["id"], ["seq"], 7).read()
    with pytest.raises(ValueError):
        table.upsert(spark.sql("SELECT 'k' AS id, 1 AS seq"), "w")


def test_reading_before_any_load(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        keyed(spark, tmp_path).read()


def test_fan_out_computes_once(spark, tmp_path):
    path = str(tmp_path / "f")
    df = spark.range(10).withColumn("r", F.rand())
    first, second = outputs.fan_out(df, [
        lambda d: outputs.write_json_files(d, f"{path}/json"),
        lambda d: d.write.parquet(f"{path}/parquet"),
    ])
    assert first is None and second is None
    # Random values agree only if both writers got the same computed rows.
    assert rows_of(spark.read.json(f"{path}/json"), "id", "r") == rows_of(spark.read.parquet(f"{path}/parquet"), "id", "r")


def test_kafka_records_hold_null_fields(spark):
    df = spark.createDataFrame([(1, None)], "id int, v string")
    assert rows_of(outputs.encode_for_kafka(df, ["id"])) == [('{"id":1}', '{"id":1,"v":null}')]
    assert rows_of(decode_json(outputs.encode_for_kafka(df), {"id": "INT", "v": "STRING"})) == [(1, None)]


def test_rolling_and_flush_options():
    assert outputs.rolling_options(1 << 20, 100, "1 min") == (
        {"maxRecordsPerFile": "10485"}, {"processingTime": "1 minutes"},
    )
    assert outputs.flush_options("5s", 2000) == (
        {"maxOffsetsPerTrigger": "2000"}, {"processingTime": "5 seconds"},
    )


def test_not_null_drop_is_counted(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "id int, v string")
    seen = Observation()
    assert transform.enforce_not_null(df, ["id", "v"], seen).count() == 1
    assert seen.get == {"rows_in": 3, "rows_dropped": 2}


def test_sink_columns(spark):
    df = spark.range(1).selectExpr("id", "'x' AS v")
    assert transform.sink_columns(df, {"v": "string", "id": "int"}).dtypes == [("v", "string"), ("id", "int")]
    with pytest.raises(ValueError):
        transform.sink_columns(df, ["id", "nope"])


def test_shared_folder_comes_from_the_session(spark):
    base = storage.shared_dir(spark)
    assert spark.conf.get("spark.checkpoint.dir").rstrip("/") == base
    assert storage.work_path(spark, "x").startswith(f"{base}/syncflow/x-")
