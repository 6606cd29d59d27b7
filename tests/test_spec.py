import functools
import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from conftest import rows_of
from syncflow import SyncSpec, build, run
from syncflow.plans.spec import keyed_table
from syncflow.sinks.append import read_by_day
from syncflow.sinks.outputs import print_rows

FIELDS = {"uid": "BIGINT", "user_ip": "STRING", "timestamp": "STRING"}


def lines(path, records):
    path.mkdir(parents=True, exist_ok=True)
    (path / "a.json").write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in records))
    return str(path)


def event_spec(tmp_path, **sink):
    source = lines(tmp_path / "in", [
        {"uid": 1, "timestamp": "1704067200000"},
        {"uid": 2, "user_ip": "192.0.2.1", "timestamp": "bad"},
        {"timestamp": "1704067200000"},
        "broken",
    ])
    return {
        "name": "events",
        "source": {"kind": "text", "fields": FIELDS, "options": {"path": source}},
        "transform": {
            "filter": "uid IS NOT NULL",
            "clean": {"user_ip": "COALESCE(user_ip, '0.0.0.0')"},
            "mapping": {"uid": "id", "user_ip": "ip"},
        },
        "sink": {"model": "append", "path": str(tmp_path / "out"), "event_millis": "timestamp", **sink},
    }


def test_build(spark, tmp_path):
    spec = SyncSpec.from_dict(event_spec(tmp_path, columns=["id", "ip", "partition_day"], day_as_text=True))
    got = build(spark, spec, fallback_day="2000-01-01")
    assert got.columns == ["id", "ip", "partition_day"]
    assert rows_of(got) == [(1, "0.0.0.0", "2024-01-01"), (2, "192.0.2.1", "2000-01-01")]


def test_batch_and_stream_write_the_same(spark, tmp_path):
    given = event_spec(tmp_path)
    batch = SyncSpec.from_dict(given)
    assert run(spark, batch, "batch", label="1", fallback_day="2000-01-01")
    assert not run(spark, batch, "batch", label="1", fallback_day="2000-01-01")
    given["sink"]["path"] = str(tmp_path / "streamed")
    run(
        spark, SyncSpec.from_dict(given), "stream", checkpoint=str(tmp_path / "cp"),
        fallback_day="2000-01-01",
    ).awaitTermination()
    columns = ["id", "ip", "partition_day"]
    a = read_by_day(spark, str(tmp_path / "out"))
    b = read_by_day(spark, str(tmp_path / "streamed"))
    assert rows_of(a, *columns) == rows_of(b, *columns) and a.count() == 2


def cdc_spec(tmp_path):
    image = {"id": 1, "name": "a", "created_at": "2024-01-01 23:30:00.000"}
    source = lines(tmp_path / "in", [
        {"op": "r", "ts_ms": 1, "after": image},
        {"op": "u", "ts_ms": 2, "before": image, "after": {**image, "name": "b"}},
        {"op": "c", "ts_ms": 3, "after": {**image, "id": 2}},
        {"op": "d", "ts_ms": 4, "before": {**image, "id": 2}},
    ])
    return {
        "name": "mirror",
        "source": {
            "kind": "cdc", "options": {"path": source}, "zone": "Asia/Shanghai",
            "fields": {"id": "INT", "name": "VARCHAR(20)", "created_at": "TIMESTAMP(3)"},
        },
        "sink": {
            "model": "keyed", "path": str(tmp_path / "t"), "keys": ["id"], "buckets": 4, "day_from": "created_at",
            "columns": ["id", "name", "partition_day"], "not_null": ["id"], "day_as_text": True,
        },
    }


@pytest.mark.parametrize("mode", ["batch", "stream"])
def test_cdc_flow(spark, tmp_path, mode):
    spec = SyncSpec.from_dict(cdc_spec(tmp_path))
    query = run(spark, spec, mode, label="1", checkpoint=str(tmp_path / "cp"))
    if mode == "stream":
        query.awaitTermination()
    table = keyed_table(spark, spec)
    assert rows_of(table.read(), "id", "name", "partition_day") == [(1, "b", "2024-01-01")]


def test_deletes_can_be_switched_off(spark, tmp_path):
    given = cdc_spec(tmp_path)
    given["sink"]["enable_delete"] = False
    spec = SyncSpec.from_dict(given)
    run(spark, spec, label="1")
    table = keyed_table(spark, spec)
    assert rows_of(table.read(), "id", "name") == [(1, "b"), (2, "a")]


def test_lookback_and_window(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.sql("""
        SELECT id, timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, int(id), 0) AS update_time
        FROM range(180)""").write.parquet(path)
    spec = SyncSpec.from_dict({
        "name": "slice",
        "source": {"kind": "parquet", "options": {"path": path}, "lookback_hours": 1},
        "transform": {"window": {"column": "update_time", "size": "30 min", "counts_by": []}},
        "sink": {"model": "discard", "day_column": None},
    })
    got = build(spark, spec, as_of="2024-01-01 03:00:00")
    assert rows_of(got.selectExpr("date_format(window_start, 'HH:mm')", "rows")) == [("02:00", 30), ("02:30", 30)]
    assert run(spark, spec, as_of="2024-01-01 03:00:00") is None


def test_json_sink_and_generated_source(spark, tmp_path):
    from syncflow.sources.datagen import RandomText, Sequence

    spec = SyncSpec.from_dict({
        "name": "gen",
        "source": {
            "kind": "datagen", "options": {"rows": 10},
            "fields": {"uid": Sequence(1, 5), "v": RandomText(4)},
        },
        "sink": {"model": "json", "path": str(tmp_path / "out"), "day_column": None},
    })
    run(spark, spec)
    got = spark.read.json(str(tmp_path / "out"))
    assert got.count() == 10 and got.agg(F.max("uid")).first()[0] == 5


@pytest.fixture
def printed(tmp_path, monkeypatch):
    """The lines that tasks print, which have a standard output of their own."""
    path = str(tmp_path / "printed")

    def show(line):
        with open(path, "a") as out:
            out.write(line + "\n")

    monkeypatch.setattr("syncflow.plans.spec.print_rows", functools.partial(print_rows, show=show))
    return lambda: open(path).read().splitlines()


def test_print_and_discard(spark, tmp_path, printed):
    given = event_spec(tmp_path)
    given["sink"] = {"model": "print", "day_column": None}
    run(spark, SyncSpec.from_dict(given))
    assert "0.0.0.0" in "".join(printed())
    for model in ("print", "discard"):
        given["sink"]["model"] = model
        run(spark, SyncSpec.from_dict(given), "stream", checkpoint=str(tmp_path / model)).awaitTermination()


def test_changes_from_a_time_on(spark, tmp_path):
    given = cdc_spec(tmp_path)
    given["source"].update(startup="timestamp", start={"since": F.lit(3)})
    given["sink"]["not_null"] = []
    got = build(spark, SyncSpec.from_dict(given))
    assert rows_of(got, "_op_kind", "id") == [("delete", 2), ("upsert", 2)]


def test_mistakes_are_refused(spark, tmp_path):
    given = event_spec(tmp_path)
    with pytest.raises(ValueError, match="unknown entries"):
        SyncSpec.from_dict({**given, "colour": "red"})
    with pytest.raises(ValueError, match="unknown source kind"):
        build(spark, SyncSpec.from_dict({**given, "source": {"kind": "carrier"}}))
    with pytest.raises(ValueError, match="label"):
        run(spark, SyncSpec.from_dict(given))
    with pytest.raises(ValueError, match="unknown mode"):
        run(spark, SyncSpec.from_dict(given), "sometimes")
    given["transform"]["filter"] = "nobody IS NOT NULL"
    with pytest.raises(AnalysisException):
        build(spark, SyncSpec.from_dict(given))


def test_cdc_flow_with_a_snapshot(spark, tmp_path):
    """Rows from before the changes come once, and any change to them wins."""
    before = [(1, "old", "2024-01-01 00:00:00"), (2, "kept", "2024-01-01 00:00:00"), (7, "kept", "2024-01-01 00:00:00")]
    spark.createDataFrame(before, "id int, name string, created_at string").selectExpr(
        "id", "name", "CAST(created_at AS timestamp_ntz) AS created_at"
    ).write.parquet(str(tmp_path / "before"))
    given = cdc_spec(tmp_path)
    given["source"]["snapshot"] = {"kind": "parquet", "options": {"path": str(tmp_path / "before")}}
    for mode in ("batch", "stream"):
        given["sink"]["path"] = str(tmp_path / mode)
        spec = SyncSpec.from_dict(given)
        for _ in range(2):
            query = run(spark, spec, mode, label="1", checkpoint=str(tmp_path / "cp"))
            if mode == "stream":
                query.awaitTermination()
        assert rows_of(keyed_table(spark, spec).read(), "id", "name") == [(1, "b"), (7, "kept")]
    given["source"]["snapshot_mode"] = "never"
    given["sink"]["path"] = str(tmp_path / "without")
    spec = SyncSpec.from_dict(given)
    run(spark, spec, label="1")
    assert rows_of(keyed_table(spark, spec).read(), "id") == [(1,)]


def test_filter_and_not_null_on_changes(spark, tmp_path):
    events = [
        {"op": "c", "ts_ms": 1, "after": {"id": 1, "name": "on"}}, {"op": "c", "ts_ms": 1, "after": {"id": 2, "name": "on"}},
        {"op": "c", "ts_ms": 1, "after": {"id": 3, "name": "on"}}, {"op": "c", "ts_ms": 1, "after": {"id": 4, "name": None}},
        {"op": "u", "ts_ms": 2, "after": {"id": 1, "name": "off"}}, {"op": "d", "ts_ms": 2, "before": {"id": 2}},
        {"op": "d", "ts_ms": 2, "before": {"name": "x"}},
    ]
    spec = SyncSpec.from_dict({
        "name": "f",
        "source": {"kind": "cdc", "options": {"path": lines(tmp_path / "in", events)}, "fields": {"id": "INT", "name": "STRING"}},
        "transform": {"filter": "name <> 'off' OR name IS NULL"},
        "sink": {"model": "keyed", "path": str(tmp_path / "t"), "keys": ["id"], "buckets": 2, "not_null": ["id", "name"], "day_column": None},
    })
    run(spark, spec, label="1")
    assert rows_of(keyed_table(spark, spec).read(), "id", "name") == [(3, "on")]


def test_print_sink_prints_every_row(spark, printed):
    spec = SyncSpec.from_dict({"name": "p", "source": {"kind": "frame"}, "sink": {"model": "print", "day_column": None}})
    run(spark, spec, frame=spark.range(57))
    assert len(set(printed())) == 57


def test_labels_of_another_flow_are_an_error(spark, tmp_path):
    given = event_spec(tmp_path)
    run(spark, SyncSpec.from_dict(given), label="1", fallback_day="2000-01-01")
    with pytest.raises(ValueError, match="was used by"):
        run(spark, SyncSpec.from_dict({**given, "name": "other"}), label="1", fallback_day="2000-01-01")
