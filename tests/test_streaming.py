import datetime as dt
import json
import os
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from conftest import rows_of
from syncflow.operators import changelog
from syncflow.sinks.append import append_by_day, read_by_day
from syncflow.sinks.keyed import KeyedTable
from syncflow.operators.transform import enforce_not_null
from syncflow.sinks.outputs import fan_out_committed, fan_out_stream, numbered_json_files, print_rows, read_committed
from syncflow.sources import events, tables
from syncflow.streaming import run as streams
from syncflow.streaming import suppression
from syncflow.streaming.suppression import suppress_repeats_stream
from syncflow.streaming.windows import tumbling, window_counts, with_event_time_limit
from test_changelog import log, replay
from test_monitor import greedy

ROW = {"id": "INT", "at": "INT", "v": "STRING", "day": "STRING"}


def put(path, name, lines):
    """Add a file that is taken after the ones already there: files go by their time."""
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text("\n".join(lines) + "\n")
    at = 1_700_000_000 + len(list(path.iterdir()))
    os.utime(path / name, (at, at))


def envelope(row):
    image = dict(zip(ROW, row[:4]))
    side = "before" if row[4] == "delete" else "after"
    op = "d" if row[4] == "delete" else "u"
    return json.dumps({"op": op, "ts_ms": row[1], "source": {"pos": row[1]}, side: image})


def test_cdc_stream_equals_batch_over_restarts(spark, tmp_path):
    """Several micro-batches and a restart in between: no loss, no repetition."""
    rows, source = log(n=90), tmp_path / "in"
    table = KeyedTable(spark, str(tmp_path / "t"), ["id"], ["seq"], 3)

    def go():
        values = tables.read_text_payloads(spark, str(source), streaming=True, maxFilesPerTrigger=1)
        changes = changelog.decode_changes(values, ROW)
        streams.stream_to_keyed_table(changes, table, str(tmp_path / "cp"), "cdc").awaitTermination()

    for i in range(2):
        put(source, f"{i}.json", [envelope(r) for r in rows[i * 30:(i + 1) * 30]])
    go()
    put(source, "2.json", [envelope(r) for r in rows[60:]])
    go()
    go()
    assert rows_of(table.read(), *ROW) == replay(rows)
    assert [x.rpartition("-")[2] for x in table.log.labels()] == ["0", "1", "2"]
    assert max(len(v) for v in table.files().values()) > 1


def test_new_checkpoint_swallows_nothing(spark, tmp_path):
    """Its micro-batches are numbered from 0 again, and are other rows all the same."""
    source, path = tmp_path / "in", str(tmp_path / "t")
    source.mkdir()
    for n in range(2):
        put(source / str(n), "0.json", [f'{{"uid":{n}}}'])
        values = tables.read_text_payloads(spark, f"{source}/{n}", streaming=True)
        rows = events.decode_json(values, {"uid": "INT"}).withColumn("partition_day", F.lit("2024-01-01"))
        streams.stream_to_day_table(rows, path, str(tmp_path / f"cp{n}"), "s").awaitTermination()
    assert rows_of(read_by_day(spark, path), "uid", "partition_day") == [(0, "2024-01-01"), (1, "2024-01-01")]


def test_repeated_micro_batch_is_ignored(spark, tmp_path, monkeypatch):
    """The load went in, but the stream stopped before it could note that."""
    source, path, checkpoint = tmp_path / "in", str(tmp_path / "t"), tmp_path / "cp"
    put(source, "0.json", ['{"uid":1}', '{"uid":2}'])

    def go():
        values = tables.read_text_payloads(spark, str(source), streaming=True)
        rows = events.decode_json(values, {"uid": "INT"}).withColumn("partition_day", F.lit("2024-01-01"))
        streams.stream_to_day_table(rows, path, str(checkpoint), "s").awaitTermination()

    go()
    for note in (checkpoint / "commits").iterdir():  # the stream's own note that batch 0 is done
        note.unlink()
    go()
    assert rows_of(read_by_day(spark, path), "uid") == [(1,), (2,)]


def payload(i, at):
    return json.dumps({"uid": i, "timestamp": str(int(at.timestamp() * 1000))})


def timed(spark, source):
    values = tables.read_text_payloads(spark, str(source), streaming=True, maxFilesPerTrigger=1)
    rows = events.decode_json(values, {"uid": "BIGINT", "timestamp": "BIGINT"})
    rows = rows.withColumn("event_time", F.timestamp_millis("timestamp"))
    return with_event_time_limit(rows, "event_time", "5s")


UTC = dt.timezone.utc


def late_files(tmp_path):
    source = tmp_path / "in"
    noon = dt.datetime(2024, 1, 1, 12, tzinfo=UTC)
    put(source, "0.json", [payload(1, noon), payload(2, noon + dt.timedelta(minutes=30))])
    put(source, "1.json", [payload(3, noon), payload(4, noon + dt.timedelta(minutes=31))])
    put(source, "2.json", [payload(5, noon + dt.timedelta(minutes=32)), payload(6, noon)])
    return source


def test_stateless_flow_keeps_late_rows(spark, tmp_path):
    rows = timed(spark, late_files(tmp_path))
    out = str(tmp_path / "out")
    streams.stream_to_day_files(rows, out, str(tmp_path / "cp"), None).awaitTermination()
    assert rows_of(spark.read.parquet(out), "uid") == [(i,) for i in range(1, 7)]


def test_windows_drop_rows_behind_the_watermark(spark, tmp_path):
    counts = window_counts(timed(spark, late_files(tmp_path)), "event_time", "5 minutes")
    out = str(tmp_path / "out")
    streams.stream_to_day_files(counts, out, str(tmp_path / "cp"), None).awaitTermination()
    got = spark.read.parquet(out).selectExpr("date_format(window_start, 'HH:mm')", "rows")
    # Of the rows at noon (1, 3, 6) the last one is dropped: rows are held against the
    # watermark of the batch before theirs. The window from 12:30 is still open.
    assert rows_of(got) == [("12:00", 2)]


def test_tumbling_adds_bounds(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 00:07:00' ts, 1 AS v")
    row = tumbling(df, "ts", "5 minutes").first()
    assert (row.window_start.minute, row.window_end.minute, row.v) == (5, 10, 1)


def test_preview_stream(spark, tmp_path):
    rows = timed(spark, late_files(tmp_path)).select("uid")
    got = streams.preview_stream(rows, str(tmp_path / "cp"), 3)
    assert len(got) == 3 and {r.uid for r in got} <= set(range(1, 7))


def test_fan_out_stream(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    put(source, "0.json", ['{"uid":1}', '{"uid":2}'])
    rows = events.decode_json(
        tables.read_text_payloads(spark, str(source), streaming=True), {"uid": "INT"}
    ).withColumn("partition_day", F.lit("2024-01-01"))
    writer = fan_out_stream(rows, [
        lambda df, n: append_by_day(df, f"{out}/day", f"f-{n}"),
        numbered_json_files(f"{out}/json"),
    ])
    for uid in (3, 4):
        writer.option("checkpointLocation", f"{out}/cp").trigger(availableNow=True).start().awaitTermination()
        put(source, f"{uid}.json", [f'{{"uid":{uid}}}'])
    writer.start().awaitTermination()
    for name in ("2", ".2.crc"):  # the last batch runs again
        (tmp_path / "out/cp/commits" / name).unlink()
    writer.start().awaitTermination()
    want = [(1,), (2,), (3,), (4,)]
    assert rows_of(read_by_day(spark, f"{out}/day"), "uid") == want
    assert rows_of(spark.read.json(f"{out}/json"), "uid") == want


def test_suppression_remembers_across_micro_batches(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    rows = [("ab"[i % 2], dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i * 301.5), i) for i in range(60)]
    for f in range(3):
        lines = [json.dumps({"kind": k, "ts": str(t), "n": n}) for k, t, n in rows[f * 20:(f + 1) * 20]]
        put(source, f"{f}.json", lines)
    stream = tables.read_json_files(
        spark, str(source), "kind string, ts timestamp_ntz, n int", streaming=True, maxFilesPerTrigger=1
    )
    sent = suppress_repeats_stream(stream, "kind", "ts", ("n",))
    streams.stream_to_day_files(sent, out, str(tmp_path / "cp"), None).awaitTermination()
    assert rows_of(spark.read.parquet(out)) == [r for r in greedy(rows, 1800) if r[1] < rows[-1][1].replace(microsecond=0)]


def test_suppression_of_alerts_that_come_late(spark, tmp_path):
    """Micro-batches out of order within the delay; the state of a type ends with its quiet period."""
    source, out, start = tmp_path / "in", str(tmp_path / "out"), dt.datetime(2024, 1, 1)
    rows = [("ab"[i % 2], start + dt.timedelta(seconds=i * 97.5), i) for i in range(200)]
    rows.append(("c", start + dt.timedelta(seconds=5), 999))  # a type with one alert
    late = sorted(rows, key=lambda r: (r[1] + dt.timedelta(seconds=r[2] * 7919 % 3000), r[2]))
    late.append(("end", start + dt.timedelta(days=2), 1000))
    for f in range(6):
        lines = [json.dumps({"kind": k, "ts": str(t), "n": n}) for k, t, n in late[f * 34:(f + 1) * 34]]
        put(source, f"{f}.json", lines)
    stream = tables.read_json_files(
        spark, str(source), "kind string, ts timestamp_ntz, n int", streaming=True, maxFilesPerTrigger=1
    )
    sent = suppress_repeats_stream(stream, "kind", "ts", ("n",), delay="50m")
    query = streams.stream_to_day_files(sent, out, str(tmp_path / "cp"), None)
    query.awaitTermination()
    assert rows_of(spark.read.parquet(out)) == greedy(rows, 1800)
    assert query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] == 1  # the last alert waits


def test_suppression_merges_few_times_and_holds_little():
    """Many batches of a type: each second is held once, packed, and rows are merged a few times only."""
    start, merges = pd.Timestamp("2024-01-01"), []
    second = np.arange(60_000).repeat(2)
    rows = pd.DataFrame({
        "kind": "a", "ts": start + pd.to_timedelta(second, "s"), "n": np.arange(len(second))[::-1],
        "_second": int(start.timestamp()) + second, "_event": start,
    }).sample(frac=1, random_state=0)

    class State:
        exists, held = False, None

        def getCurrentWatermarkMs(self):
            return 0

        def update(self, held):
            self.held = held

        def setTimeoutTimestamp(self, at):
            self.at = at

    state, first = State(), suppression._first_of_seconds
    keep = suppression._keeper(["kind", "ts", "n"], "kind", ["ts", "n"], 1800)
    with pytest.MonkeyPatch.context() as patched:
        patched.setattr(suppression, "_first_of_seconds", lambda *a: merges.append(1) or first(*a))
        parts = (rows.iloc[i : i + 1000] for i in range(0, len(rows), 1000))
        assert list(keep(("a",), parts, state)) == []
    assert len(merges) <= 3 and len(state.held[1]) < 60_000 * 16
    state.exists, state.get = True, state.held
    state.getCurrentWatermarkMs = lambda: (int(start.timestamp()) + 4000) * 1000
    sent = pd.concat(keep(("a",), iter([]), state))
    assert [*sent.columns] == ["kind", "ts", "n"] and [*sent["kind"]] == ["a"] * 3
    assert [*sent["n"]] == [len(second) - 2 - 2 * at for at in (0, 1800, 3600)]  # the smaller of two in a second


@pytest.mark.parametrize("interval, want", [
    (None, {"availableNow": True}), ("60s", {"processingTime": "60 seconds"}),
])
def test_trigger(interval, want):
    assert streams.trigger_of(interval) == want


def test_committed_fan_out_shows_all_or_nothing(spark, tmp_path):
    """A crash between two writers leaves a batch in none of the targets, and then once in both."""
    source, out = tmp_path / "in", str(tmp_path / "out")
    crash = {"on": True}

    def second(rows):
        if crash["on"]:
            raise RuntimeError("between two writers")
        return rows.select("uid")

    def run_once():
        stream = tables.read_json_files(spark, str(source), "uid int, v string", streaming=True, maxFilesPerTrigger=1)
        targets = {"first": lambda rows: rows, "second": second if late["on"] else lambda rows: rows.select("uid")}
        writer = fan_out_committed(stream, targets, out)
        writer.option("checkpointLocation", f"{out}/cp").trigger(availableNow=True).start().awaitTermination()

    def seen():
        first = read_committed(spark, out, "first", StructType.fromDDL("uid int, v string"))
        return rows_of(first, "uid"), rows_of(read_committed(spark, out, "second", StructType.fromDDL("uid int")))

    late = {"on": False}
    put(source, "1.json", ['{"uid":1,"v":"a"}', '{"uid":2,"v":"b"}'])
    run_once()
    assert seen() == ([(1,), (2,)], [(1,), (2,)])
    late["on"] = True
    put(source, "2.json", ['{"uid":3,"v":"c"}'])
    with pytest.raises(Exception, match="between two writers"):
        run_once()
    assert spark.read.parquet(f"{out}/first").count() == 3  # written, but not committed
    assert seen() == ([(1,), (2,)], [(1,), (2,)])
    crash["on"] = False
    run_once()
    assert seen() == ([(1,), (2,), (3,)], [(1,), (2,), (3,)])


def test_flow_counts_and_listener(spark, tmp_path):
    source, counter = tmp_path / "in", streams.FlowCounter()
    put(source, "1.json", ['{"uid":1,"at":"2024-01-01 00:00:00"}', '{"at":"2024-01-01 01:00:00"}'])
    put(source, "2.json", ['{"uid":2,"at":"2024-01-01 02:00:00"}'])
    put(source, "3.json", ['{"uid":3,"at":"2024-01-01 00:10:00"}'])  # behind the watermark of two batches ago
    stream = tables.read_json_files(spark, str(source), "uid int, at timestamp", streaming=True, maxFilesPerTrigger=1)
    kept = enforce_not_null(with_event_time_limit(stream, "at", "1 minute"), ["uid"], "rule")
    counts = window_counts(kept, "at", "5 minutes", [])
    spark.streams.addListener(counter)
    try:
        query = streams.stream_to_day_files(counts, str(tmp_path / "out"), str(tmp_path / "cp"), None, name="counted")
        query.awaitTermination()
        want = {"rows_in": 4, "rows_dropped": 1, "rows_late": 1}
        assert streams.flow_counts(query.recentProgress) == want
        for _ in range(50):
            if counter.counts.get("counted") == want:
                break
            time.sleep(0.1)
        assert counter.counts["counted"] == want
    finally:
        spark.streams.removeListener(counter)


def test_printed_rows_do_not_pass_the_driver(spark, capsys):
    print_rows(spark.createDataFrame([(1, None)], "id int, v string"), "> ")
    assert capsys.readouterr().out == ""  # tasks have a standard output of their own
