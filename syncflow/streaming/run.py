"""Drivers that run a streaming DataFrame into a target, restartable from its checkpoint."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from syncflow import storage
from syncflow.functions.times import interval_text
from syncflow.sinks.append import append_by_day
from syncflow.sinks.keyed import KeyedTable

# Micro-batches whose changes may wait in a bucket of a keyed mirror before it is rewritten.
MAX_DELTAS = 10


def trigger_of(interval: str | None) -> dict:
    """Trigger arguments: a processing interval, or everything that is there and then stop."""
    return {"processingTime": interval_text(interval)} if interval else {"availableNow": True}


def _start(
    writer: DataStreamWriter, checkpoint: str, interval: str | None, name: str | None
) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint).trigger(**trigger_of(interval))
    return (writer.queryName(name) if name else writer).start()


def batch_label(spark: SparkSession, checkpoint: str, prefix: str, number: int) -> str:
    """Label of a micro-batch. It holds the query that the checkpoint belongs to, so batches of
    another checkpoint are other loads, though they are numbered alike."""
    query = json.loads(storage.read_text(spark, f"{checkpoint}/metadata"))["id"]
    return f"{prefix}-{query}-{number}"


def flow_counts(progresses: Iterable) -> dict[str, int]:
    """Rows that came in, were dropped by the not-null rule and came too late, over some progress reports."""
    counts = {"rows_in": 0, "rows_dropped": 0, "rows_late": 0}
    for progress in progresses:
        told = json.loads(progress.json)
        for observed in told.get("observedMetrics", {}).values():
            for name in ("rows_in", "rows_dropped"):
                counts[name] += observed.get(name) or 0
        counts["rows_late"] += sum(op.get("numRowsDroppedByWatermark", 0) for op in told.get("stateOperators", []))
    return counts


class FlowCounter(StreamingQueryListener):
    """Adds up ``flow_counts`` of every query by its name, for as long as it listens.

    A query itself only keeps its latest reports. Add it with ``spark.streams.addListener``.
    """

    def __init__(self) -> None:
        self.counts: dict[str, dict[str, int]] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        held = self.counts.setdefault(event.progress.name, flow_counts([]))
        for name, more in flow_counts([event.progress]).items():
            held[name] += more

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def stream_on_time(
    df: DataFrame,
    ts: str,
    delay: str,
    path: str,
    checkpoint: str,
    interval: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Rows to ``path/on_time``, those that come too late to ``path/late``, by batch.

    The watermark of a micro-batch stays ``delay`` behind the latest time of all batches before it; rows
    without a time are on time. It comes from one row a batch that is kept beside the rows, so a
    batch that is run again divides its rows in the same way, and replaces what it wrote.
    """
    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        mark = None
        if number:
            marks = spark.read.schema("number long, latest timestamp").parquet(f"{path}/marks/*")
            mark = marks.where(F.col("number") < number).agg(F.max("latest") - F.expr(f"INTERVAL {interval_text(delay)}")).first()[0]
        is_late = F.lit(False) if mark is None else F.coalesce(F.col(ts).cast("timestamp") < F.lit(mark), F.lit(False))
        held = batch.persist()
        try:
            held.where(is_late).write.mode("overwrite").parquet(f"{path}/late/batch={number}")
            held.where(~is_late).write.mode("overwrite").parquet(f"{path}/on_time/batch={number}")
            latest = held.agg(F.lit(number).cast("long").alias("number"), F.max(F.col(ts).cast("timestamp")).alias("latest"))
            latest.write.mode("overwrite").parquet(f"{path}/marks/batch={number}")
        finally:
            held.unpersist()

    return _start(df.writeStream.foreachBatch(write), checkpoint, interval, name)


def preview_stream(df: DataFrame, checkpoint: str, n: int = 5) -> list[Row]:
    """``n`` rows of what a stream holds by now (a debugging aid, so any rows will do)."""
    name = f"preview_{uuid.uuid4().hex}"
    writer = df.limit(n).writeStream.format("memory").outputMode("append")
    _start(writer, checkpoint, None, name).awaitTermination()
    try:
        return df.sparkSession.table(name).collect()
    finally:
        df.sparkSession.catalog.dropTempView(name)


def stream_to_day_files(
    df: DataFrame,
    path: str,
    checkpoint: str,
    day: str = "partition_day",
    interval: str | None = None,
    file_format: str = "parquet",
    options: Mapping[str, str] | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Exactly-once append to day-partitioned files through Spark's own file sink. No shuffle."""
    writer = df.writeStream.format(file_format).option("path", path).outputMode("append")
    if day:
        writer = writer.partitionBy(day)
    return _start(writer.options(**(options or {})), checkpoint, interval, name)


def stream_to_day_table(
    df: DataFrame,
    path: str,
    checkpoint: str,
    label_prefix: str,
    day: str = "partition_day",
    interval: str | None = None,
    name: str | None = None,
    owner: str | None = None,
) -> StreamingQuery:
    """Append through labelled loads: a micro-batch that is repeated after a crash is ignored."""
    def write(batch: DataFrame, number: int) -> None:
        label = batch_label(batch.sparkSession, checkpoint, label_prefix, number)
        append_by_day(batch, path, label, day, rebalance=False, owner=owner)

    return _start(df.writeStream.foreachBatch(write), checkpoint, interval, name)


def stream_to_keyed_table(
    df: DataFrame,
    table: KeyedTable,
    checkpoint: str,
    label_prefix: str,
    enable_delete: bool = True,
    interval: str | None = None,
    name: str | None = None,
    max_deltas: int = MAX_DELTAS,
) -> StreamingQuery:
    """Upsert every micro-batch into a keyed mirror under the label ``prefix-query-number``.

    A micro-batch is small next to the table, so its changes are kept beside the buckets,
    and a bucket is rewritten only after ``max_deltas`` of them.
    """
    def write(batch: DataFrame, number: int) -> None:
        label = batch_label(batch.sparkSession, checkpoint, label_prefix, number)
        table.upsert(batch, label, enable_delete, max_deltas)

    return _start(df.writeStream.foreachBatch(write), checkpoint, interval, name)
