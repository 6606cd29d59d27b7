"""Queries that run as streams over the table files and read back what they wrote."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from syncflow import storage
from syncflow.functions import times
from syncflow.operators import changelog
from syncflow.plans import inputs
from syncflow.plans.changes import SQL as _CHANGE_SQL
from syncflow.plans.checks import SQL as _CHECK_SQL
from syncflow.plans.ingest import SQL as _INGEST_SQL, cold_start_rows
from syncflow.plans.inputs import CHANGE_FIELDS, COLD_START_FIELDS, PartedStream, table, table_stream
from syncflow.plans.spec import SyncSpec, run
from syncflow.sinks import outputs
from syncflow.sinks.append import read_by_day
from syncflow.sinks.keyed import KeyedTable
from syncflow.streaming.run import (
    flow_counts, stream_on_time, stream_to_day_files, stream_to_day_table, stream_to_keyed_table,
)
from syncflow.streaming.suppression import suppress_repeats_stream
from syncflow.streaming.windows import as_event_time, window_counts, with_event_time_limit


def stream_cold_start(spark, sf_dir):
    """Payload stream, decoded and appended to day files. Nothing is stateful or shuffled."""
    rows = cold_start_rows(inputs.cold_start_payloads(table_stream(spark, sf_dir, "events")))
    path = storage.work_path(spark, "stream_cold_start")
    rows = rows.withColumn("day", F.col("partition_day"))
    stream_to_day_files(rows, f"{path}/data", f"{path}/checkpoint", "day").awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{path}/data").drop("day")


def stream_tumble_5m(spark, sf_dir):
    """Window counts as windows close; those still open at the end are not written."""
    events = as_event_time(table_stream(spark, sf_dir, "events"), "ts")
    counts = window_counts(
        with_event_time_limit(events, "ts", "5 seconds"), "ts", "5 minutes", ["event_type"]
    )
    path = storage.work_path(spark, "stream_tumble_5m")
    stream_to_day_files(counts, f"{path}/data", f"{path}/checkpoint", None).awaitTermination()
    closed = spark.read.schema(counts.schema).parquet(f"{path}/data")
    return closed.select(
        F.date_format("window_start", times.SECONDS_FORMAT).alias("window_start"),
        "event_type", "rows",
    )


def stream_cdc_mirror(spark, sf_dir):
    """Change envelopes in eight micro-batches, with a restart: changes wait beside the buckets of a
    keyed mirror, and buckets are rewritten in between."""
    arriving = PartedStream(spark, sf_dir, "events", "event_id", 8)
    path = storage.work_path(spark, "stream_cdc_mirror")
    mirror = KeyedTable(spark, path, ["user_id"], ["seq"])
    for upto in (5, 8):
        arriving.arrive(upto)
        rows = changelog.decode_changes(inputs.envelopes(arriving.read()), CHANGE_FIELDS)
        stream_to_keyed_table(rows, mirror, f"{path}/checkpoint", "cdc", max_deltas=3).awaitTermination()
    return mirror.read().select(
        "user_id", "event_id", "value", times.timestamp_text("created_at").alias("ts")
    )


def stream_resume(spark, sf_dir):
    """A stream stopped halfway and resumed on its checkpoint: rows per day, none twice or lost."""
    arriving = PartedStream(spark, sf_dir, "events", "event_id")
    path = storage.work_path(spark, "stream_resume")
    for upto in (2, 4, 4):
        arriving.arrive(upto)
        rows = cold_start_rows(inputs.cold_start_payloads(arriving.read()))
        stream_to_day_table(rows, f"{path}/table", f"{path}/checkpoint", "resume").awaitTermination()
    return read_by_day(spark, f"{path}/table").groupBy(
        F.col("partition_day").cast("string").alias("partition_day")
    ).agg(F.count(F.lit(1)).alias("rows"))


def _suppressed(spark, sf_dir, name: str, by, delay: str):
    arriving = PartedStream(spark, sf_dir, "events", by)
    path = storage.work_path(spark, name)
    for upto in (2, 4):
        arriving.arrive(upto)
        sent = suppress_repeats_stream(
            inputs.alerts(arriving.read()), "alert_type", "ts", ("event_id",), delay=delay
        )
        stream_to_day_files(sent, f"{path}/data", f"{path}/checkpoint", None).awaitTermination()
    out = spark.read.schema(sent.schema).parquet(f"{path}/data")
    return out.withColumn("ts", inputs.text_of("ts"))


def stream_alert_suppressed(spark, sf_dir):
    """Suppression with state kept per alert type, over micro-batches and a restart; what comes
    after the watermark at the end still waits."""
    return _suppressed(spark, sf_dir, "stream_alert_suppressed", "event_id", "1s")


def stream_alert_late(spark, sf_dir):
    """The same with alerts that come up to three hours late, so micro-batches overlap in time."""
    late = F.make_dt_interval(hours=F.pmod(F.xxhash64("event_id"), F.lit(4)).cast("int"))
    return _suppressed(spark, sf_dir, "stream_alert_late", F.unix_micros((F.col("ts") + late).cast("timestamp")), "3h")


def stream_late_rows(spark, sf_dir):
    """Events up to three hours late, one micro-batch a week: what is more than an hour behind goes apart."""
    late = F.make_dt_interval(hours=(F.col("event_id") % 4).cast("int"))
    ends = [dt.datetime(2024, 1, day) for day in (8, 16, 24)]
    arriving = PartedStream(spark, sf_dir, "events", F.col("ts") + late, ends=ends)
    path = storage.work_path(spark, "stream_late_rows")
    for upto in range(1, 5):
        arriving.arrive(upto)
        stream_on_time(arriving.read(), "ts", "1h", path, f"{path}/checkpoint").awaitTermination()
    rows = [
        spark.read.schema("event_id long, batch long").parquet(f"{path}/{name}").select(
            "event_id", "batch", F.lit(name == "late").alias("is_late")
        ) for name in ("on_time", "late")
    ]
    return rows[0].unionByName(rows[1]).groupBy("batch", "is_late").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("event_id").alias("ids")
    )


def stream_fan_out(spark, sf_dir):
    """One stream to two targets that are committed together, over micro-batches and a restart."""
    arriving = PartedStream(spark, sf_dir, "events", "event_id")
    path = storage.work_path(spark, "stream_fan_out")
    targets = {
        "all": lambda rows: rows.select("event_id", "user_id"),
        "errors": lambda rows: rows.where("event_type = 'error'").select("event_id", "user_id"),
    }
    for upto in (3, 4):
        arriving.arrive(upto)
        writer = outputs.fan_out_committed(arriving.read(), targets, path)
        writer.option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    schema = table(spark, sf_dir, "events").select("event_id", "user_id").schema
    counts = [
        outputs.read_committed(spark, path, name, schema).agg(
            F.lit(name).alias("target"), F.count(F.lit(1)).alias("rows"), F.sum("event_id").alias("ids")
        ) for name in targets
    ]
    return counts[0].unionByName(counts[1])


def spec_counts(spark, sf_dir):
    """What a flow's not-null rule saw and dropped, as a batch and as a stream."""
    path = storage.work_path(spark, "spec_counts")
    told = []
    for mode in ("batch", "stream"):
        spec = SyncSpec.from_dict({
            "name": f"counted_{mode}", "source": {"kind": "kafka", "fields": COLD_START_FIELDS},
            "sink": {
                "model": "append", "path": f"{path}/{mode}", "event_millis": "timestamp",
                "not_null": ["deviceId", "partition_day"],
            },
        })
        reader = table if mode == "batch" else table_stream
        payloads = inputs.cold_start_payloads(reader(spark, sf_dir, "events"))
        counts: dict[str, int] = {}
        query = run(spark, spec, mode, "1", f"{path}/checkpoint", frame=payloads, counts=counts)
        if mode == "stream":
            query.awaitTermination()
            counts = flow_counts(query.recentProgress)
        kept = read_by_day(spark, f"{path}/{mode}").agg(F.count(F.lit(1)).alias("rows_kept"))
        told.append(kept.select(
            F.lit(mode).alias("mode"), F.lit(counts["rows_in"]).cast("long").alias("rows_in"),
            F.lit(counts["rows_dropped"]).cast("long").alias("rows_dropped"), "rows_kept",
        ))
    return told[0].unionByName(told[1])


def cold_start_spec(path: str) -> SyncSpec:
    """The cold-start flow as a description."""
    return SyncSpec.from_dict({
        "name": "cold_start",
        "source": {"kind": "kafka", "fields": COLD_START_FIELDS},
        "watermark": {"column": "event_time", "delay": "5s"},
        "transform": {
            "computed": {"event_time": "timestamp_millis(try_cast(`timestamp` AS bigint))"},
            "filter": "uid IS NOT NULL",
            "clean": {"deviceId": "COALESCE(deviceId, 'unknown')"},
        },
        "sink": {
            "model": "append", "path": path, "label_prefix": "cold_start", "event_millis": "timestamp",
            "columns": ["partition_day", "uid", "platformType", "userIP", "version", "deviceId", "event_time"],
            "not_null": ["partition_day"],
        },
    })


def spec_flow(spark, sf_dir):
    """One description run over a table and over a stream: rows per day of both."""
    path = storage.work_path(spark, "spec_flow")
    inputs.table(spark, sf_dir, "events")
    out = []
    for mode in ("batch", "stream"):
        spec = cold_start_spec(f"{path}/{mode}")
        reader = inputs.table if mode == "batch" else table_stream
        payloads = inputs.cold_start_payloads(reader(spark, sf_dir, "events"))
        query = run(
            spark, spec, mode, label="1", checkpoint=f"{path}/checkpoint", frame=payloads,
            fallback_day="2024-01-31",
        )
        if mode == "stream":
            query.awaitTermination()
        rows = read_by_day(spark, f"{path}/{mode}").groupBy("partition_day").agg(
            F.count(F.lit(1)).alias("rows"), F.count_if(F.col("deviceId") == "unknown").alias("no_device")
        )
        out.append(rows.select(F.lit(mode).alias("mode"), "partition_day", "rows", "no_device"))
    both = out[0].unionByName(out[1])
    return both.withColumn("partition_day", inputs.day_of("partition_day"))


QUERIES = {f.__name__: f for f in (
    stream_cold_start, stream_tumble_5m, stream_cdc_mirror, stream_resume, stream_alert_suppressed,
    stream_alert_late, stream_late_rows, stream_fan_out, spec_counts, spec_flow,
)}


def _before_watermark(delay: int) -> str:
    """What the batch rule sends in the seconds before the last watermark."""
    last = f"(SELECT max(epoch_us(ts) // 1000000) - {delay} FROM events)"
    return _CHECK_SQL["alert_suppressed"] + f" WHERE sent.sec < {last}"


SQL = {
    "stream_cold_start": _INGEST_SQL["cold_start_ods"],
    "stream_tumble_5m": """
        SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS rows
        FROM (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS w, event_type FROM events)
        WHERE w + INTERVAL 5 MINUTE
              <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 5 SECOND FROM events)
        GROUP BY 1, 2""",
    # Change events carry milliseconds.
    "stream_cdc_mirror": _CHANGE_SQL["cdc_latest"].replace("%S.%f", "%S.%g"),
    "stream_resume": _INGEST_SQL["day_rows"],
    "stream_alert_suppressed": _before_watermark(1),
    "stream_alert_late": _before_watermark(3 * 3600),
    "stream_late_rows": """
        WITH e AS (SELECT *, ts + to_hours(CAST(event_id % 4 AS INTEGER)) AS came FROM events),
        p AS (SELECT *, CAST((came > TIMESTAMP '2024-01-08') AS BIGINT) + (came > TIMESTAMP '2024-01-16')::BIGINT
                        + (came > TIMESTAMP '2024-01-24')::BIGINT AS batch FROM e),
        m AS (SELECT a.batch, max(b.ts) - INTERVAL 1 HOUR AS mark
              FROM (SELECT DISTINCT batch FROM p) a LEFT JOIN p b ON b.batch < a.batch GROUP BY 1)
        SELECT batch, coalesce(ts < mark, false) AS is_late, count(*) AS rows, sum(event_id)::BIGINT AS ids
        FROM p JOIN m USING (batch) GROUP BY 1, 2""",
    "stream_fan_out": """
        SELECT 'all' AS target, count(*) AS rows, sum(event_id)::BIGINT AS ids FROM events
        UNION ALL SELECT 'errors', count(*), sum(event_id)::BIGINT FROM events WHERE event_type = 'error'""",
    "spec_counts": """
        SELECT mode, count(*) AS rows_in, count(*) FILTER (event_id % 5 = 0) AS rows_dropped,
               count(*) FILTER (event_id % 5 <> 0) AS rows_kept
        FROM events, (VALUES ('batch'), ('stream')) m(mode) GROUP BY 1""",
    "spec_flow": """
        SELECT mode, strftime(ts, '%Y-%m-%d') AS partition_day, count(*) AS rows,
               count(*) FILTER (event_id % 5 = 0) AS no_device
        FROM events, (VALUES ('batch'), ('stream')) m(mode) GROUP BY 1, 2""",
}
