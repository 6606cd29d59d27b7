"""Queries on what targets keep: own columns, schemas, labels, times, and whole change flows."""

from __future__ import annotations

from pyspark.sql import functions as F

from syncflow import storage
from syncflow.functions import times
from syncflow.operators import changelog, match, monitor, transform
from syncflow.plans import inputs
from syncflow.plans.checks import _FEATURES, _features
from syncflow.plans.inputs import CHANGE_FIELDS, HALF, table, table_stream, text_of
from syncflow.plans.spec import SyncSpec, keyed_table, run
from syncflow.sinks.append import append_by_day, read_by_day
from syncflow.sinks.keyed import KeyedTable
from syncflow.sources import events as ev
from syncflow.streaming.run import stream_to_day_table


def keyed_own_columns(spark, sf_dir):
    """A mirror whose columns are called like the marks of a change."""
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", F.lit(1).alias("version"), F.col("c_nationkey").alias("bucket"), F.lit("delete").alias("kind")
    )
    mirror = KeyedTable(spark, storage.work_path(spark, "own"), ["c_custkey"], ["version"], kind=None)
    mirror.upsert(rows, "1")
    mirror.upsert(rows.where("c_custkey <= 100").withColumn("version", F.lit(2)), "2", max_deltas=3)
    return mirror.read()


def keyed_new_column(spark, sf_dir):
    """A column that comes with the second load."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    mirror = KeyedTable(spark, storage.work_path(spark, "column"), ["o_orderkey"], ["place"])
    mirror.upsert(rows.drop("o_orderpriority").withColumn("place", F.lit(1)), "1")
    mirror.upsert(rows.where("o_custkey < 500").withColumn("place", F.lit(2)), "2")
    return mirror.read().drop("place")


def keyed_key_widened(spark, sf_dir):
    """Keys of 32 bits, then of 64: each is one row."""
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("int").alias("c_custkey"), "c_nationkey")
    mirror = KeyedTable(spark, storage.work_path(spark, "wider"), ["c_custkey"], ["place"])
    mirror.upsert(rows.withColumn("place", F.lit(1)), "1")
    mirror.upsert(rows.withColumn("c_custkey", F.col("c_custkey").cast("bigint")).withColumn("place", F.lit(2)), "2")
    return mirror.read()


def append_new_checkpoint(spark, sf_dir):
    """Two streams into one table under one prefix, each with a checkpoint of its own."""
    path = storage.work_path(spark, "checkpoints")
    for number in range(2):
        rows = transform.place_by_day(table_stream(spark, sf_dir, "events"), "ts").select("event_id", "partition_day")
        stream_to_day_table(rows, f"{path}/t", f"{path}/cp{number}", "load").awaitTermination()
    return read_by_day(spark, f"{path}/t").groupBy(F.col("partition_day").cast("string").alias("partition_day")).agg(
        F.count(F.lit(1)).alias("rows")
    )


def append_text_day(spark, sf_dir):
    """A day kept as text stays text."""
    rows = transform.place_by_day(table(spark, sf_dir, "events"), "ts", as_text=True)
    path = storage.work_path(spark, "text-day")
    append_by_day(rows.select("event_id", "partition_day"), path, "1")
    return read_by_day(spark, path)


def append_new_column(spark, sf_dir):
    """A column that comes with the second load."""
    rows = transform.place_by_day(table(spark, sf_dir, "events"), "ts", as_text=True)
    path = storage.work_path(spark, "new-column")
    append_by_day(rows.where("user_id < 50").select("event_id", "partition_day"), path, "1")
    append_by_day(rows.where("user_id >= 50").select("event_id", "event_type", "partition_day"), path, "2")
    return read_by_day(spark, path).drop("partition_day")


def json_timestamps_zoned(spark, sf_dir):
    """Times with Z and with an offset, as instants and as UTC wall time."""
    rows = table(spark, sf_dir, "events")
    shifted = F.date_format(F.col("ts") + F.expr("INTERVAL 8 HOURS"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    record = F.struct(
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")).alias("utc"),
        F.concat(shifted, F.lit("+08:00")).alias("east"),
    )
    payloads = rows.select("event_id", F.to_json(record).alias("value"))
    decoded = ev.decode_json(
        payloads, {"utc": "TIMESTAMP(3)", "east": "TIMESTAMP_LTZ(3)"}, keep=["event_id"], timestamp_standard="ISO-8601"
    )
    return decoded.select(
        "event_id", times.timestamp_text("utc").alias("utc"), times.timestamp_text(times.utc_wall("east")).alias("east")
    )


def cdc_times(spark, sf_dir):
    """Times of a row image as connectors emit them: zoned text, and microseconds."""
    rows = table(spark, sf_dir, "events")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    image = F.struct(
        "event_id", F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")).alias("at"), micros.alias("exact")
    )
    envelope = F.to_json(F.struct(F.lit("c").alias("op"), image.alias("after")))
    fields = {"event_id": "BIGINT", "at": "TIMESTAMP", "exact": "DATETIME(6)"}
    decoded = changelog.decode_changes(rows.select(envelope.alias("value")), fields, timestamp_standard="ISO-8601")
    return decoded.select(
        "event_id", F.date_format("at", times.SECONDS_FORMAT).alias("at"), text_of("exact").alias("exact")
    )


def _flow(path: str, mode: str, **parts) -> SyncSpec:
    given = {
        "name": "changes",
        "source": {"kind": "cdc", "fields": CHANGE_FIELDS},
        "sink": {"model": "keyed", "path": f"{path}/{mode}", "keys": ["user_id"], "buckets": 4, "day_column": None},
    }
    for name, entries in parts.items():
        given[name] = {**given.get(name, {}), **entries}
    return SyncSpec.from_dict(given)


def _mirrored(spark, spec):
    return keyed_table(spark, spec).read().select("user_id", "event_id", "value")


def spec_cdc_initial(spark, sf_dir):
    """Snapshot, then changes, twice over; as a batch and as a stream."""
    path, half = storage.work_path(spark, "initial"), F.expr(f"timestamp_ntz'{HALF}'")
    events = table(spark, sf_dir, "events")
    before = changelog.live_rows(inputs.changes(events.where(F.col("ts") < half)), ["user_id"], ["ts", "event_id"])
    before.select("user_id", "event_id", "value", F.col("ts").alias("created_at")).write.parquet(f"{path}/before")
    out = []
    for mode in ("batch", "stream"):
        spec = _flow(path, mode, source={"snapshot": {"kind": "parquet", "options": {"path": f"{path}/before"}}})
        reader = table if mode == "batch" else table_stream
        payloads = inputs.envelopes(reader(spark, sf_dir, "events").where(F.col("ts") >= half))
        for _ in range(2):
            query = run(spark, spec, mode, label="1", checkpoint=f"{path}/checkpoint", frame=payloads)
            if mode == "stream":
                query.awaitTermination()
        out.append(_mirrored(spark, spec).select(F.lit(mode).alias("mode"), "*"))
    return out[0].unionByName(out[1])


def spec_cdc_filter(spark, sf_dir):
    """A row that a change takes out of the filter leaves the mirror."""
    path = storage.work_path(spark, "filter")
    spec = _flow(path, "batch", transform={"filter": "value >= 50"})
    run(spark, spec, label="1", frame=inputs.envelopes(table(spark, sf_dir, "events")))
    return _mirrored(spark, spec)


def spec_cdc_not_null(spark, sf_dir):
    """Deletes that hold nothing but the key are applied under a not-null rule."""
    path = storage.work_path(spark, "not-null")
    spec = _flow(path, "batch", sink={"not_null": ["user_id", "event_id", "value"]})
    events = table(spark, sf_dir, "events")
    bare = events.withColumns({
        "value": F.when(F.col("event_type") != "error", F.col("value")),
    })
    run(spark, spec, label="1", frame=inputs.envelopes(bare))
    return _mirrored(spark, spec)


def alert_routing_nulls(spark, sf_dir):
    """Alerts without a level, or a type, are sent."""
    alerts = inputs.alerts(table(spark, sf_dir, "events"))
    odd = alerts.withColumns({
        "level": F.when(F.col("event_id") % 19 != 0, F.col("level")),
        "alert_type": F.when(F.col("event_id") % 17 != 0, F.col("alert_type")),
    })
    return monitor.route_alerts(odd).select("event_id", "level", "alert_type")


def state_transitions_nulls(spark, sf_dir):
    """Jobs without a name are a job; rows without a time are left out, and counted."""
    status = inputs.job_status(table(spark, sf_dir, "events")).withColumns({
        "job": F.when(F.col("event_id") % 19 != 0, F.col("job")),
        "ts": F.when(F.col("event_id") % 23 != 0, F.col("ts")),
    })
    found = monitor.state_transitions(status, "job", "state", "ts", ["event_id"]).agg(F.count(F.lit(1)).alias("changes"))
    left = monitor.untimed(status, "ts").agg(F.count(F.lit(1)).alias("untimed"))
    return found.select("changes", left.scalar().alias("untimed"))


def rolled_files(spark, sf_dir):
    """A JSON sink with a bound on its files: how many rows come back, and whether all files keep it."""
    path, limit = storage.work_path(spark, "rolled"), 64 << 10
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    spec = SyncSpec.from_dict({
        "name": "rolled", "source": {"kind": "frame"},
        "sink": {"model": "json", "path": path, "day_column": None, "rolling": {"file_bytes": limit, "row_bytes": 80}},
    })
    run(spark, spec, frame=rows)
    files = spark.read.schema(rows.schema).json(path)
    sizes = files.select("o_orderkey", F.col("_metadata.file_size").alias("bytes"))
    return sizes.agg(
        F.count(F.lit(1)).alias("rows"), F.sum("o_orderkey").alias("keys"), (F.max("bytes") <= limit).alias("bounded")
    )


def best_match(spark, sf_dir):
    """The best candidate of every job alone."""
    return match.best_candidates(*_features(spark, sf_dir))


QUERIES = {f.__name__: f for f in (
    keyed_own_columns, keyed_new_column, keyed_key_widened, append_new_checkpoint, append_text_day, append_new_column,
    json_timestamps_zoned, cdc_times, spec_cdc_initial, spec_cdc_filter, spec_cdc_not_null, alert_routing_nulls,
    state_transitions_nulls, rolled_files, best_match,
)}

_LAST = """
WITH last AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1)
"""

SQL = {
    "keyed_own_columns": """
        SELECT c_custkey, CASE WHEN c_custkey <= 100 THEN 2 ELSE 1 END AS version, c_nationkey AS bucket,
               'delete' AS kind FROM customer""",
    "keyed_new_column": """
        SELECT o_orderkey, o_custkey, CASE WHEN o_custkey < 500 THEN o_orderpriority END AS o_orderpriority
        FROM orders""",
    "keyed_key_widened": "SELECT CAST(c_custkey AS BIGINT) AS c_custkey, c_nationkey, 2 AS place FROM customer",
    "append_new_checkpoint": """
        SELECT strftime(ts, '%Y-%m-%d') AS partition_day, 2 * count(*) AS rows FROM events GROUP BY 1""",
    "append_text_day": "SELECT event_id, strftime(ts, '%Y-%m-%d') AS partition_day FROM events",
    "append_new_column": """
        SELECT event_id, CASE WHEN user_id >= 50 THEN event_type END AS event_type FROM events""",
    "json_timestamps_zoned": """
        SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS utc, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS east
        FROM events""",
    "cdc_times": """
        SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS exact
        FROM events""",
    "spec_cdc_initial": _LAST + """
        SELECT mode, user_id, event_id, value FROM last, (VALUES ('batch'), ('stream')) m(mode)
        WHERE event_type <> 'error'""",
    "spec_cdc_filter": _LAST + """
        SELECT user_id, event_id, value FROM last WHERE event_type <> 'error' AND value >= 50""",
    "spec_cdc_not_null": _LAST + "SELECT user_id, event_id, value FROM last WHERE event_type <> 'error'",
    "alert_routing_nulls": """
        SELECT event_id, level, alert_type FROM (
          SELECT event_id,
                 CASE WHEN event_id % 19 <> 0 THEN CASE event_type WHEN 'error' THEN 'error' WHEN 'click' THEN 'warning'
                      ELSE 'info' END END AS level,
                 CASE WHEN event_id % 17 <> 0 THEN CASE event_type WHEN 'signup' THEN 'recovery'
                      WHEN 'purchase' THEN 'daily_report' ELSE event_type END END AS alert_type
          FROM events)
        WHERE level IS DISTINCT FROM 'info' OR coalesce(alert_type IN ('recovery', 'daily_report'), false)""",
    "state_transitions_nulls": """
        WITH s AS (SELECT CASE WHEN event_id % 19 <> 0 THEN user_id END AS job, event_type AS state, ts, event_id
                   FROM events),
        p AS (SELECT state, lag(state) OVER (PARTITION BY job ORDER BY ts, event_id) AS before
              FROM s WHERE event_id % 23 <> 0)
        SELECT count(*) FILTER (state IS DISTINCT FROM before) AS changes,
               (SELECT count(*) FROM s WHERE event_id % 23 = 0) AS untimed FROM p""",
    "rolled_files": """
        SELECT count(*) AS rows, CAST(sum(o_orderkey) AS BIGINT) AS keys, true AS bounded FROM orders""",
    "best_match": _FEATURES + """
        , p AS (SELECT job, candidate, count(*) AS shared, count(*) FILTER (starts_with(feature, 'sink_table:')) AS shared_sinks
                FROM a JOIN b USING (feature) GROUP BY 1, 2),
        na AS (SELECT job, count(*) AS n FROM a GROUP BY 1),
        nb AS (SELECT candidate, count(*) AS n FROM b GROUP BY 1),
        s AS (SELECT job, candidate, shared, shared_sinks, (2 * shared + shared_sinks) / (2 * (na.n + nb.n - shared)) AS score
              FROM p JOIN na USING (job) JOIN nb USING (candidate))
        SELECT job, candidate, shared, shared_sinks, score FROM s
        QUALIFY row_number() OVER (PARTITION BY job ORDER BY score DESC, candidate) = 1""",
}
