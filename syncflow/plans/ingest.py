"""Queries over event streams: decoding, time handling, day placement."""

from __future__ import annotations

from pyspark.sql import functions as F

from syncflow.functions import times
from syncflow.operators import partitions, transform
from syncflow.plans import inputs
from syncflow.plans.inputs import COLD_START_FIELDS, day_of, table
from syncflow.sinks.outputs import encode_for_kafka
from syncflow.sources import events as ev
from syncflow.sources import snapshot, tables
from syncflow.functions.types import apply_schema
from syncflow.streaming.windows import window_counts


def cold_start_rows(payloads):
    """The production select of the cold-start flow, on a table or a stream of payloads."""
    rows = ev.decode_json(payloads, COLD_START_FIELDS)
    event_time = times.millis_to_timestamp(F.col("timestamp"))
    rows = rows.withColumn(
        "partition_day", times.day_text(times.event_day(event_time, "2024-01-31"))
    )
    rows = transform.default_values(rows, {"deviceId": "unknown"})
    rows = rows.withColumn("event_time", times.timestamp_text(event_time))
    return transform.sink_columns(
        rows, ["partition_day", "uid", "platformType", "userIP", "version", "deviceId", "event_time"]
    )


def cold_start_ods(spark, sf_dir):
    return cold_start_rows(inputs.cold_start_payloads(table(spark, sf_dir, "events")))


def json_reject_count(spark, sf_dir):
    payloads = inputs.damaged_payloads(table(spark, sf_dir, "events"))
    outcome = F.when(F.col("rejected"), "rejected").otherwise("kept")
    parsed = ev.parse_json(payloads, list(COLD_START_FIELDS))
    return parsed.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("records"))


def json_quarantine(spark, sf_dir):
    payloads = inputs.damaged_payloads(table(spark, sf_dir, "events"))
    rejects = ev.rejected_json(payloads, list(COLD_START_FIELDS), keep=["event_id"])
    return rejects.select("event_id", F.startswith("raw", F.lit('{"uid":')).alias("raw_kept"))


def json_field_coercion(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    uid = (
        F.when(F.col("event_id") % 7 == 0, F.lit('"x"'))
        .when(F.col("event_id") % 2 == 0, F.format_string('"%d"', "user_id"))
        .otherwise(F.format_string("%d", "user_id"))
    )
    version = F.when(F.col("event_id") % 3 == 0, F.lit('{"a":1}')).otherwise(F.lit('"1.2"'))
    stamp = (
        F.when(F.col("event_id") % 11 == 0, F.lit('"99999999999999999"'))
        .when(F.col("event_id") % 2 == 0, F.format_string("%d", F.col("event_id")))
        .otherwise(F.format_string('"%d"', F.col("event_id")))
    )
    text = F.format_string('{"uid":%s,"version":%s,"timestamp":%s,"other":[1]}', uid, version, stamp)
    decoded = ev.decode_json(
        rows.select("event_id", text.alias("value")), COLD_START_FIELDS, keep=["event_id"]
    )
    return decoded.select(
        "event_id", "uid", "version", "deviceId",
        times.epoch_millis(F.col("timestamp")).alias("event_millis"),
    )


def json_timestamps(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    record = F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("at"), F.col("props").alias("note")
    )
    payloads = rows.select("event_id", F.to_json(record).alias("value"))
    decoded = ev.decode_json(
        payloads, {"at": "TIMESTAMP(3)", "note": "TIMESTAMP(3)"}, keep=["event_id"],
        timestamp_standard="ISO-8601",
    )
    return decoded.select(
        "event_id", times.timestamp_text("at").alias("at"), times.timestamp_text("note").alias("note")
    )


def kafka_round_trip(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    records = encode_for_kafka(orders, keys=["o_orderkey"])
    fields = {
        "o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double", "o_orderstatus": "string",
    }
    return ev.decode_json(records, fields)


def day_rows(spark, sf_dir):
    placed = transform.place_by_day(table(spark, sf_dir, "events"), "ts", as_text=True)
    return partitions.rows_per_day(placed)


def day_fallback(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumn(
        "ts", F.when(F.col("event_id") % 13 != 0, F.col("ts"))
    )
    placed = transform.place_by_day(rows, "ts", fallback_day="2024-02-01", as_text=True)
    return partitions.rows_per_day(placed)


def ts_text(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    return rows.select(
        "event_id", times.timestamp_text("ts").alias("event_time"),
        F.date_format(times.truncate_millis("ts"), times.SECONDS_FORMAT).alias("to_second"),
    )


def ts_millis(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        "event_id", F.unix_millis(F.col("ts").cast("timestamp")).cast("string").alias("stamp")
    )
    return rows.select(
        "event_id",
        times.epoch_millis("stamp").alias("event_millis"),
        times.millis_to_seconds("stamp").alias("event_seconds"),
        times.timestamp_text(times.millis_to_timestamp("stamp")).alias("event_time"),
    )


def tz_shift(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    return rows.select(
        "event_id", F.date_format(times.to_utc("ts", "Asia/Shanghai"), inputs.MICROS).alias("utc")
    )


def process_time(spark, sf_dir):
    """Processing time stamped on every row; the clock is injected, so it can be compared."""
    rows = table(spark, sf_dir, "events")
    stamped = rows.withColumn("process_time", times.as_instant(inputs.AS_OF))
    return stamped.select("event_id", F.date_format("process_time", times.SECONDS_FORMAT).alias("process_time"))


def rename_map(spark, sf_dir):
    return transform.map_columns(
        table(spark, sf_dir, "orders"),
        {"o_orderkey": "id", "o_custkey": "uid", "o_totalprice": "price"},
    )


def filter_rows(spark, sf_dir):
    rows = transform.filter_rows(
        table(spark, sf_dir, "orders"), "o_custkey IS NOT NULL AND o_totalprice >= 100000"
    )
    return rows.select("o_orderkey", "o_custkey", "o_totalprice")


def clean_cols(spark, sf_dir):
    rows = inputs.mirrored_orders(table(spark, sf_dir, "orders"))
    cleaned = transform.clean_columns(rows, {"o_orderpriority": "COALESCE(o_orderpriority, 'none')"})
    return cleaned.select("o_orderkey", "o_orderpriority")


def literal_cols(spark, sf_dir):
    rows = table(spark, sf_dir, "orders")
    return rows.select(
        F.date_format(F.expr("DATE '2025-05-18'"), "yyyy-MM-dd").alias("partition_day"),
        F.col("o_orderkey").alias("uid"), F.lit("1704067200000").alias("event_time"),
    )


def star_projection(spark, sf_dir):
    return table(spark, sf_dir, "nation").select("*")


def case_day(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").withColumn(
        "update_time", F.when(F.col("o_orderkey") % 17 != 0, F.col("o_orderdate"))
    )
    placed = transform.place_by_day(rows, "update_time", fallback_day="2002-01-01", as_text=True)
    return placed.select("o_orderkey", "partition_day")


def not_null_drop(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").withColumn(
        "o_custkey", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_custkey"))
    )
    return transform.enforce_not_null(rows, ["o_orderkey", "o_custkey"]).select("o_orderkey", "o_custkey")


def sink_column_list(spark, sf_dir):
    rows = table(spark, sf_dir, "customer")
    return transform.sink_columns(
        rows, {"c_mktsegment": "string", "c_custkey": "bigint", "c_nationkey": "bigint"}
    )


def length_check(spark, sf_dir):
    rows = table(spark, sf_dir, "documents")
    return rows.select("doc_id", transform.too_long({"text": 2000, "lang": 10}).alias("too_long"))


def preview_rows(spark, sf_dir):
    return transform.preview(table(spark, sf_dir, "orders"), 5).agg(F.count(F.lit(1)).alias("rows"))


def type_cast_table(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    text = rows.select(
        *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")],
        F.format_string("%.2f", "l_extendedprice").alias("l_extendedprice"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("l_shipdate"),
        F.when(F.col("l_linenumber") == 1, "1").otherwise("0").alias("is_first"),
        # One more than fits a signed 64-bit number.
        F.lit("9223372036854775808").alias("big"),
    )
    typed = apply_schema(text, {
        "l_orderkey": "bigint unsigned", "l_linenumber": "int(11)", "l_quantity": "double",
        "l_returnflag": "varchar(1)", "l_extendedprice": "decimal(12,2)", "l_shipdate": "datetime(3)",
        "is_first": "tinyint(1)", "big": "bigint unsigned",
    })
    return typed.withColumns({
        "l_extendedprice": F.col("l_extendedprice").cast("double"),
        "l_shipdate": F.date_format("l_shipdate", "yyyy-MM-dd"),
    })


def lookback_1h(spark, sf_dir):
    return _lookback(spark, sf_dir, tables.LOOKBACK_HOURS["hourly"])


def lookback_24h(spark, sf_dir):
    return _lookback(spark, sf_dir, tables.LOOKBACK_HOURS["daily"])


def _lookback(spark, sf_dir, hours):
    rows = tables.incremental_slice(table(spark, sf_dir, "events"), "ts", inputs.AS_OF, hours)
    return rows.select("event_id", "user_id", day_of("ts").alias("partition_day"))


def snapshot_chunks(spark, sf_dir):
    return tables.snapshot_chunks(table(spark, sf_dir, "orders"), "o_orderkey", 4096)


#: The largest number whose cube has 64 bits.
_MAX_CUBED = 2_097_151


def snapshot_even_chunks(spark, sf_dir):
    """Chunks of a key that is far from even: cubes of the order keys; as decimals if any has over 64 bits."""
    orders = table(spark, sf_dir, "orders")
    found = orders.agg(F.min("o_orderkey").alias("least"), F.max("o_orderkey").alias("most")).first()
    fits = found.most is None or -_MAX_CUBED <= found.least and found.most <= _MAX_CUBED
    key = F.col("o_orderkey").cast("bigint" if fits else "decimal(38,0)")
    return snapshot.even_chunks(orders.select((key * key * key).alias("id")), "id", 1000)


def tumble_5m(spark, sf_dir):
    counts = window_counts(table(spark, sf_dir, "events"), "ts", "5 minutes", ["event_type"])
    return counts.select(
        F.date_format("window_start", times.SECONDS_FORMAT).alias("window_start"),
        F.date_format("window_end", times.SECONDS_FORMAT).alias("window_end"),
        "event_type", "rows",
    )


def datagen_rows(spark, sf_dir):
    from syncflow.sources.datagen import RandomText, Sequence, with_generated

    rows = table(spark, sf_dir, "orders").select("o_orderkey")
    out = with_generated(rows, F.col("o_orderkey"), {
        "uid": Sequence(1, 1000),
        "platformType": RandomText(10),
        "deviceId": RandomText(40),
        "event_time": Sequence("2024-01-01 00:00:00", "2024-12-31 23:59:59", "1 minute"),
        "partition_day": Sequence("2024-01-01", "2024-12-31"),
    }, seed=7)
    return out.withColumns({
        "event_time": F.date_format("event_time", times.SECONDS_FORMAT),
        "partition_day": F.date_format("partition_day", times.DAY_FORMAT),
    })


QUERIES = {f.__name__: f for f in (
    cold_start_ods, json_reject_count, json_quarantine, json_field_coercion, json_timestamps,
    kafka_round_trip, day_rows, day_fallback, ts_text, ts_millis, tz_shift, process_time, rename_map,
    filter_rows, clean_cols, literal_cols, star_projection, case_day, not_null_drop, sink_column_list,
    length_check, preview_rows, type_cast_table, lookback_1h, lookback_24h, snapshot_chunks,
    snapshot_even_chunks, tumble_5m,
    datagen_rows,
)}

_COLD_START = """
SELECT strftime(ts, '%Y-%m-%d') AS partition_day, user_id AS uid, event_type AS "platformType",
       '192.0.2.' || (user_id % 256) AS "userIP", props AS version,
       CASE WHEN event_id % 5 <> 0 THEN 'dev-' || user_id ELSE 'unknown' END AS "deviceId",
       strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS event_time
FROM events
"""

_LOOKBACK = """
SELECT event_id, user_id, strftime(ts, '%Y-%m-%d') AS partition_day
FROM events WHERE ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL {} HOUR
"""

SQL = {
    "cold_start_ods": _COLD_START,
    "json_reject_count": """
        SELECT CASE WHEN event_id % 10 = 0 THEN 'rejected' ELSE 'kept' END AS outcome,
               count(*) AS records
        FROM events GROUP BY 1""",
    "json_quarantine": "SELECT event_id, true AS raw_kept FROM events WHERE event_id % 10 = 0",
    "json_field_coercion": """
        SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN user_id END AS uid,
               CASE WHEN event_id % 3 = 0 THEN '{"a":1}' ELSE '1.2' END AS version,
               CAST(NULL AS VARCHAR) AS "deviceId",
               CASE WHEN event_id % 11 <> 0 THEN event_id END AS event_millis
        FROM events""",
    "json_timestamps": """
        SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS at, CAST(NULL AS VARCHAR) AS note
        FROM events""",
    "kafka_round_trip": "SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders",
    "day_rows": """
        SELECT strftime(ts, '%Y-%m-%d') AS partition_day, count(*) AS rows FROM events GROUP BY 1""",
    "day_fallback": """
        SELECT CASE WHEN event_id % 13 = 0 THEN '2024-02-01' ELSE strftime(ts, '%Y-%m-%d') END
                   AS partition_day, count(*) AS rows
        FROM events GROUP BY 1""",
    "ts_text": """
        SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS event_time,
               strftime(ts, '%Y-%m-%d %H:%M:%S') AS to_second
        FROM events""",
    "ts_millis": """
        SELECT event_id, epoch_us(ts) // 1000 AS event_millis, epoch_us(ts) // 1000000 AS event_seconds,
               strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS event_time
        FROM events""",
    "tz_shift": """
        SELECT event_id, strftime(ts - INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S.%f') AS utc FROM events""",
    "process_time": "SELECT event_id, '2024-01-31 00:00:00' AS process_time FROM events",
    "rename_map": "SELECT o_orderkey AS id, o_custkey AS uid, o_totalprice AS price FROM orders",
    "filter_rows": """
        SELECT o_orderkey, o_custkey, o_totalprice FROM orders
        WHERE o_custkey IS NOT NULL AND o_totalprice >= 100000""",
    "clean_cols": """
        SELECT o_orderkey,
               CASE WHEN o_orderkey % 83 <> 0 THEN o_orderpriority ELSE 'none' END AS o_orderpriority
        FROM orders WHERE o_orderkey % 97 <> 0""",
    "literal_cols": """
        SELECT '2025-05-18' AS partition_day, o_orderkey AS uid, '1704067200000' AS event_time
        FROM orders""",
    "star_projection": "SELECT * FROM nation",
    "case_day": """
        SELECT o_orderkey,
               CASE WHEN o_orderkey % 17 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d')
                    ELSE '2002-01-01' END AS partition_day
        FROM orders""",
    "not_null_drop": "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 7 <> 0",
    "sink_column_list": """
        SELECT c_mktsegment, c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey FROM customer""",
    "length_check": """
        SELECT doc_id, coalesce(length(text) > 2000, false) OR coalesce(length(lang) > 10, false)
               AS too_long
        FROM documents""",
    "preview_rows": "SELECT count(*) AS rows FROM (SELECT * FROM orders LIMIT 5)",
    "type_cast_table": """
        SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag, l_extendedprice,
               strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate, l_linenumber = 1 AS is_first,
               CAST(NULL AS BIGINT) AS big
        FROM lineitem""",
    "lookback_1h": _LOOKBACK.format(1),
    "lookback_24h": _LOOKBACK.format(24),
    "snapshot_chunks": """
        WITH b AS (SELECT min(o_orderkey) lo, max(o_orderkey) hi, count(*) n FROM orders),
        s AS (SELECT lo, CAST(ceil((hi - lo + 1) / ceil(n / 4096.0)) AS BIGINT) stride FROM b)
        SELECT (o_orderkey - lo) // stride AS chunk, min(o_orderkey) AS first_key,
               max(o_orderkey) AS last_key, count(*) AS rows
        FROM orders, s GROUP BY 1""",
    "snapshot_even_chunks": """
        WITH k AS (SELECT CAST(o_orderkey AS BIGINT) * o_orderkey * o_orderkey AS id FROM orders)
        SELECT n // 1000 AS chunk, min(id) AS first_key, max(id) AS last_key, count(*) AS rows
        FROM (SELECT id, row_number() OVER (ORDER BY id) - 1 AS n FROM k) GROUP BY 1""",
    "tumble_5m": """
        SELECT strftime(time_bucket(INTERVAL 5 MINUTE, ts), '%Y-%m-%d %H:%M:%S') AS window_start,
               strftime(time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE, '%Y-%m-%d %H:%M:%S')
                   AS window_end,
               event_type, count(*) AS rows
        FROM events GROUP BY 1, 2, 3""",
    "datagen_rows": """
        SELECT o_orderkey, 1 + o_orderkey % 1000 AS uid,
               substr(md5('7:platformType:0:' || o_orderkey), 1, 10) AS "platformType",
               md5('7:deviceId:0:' || o_orderkey) || substr(md5('7:deviceId:1:' || o_orderkey), 1, 8)
                   AS "deviceId",
               strftime(TIMESTAMP '2024-01-01' + to_minutes(o_orderkey % 527040), '%Y-%m-%d %H:%M:%S')
                   AS event_time,
               strftime(DATE '2024-01-01' + CAST(o_orderkey % 366 AS INTEGER), '%Y-%m-%d')
                   AS partition_day
        FROM orders""",
}
