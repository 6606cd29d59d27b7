"""Queries over changelogs and the targets they are written to."""

from __future__ import annotations

from pyspark.sql import functions as F

from syncflow import storage
from syncflow.operators import changelog, partitions, transform
from syncflow.plans import inputs
from syncflow.plans.inputs import CHANGE_FIELDS, HALF, day_of, table, text_of
from syncflow.sinks import outputs
from syncflow.sinks.append import append_by_day, read_by_day
from syncflow.sinks.keyed import KeyedTable
from syncflow.sources import cdc, snapshot
from syncflow.sources.tables import incremental_slice

KEYS, ORDER = ["user_id"], ["ts", "event_id"]


def _changes(spark, sf_dir):
    return inputs.changes(table(spark, sf_dir, "events"))


def _shown(rows):
    return rows.select("user_id", "event_id", "value", text_of("ts").alias("ts"))


def cdc_decode(spark, sf_dir):
    """Envelopes to row changes, every column of the image."""
    payloads = inputs.envelopes(table(spark, sf_dir, "events"))
    return changelog.decode_changes(payloads, CHANGE_FIELDS).select(
        "kind", "user_id", "event_id", "value", F.col("seq.pos").alias("pos"),
        F.date_format("created_at", "yyyy-MM-dd HH:mm:ss.SSS").alias("created_at"),
    )


def cdc_normalise(spark, sf_dir):
    decoded = cdc.decode_envelope(inputs.envelopes(table(spark, sf_dir, "events")), CHANGE_FIELDS)
    kinds = decoded.select("op", changelog.op_kind("op").alias("kind"))
    return kinds.groupBy("op", "kind").agg(F.count(F.lit(1)).alias("events"))


def cdc_value_modes(spark, sf_dir):
    """Decimals as text, unsigned numbers, numeric times; tombstones and schema events between."""
    orders = table(spark, sf_dir, "orders")
    row = F.struct(
        F.col("o_orderkey").alias("id"),
        F.format_string("%.2f", "o_totalprice").alias("price"),
        F.lit("18446744073709551615").alias("big"),
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("at"),
        F.datediff(F.to_date("o_orderdate"), F.lit("1970-01-01").cast("date")).alias("day"),
    )
    created = F.to_json(F.struct(F.lit("r").alias("op"), row.alias("after")))
    altered = F.to_json(F.struct(F.lit("ALTER TABLE orders").alias("ddl"), F.col("o_orderkey").alias("ts_ms")))
    values = orders.select(F.explode(F.array(created, F.lit(None), altered)).alias("value"))
    rows = changelog.decode_changes(values, {
        "id": "bigint", "price": "decimal(12,2)", "big": "bigint unsigned", "at": "datetime(3)", "day": "date",
    })
    return rows.select(
        "kind", "id", F.col("price").cast("double").alias("price"), "big",
        F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("at"), day_of("day").alias("day"),
    )


def cdc_latest(spark, sf_dir):
    return _shown(changelog.live_rows(_changes(spark, sf_dir), KEYS, ORDER))


def cdc_latest_keep_deletes(spark, sf_dir):
    return _shown(changelog.live_rows(_changes(spark, sf_dir), KEYS, ORDER, enable_delete=False))


def cdc_snapshot_merge(spark, sf_dir):
    """The table as it was on the 16th, read as a snapshot, and the changes from then on."""
    rows, half = _changes(spark, sf_dir), F.expr(f"timestamp_ntz'{HALF}'")
    before, after = rows.where(F.col("ts") < half), rows.where(F.col("ts") >= half)
    first = changelog.live_rows(before, KEYS, ORDER)
    log = changelog.snapshot_and_changes(first, after, "initial", "initial")
    return _shown(changelog.live_rows(log, KEYS, ["phase", *ORDER]))


def cdc_snapshot_concurrent(spark, sf_dir):
    """The table read in chunks while it went on changing, and the changes meanwhile and later.

    A change's number is its place in the log. Every chunk is read over a fifth of the log, each from
    another place on, and a row of it as it was at any place in between.
    """
    log = table(spark, sf_dir, "events").select(
        "user_id", F.col("event_id").alias("seq"), "value",
        F.when(F.col("event_type") == "error", "delete").otherwise("upsert").alias("kind"),
    )
    users = log.select("user_id").distinct()
    size = log.agg(F.count(F.lit(1))).scalar()
    low = F.call_function("div", size * F.pmod("chunk", F.lit(7)), F.lit(9))
    chunks = snapshot.even_chunks(users, "user_id", 16).select(
        "chunk", "first_key", low.alias("low"), (low + F.call_function("div", size, F.lit(5))).alias("high")
    )
    chunks = storage.written(chunks, "chunks")
    places = snapshot.located(users, chunks, "user_id")
    at = F.col("low") + F.pmod(F.xxhash64("user_id"), F.col("high") - F.col("low") + 1)
    read = changelog.live_rows(
        log.join(places.select("user_id", "chunk", at.alias("at")), "user_id").where("seq <= at").drop("at"),
        ["user_id"], ["seq"],
    ).drop("seq")
    merged = snapshot.consistent_snapshot(read, chunks, log, "user_id")
    return changelog.live_rows(merged, ["user_id"], ["phase", "seq"]).select(
        "user_id", F.col("seq").alias("event_id"), "value"
    )


def cdc_binary_decimals(spark, sf_dir):
    """Decimals as Base64 of their binary form: 1 to 24 bytes, negative ones and 38 digits and more included."""
    orders = table(spark, sf_dir, "orders")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint") * F.when(F.col("o_orderkey") % 2 == 0, -1).otherwise(1)
    signed = F.col("o_orderkey") * F.when(F.col("o_orderkey") % 3 == 0, -1).otherwise(1)

    def bytes_of(number, width=16):
        return F.when(number < 0, F.hex(number)).otherwise(F.lpad(F.hex(number), width, F.lit("0")))

    def wide_bytes_of(number):
        # 8,000,000,000,000 is 5^12 * 2^15: the first factor times either half of 64 bits fits into 64 bits.
        lower = number.bitwiseAND(2**32 - 1) * 5**12
        upper = F.shiftright(number, 32) * 5**12 + F.shiftright(lower, 32)
        last = F.shiftleft(upper, 47).bitwiseOR(F.shiftleft(lower.bitwiseAND(2**32 - 1), 15))
        return F.concat(bytes_of(F.shiftright(upper, 17)), bytes_of(last))

    small = F.substring(bytes_of(F.col("o_orderkey") % 256 - 128), 15, 2)
    # 64 bits hold the upper part for keys up to 1,152,921; for others it takes twice as many.
    high = F.try_multiply(signed, F.lit(8_000_000_000_000))
    high_bytes = F.when(high.isNotNull(), bytes_of(high)).otherwise(wide_bytes_of(signed))
    big = F.base64(F.unhex(F.concat(high_bytes, bytes_of(F.col("o_custkey")))))
    row = F.struct(
        F.col("o_orderkey").alias("id"), F.base64(F.unhex(bytes_of(cents))).alias("price"),
        big.alias("big"), big.alias("wide"),
        F.base64(F.unhex(small)).alias("small"), F.lit("no number").alias("bad"),
    )
    values = orders.select(F.to_json(F.struct(F.lit("c").alias("op"), row.alias("after"))).alias("value"))
    rows = changelog.decode_changes(values, {
        "id": "bigint", "price": "decimal(12,2)", "big": "decimal(38,0)", "wide": "decimal(65,0)", "small": "decimal(3,3)",
        "bad": "decimal(5,0)",
    }, decimals="precise")
    text = {c: F.col(c).cast("string") for c in ("price", "big", "small", "bad")}
    # Numbers of more than 38 digits fit no decimal of Spark and come as text.
    text["big"] = F.coalesce(text["big"], F.col("wide"))
    return rows.select("id", *[value.alias(c) for c, value in text.items()])


def cdc_replay(spark, sf_dir):
    """The last 24 hours read once more and merged into the result twice."""
    rows = _changes(spark, sf_dir)
    target = changelog.latest_per_key(rows, KEYS, ORDER)
    again = incremental_slice(rows, "ts", inputs.AS_OF, 24)
    once = changelog.merge_latest(target, again, KEYS, ORDER)
    twice = changelog.merge_latest(once, again, KEYS, ORDER)
    return _shown(twice.where("kind <> 'delete'"))


def cdc_day_move(spark, sf_dir):
    rows = _changes(spark, sf_dir).withColumn("day", day_of("ts"))
    return changelog.moved_days(rows, KEYS, ORDER, "day")


def cdc_dup_vs_unique(spark, sf_dir):
    rows = _changes(spark, sf_dir).withColumn("day", day_of("ts"))
    return changelog.append_versus_unique(rows, KEYS, ORDER, "day")


def startup_timestamp(spark, sf_dir):
    rows = cdc.start_changes(
        _changes(spark, sf_dir), "timestamp", ts="ts", since=F.expr(f"timestamp_ntz'{HALF}'")
    )
    return rows.groupBy("kind").agg(F.count(F.lit(1)).alias("changes"), F.min("event_id").alias("first_id"))


def startup_modes(spark, sf_dir):
    """What each startup and snapshot mode reads, from one snapshot and one log."""
    rows, half = _changes(spark, sf_dir), F.expr(f"timestamp_ntz'{HALF}'")
    first = changelog.live_rows(rows.where(F.col("ts") < half), KEYS, ORDER)
    later = rows.where(F.col("ts") >= half).withColumn("seq", F.struct(*ORDER))
    middle = F.struct(F.expr("timestamp_ntz'2024-01-20 00:00:00'").alias("ts"), F.lit(0).cast("bigint").alias("event_id"))
    modes = [
        ("initial", "initial", {}),
        ("initial", "never", {}),
        ("initial", "when_needed", {}),
        ("earliest-offset", "initial", {}),
        ("latest-offset", "initial", {"position": middle}),
        ("specific-offset", "initial", {"position": middle}),
        ("timestamp", "schema_only", {"ts": "ts", "since": middle.getField("ts")}),
    ]
    parts = [
        changelog.snapshot_and_changes(first, later, startup, mode, **start)
        .groupBy("phase").agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(startup).alias("startup"), F.lit(mode).alias("snapshot_mode"), "phase", "rows")
        for startup, mode, start in modes
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def keyed_mirror(spark, sf_dir):
    """Changes written to a keyed table in two loads, the second one offered twice."""
    rows, half = _changes(spark, sf_dir), F.expr(f"timestamp_ntz'{HALF}'")
    path = storage.work_path(spark, "keyed_mirror")
    mirror = KeyedTable(spark, path, KEYS, ORDER)
    mirror.upsert(rows.where(F.col("ts") < half), "mirror-1")
    for _ in range(2):
        mirror.upsert(rows.where(F.col("ts") >= half), "mirror-2")
    return _shown(mirror.read())


def lookback_mirror(spark, sf_dir):
    """A keyed table kept by overlapping look-back reads, which hold no deletes."""
    rows = table(spark, sf_dir, "orders").withColumnsRenamed({"o_orderkey": "id", "o_orderdate": "update_time"})
    path = storage.work_path(spark, "lookback_mirror")
    mirror = KeyedTable(spark, path, ["id"], ["update_time"])
    mirror.upsert(rows.where("update_time < timestamp_ntz'2000-01-01 00:00:00'"), "backfill")
    for number, hours in enumerate((24 * 700, 24 * 365, 24 * 365)):
        mirror.upsert(incremental_slice(rows, "update_time", "2001-08-02 00:00:00", hours), f"slice-{number}")
    placed = transform.place_by_day(mirror.read(), "update_time", as_text=True)
    return placed.select("id", "o_totalprice", "partition_day")


def append_labels(spark, sf_dir):
    """Events appended in two labelled loads, one of them offered twice: rows per day."""
    rows = transform.place_by_day(table(spark, sf_dir, "events"), "ts")
    path = storage.work_path(spark, "append_labels")
    half = F.expr(f"timestamp_ntz'{HALF}'")
    append_by_day(rows.where(F.col("ts") < half), path, "load-1")
    for _ in range(2):
        append_by_day(rows.where(F.col("ts") >= half), path, "load-2")
    counts = partitions.rows_per_day(read_by_day(spark, path))
    return counts.select(day_of("partition_day").alias("partition_day"), "rows")


def file_round_trip(spark, sf_dir):
    """Rows fanned out to JSON files and a keyed table, and read back from the files."""
    rows = table(spark, sf_dir, "customer")
    path = storage.work_path(spark, "fan_out")
    mirror = KeyedTable(spark, f"{path}/mirror", ["c_custkey"], ["c_name"])
    outputs.fan_out(rows, [
        lambda df: outputs.write_json_files(df, f"{path}/json"),
        lambda df: mirror.upsert(df, "fan-out"),
        outputs.write_nowhere,
    ])
    from syncflow.sources.tables import read_json_files

    files = read_json_files(spark, f"{path}/json", rows.schema)
    pairs = files.select("c_custkey", F.col("c_acctbal").alias("from_files")).join(
        mirror.read().select("c_custkey", F.col("c_acctbal").alias("from_mirror")), "c_custkey"
    )
    return pairs


def retention_90d(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    rows = transform.place_by_day(orders, "o_orderdate")
    kept = partitions.retained(rows, as_of=orders.agg(F.max("o_orderdate")).scalar())
    return kept.select("o_orderkey", day_of("partition_day").alias("partition_day"))


def partition_coverage(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    rows = transform.place_by_day(orders, "o_orderdate")
    report = partitions.partition_coverage(rows, as_of=orders.agg(F.max("o_orderdate")).scalar())
    return report.select(day_of("partition_day").alias("partition_day"), "rows")


def bucket_sizes(spark, sf_dir):
    return partitions.bucket_sizes(
        table(spark, sf_dir, "orders"), partitions.modulo_bucket("o_orderkey")
    )


def random_spread(spark, sf_dir):
    """Round-robin distribution: the same rows, in partitions of even size."""
    spread = partitions.spread_randomly(table(spark, sf_dir, "orders").select("o_orderkey"), 10)
    sizes = spread.groupBy(F.spark_partition_id()).agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys")
    )
    return sizes.agg(
        F.count(F.lit(1)).alias("partitions"), F.sum("n").alias("rows"), F.sum("keys").alias("keys"),
        (F.max("n") - F.min("n") <= 10).alias("even"),
    )


QUERIES = {f.__name__: f for f in (
    cdc_decode, cdc_normalise, cdc_value_modes, random_spread, cdc_latest, cdc_latest_keep_deletes, cdc_snapshot_merge,
    cdc_snapshot_concurrent, cdc_binary_decimals, cdc_replay,
    cdc_day_move, cdc_dup_vs_unique, startup_timestamp, startup_modes, keyed_mirror, lookback_mirror,
    append_labels, file_round_trip, retention_90d, partition_coverage, bucket_sizes,
)}

_LAST = """
WITH last AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events {where}
)
"""
_LIVE = _LAST.format(where="") + """
SELECT user_id, event_id, value, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts
FROM last WHERE rn = 1 AND event_type <> 'error'
"""

SQL = {
    "cdc_decode": """
        SELECT CASE WHEN event_type = 'error' THEN 'delete' ELSE 'upsert' END AS kind, user_id,
               event_id, value, event_id AS pos, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS created_at
        FROM events""",
    "cdc_normalise": """
        SELECT CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op,
               CASE event_type WHEN 'error' THEN 'delete' ELSE 'upsert' END AS kind,
               count(*) AS events
        FROM events GROUP BY 1, 2""",
    "cdc_value_modes": """
        SELECT 'upsert' AS kind, o_orderkey AS id, o_totalprice AS price, CAST(NULL AS BIGINT) AS big,
               strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS at, strftime(o_orderdate, '%Y-%m-%d') AS day
        FROM orders""",
    "random_spread": """
        SELECT CAST(10 AS BIGINT) AS partitions, count(*) AS rows, CAST(sum(o_orderkey) AS BIGINT) AS keys, true AS even
        FROM orders""",
    "cdc_latest": _LIVE,
    "cdc_latest_keep_deletes": _LAST.format(where="WHERE event_type <> 'error'") + """
        SELECT user_id, event_id, value, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts
        FROM last WHERE rn = 1""",
    "cdc_snapshot_merge": _LIVE,
    "cdc_snapshot_concurrent": """
        SELECT user_id, event_id, value FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events)
        WHERE rn = 1 AND event_type <> 'error'""",
    "cdc_binary_decimals": """
        SELECT o_orderkey AS id,
               CAST(CAST(round(o_totalprice * 100) AS BIGINT) * CASE WHEN o_orderkey % 2 = 0 THEN -1 ELSE 1 END
                    * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(12,2))::VARCHAR AS price,
               (o_orderkey::HUGEINT * CASE WHEN o_orderkey % 3 = 0 THEN -1 ELSE 1 END * 8000000000000
                * 18446744073709551616 + o_custkey)::VARCHAR AS big,
               CAST((o_orderkey % 256 - 128) * CAST(0.001 AS DECIMAL(4,3)) AS DECIMAL(4,3))::VARCHAR AS small,
               NULL::VARCHAR AS bad
        FROM orders""",
    "cdc_replay": _LIVE,
    "cdc_day_move": """
        WITH r AS (
          SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, event_type,
                 row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS a,
                 row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS z
          FROM events)
        SELECT f.user_id, f.day AS first_day, l.day AS last_day
        FROM r f JOIN r l ON f.user_id = l.user_id AND f.a = 1 AND l.z = 1
        WHERE l.event_type <> 'error' AND f.day <> l.day""",
    "cdc_dup_vs_unique": _LAST.format(where="") + """
        SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS appended_rows,
               count(*) FILTER (rn = 1 AND event_type <> 'error') AS live_keys
        FROM last GROUP BY 1""",
    "startup_timestamp": f"""
        SELECT CASE WHEN event_type = 'error' THEN 'delete' ELSE 'upsert' END AS kind,
               count(*) AS changes, min(event_id) AS first_id
        FROM events WHERE ts >= TIMESTAMP '{HALF}' GROUP BY 1""",
    "startup_modes": _LAST.format(where=f"WHERE ts < TIMESTAMP '{HALF}'") + f"""
        , n AS (
          SELECT (SELECT count(*) FROM last WHERE rn = 1 AND event_type <> 'error') AS snap,
                 (SELECT count(*) FROM events WHERE ts >= TIMESTAMP '{HALF}') AS later,
                 (SELECT count(*) FROM events WHERE ts >= TIMESTAMP '2024-01-20') AS tail)
        SELECT 'initial' AS startup, 'initial' AS snapshot_mode, 0 AS phase, snap AS rows FROM n
        UNION ALL SELECT 'initial', 'initial', 1, later FROM n
        UNION ALL SELECT 'initial', 'never', 1, later FROM n
        UNION ALL SELECT 'initial', 'when_needed', 0, snap FROM n
        UNION ALL SELECT 'initial', 'when_needed', 1, later FROM n
        UNION ALL SELECT 'earliest-offset', 'initial', 1, later FROM n
        UNION ALL SELECT 'latest-offset', 'initial', 1, tail FROM n
        UNION ALL SELECT 'specific-offset', 'initial', 1, tail FROM n
        UNION ALL SELECT 'timestamp', 'schema_only', 1, tail FROM n""",
    "keyed_mirror": _LIVE,
    "lookback_mirror": """
        SELECT o_orderkey AS id, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS partition_day
        FROM orders""",
    "append_labels": """
        SELECT strftime(ts, '%Y-%m-%d') AS partition_day, count(*) AS rows FROM events GROUP BY 1""",
    "file_round_trip": """
        SELECT c_custkey, c_acctbal AS from_files, c_acctbal AS from_mirror FROM customer""",
    "retention_90d": """
        SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS partition_day FROM orders
        WHERE CAST(o_orderdate AS DATE) >= (SELECT CAST(max(o_orderdate) AS DATE) - 90 FROM orders)""",
    "partition_coverage": """
        WITH m AS (SELECT CAST(max(o_orderdate) AS DATE) AS d FROM orders),
        c AS (SELECT d - 90 + CAST(i AS INTEGER) AS day FROM m, range(94) t(i))
        SELECT strftime(day, '%Y-%m-%d') AS partition_day, count(o_orderkey) AS rows
        FROM c LEFT JOIN orders ON CAST(o_orderdate AS DATE) = day GROUP BY 1""",
    "bucket_sizes": """
        SELECT CAST(o_orderkey % 10 AS INTEGER) AS bucket, count(*) AS rows FROM orders GROUP BY 1""",
}
