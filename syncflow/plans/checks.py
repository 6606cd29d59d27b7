"""Queries that reconcile tables, watch jobs and match feature sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from syncflow.operators import match, monitor, reconcile, transform
from syncflow.operators.suppression import suppress_repeats
from syncflow.plans import inputs
from syncflow.plans.inputs import day_of, table, text_of


def _both(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders, inputs.mirrored_orders(orders)


def recon_count(spark, sf_dir):
    return reconcile.compare_counts(*_both(spark, sf_dir))


def recon_by_day(spark, sf_dir):
    source, target = (
        transform.place_by_day(df, "o_orderdate", as_text=True) for df in _both(spark, sf_dir)
    )
    return reconcile.compare_counts(source, target, by=["partition_day"], max_diff=1)


def recon_keyed(spark, sf_dir):
    return reconcile.compare_rows(
        *_both(spark, sf_dir), ["o_orderkey"], ["o_custkey", "o_totalprice", "o_orderpriority"],
        unique_keys=True,
    )


def recon_digest(spark, sf_dir):
    """The same by digests: only rows of buckets that are unlike meet by key."""
    return reconcile.compare_digests(
        *_both(spark, sf_dir), ["o_orderkey"], ["o_custkey", "o_totalprice", "o_orderpriority"]
    )


def recon_appended(spark, sf_dir):
    """The same against an append-only copy in which some rows came twice."""
    source, target = _both(spark, sf_dir)
    target = target.unionByName(target.where(F.col("o_orderkey") % 79 == 0))
    return reconcile.compare_rows(
        source, target, ["o_orderkey"], ["o_custkey", "o_totalprice", "o_orderpriority"]
    )


def recon_nulls(spark, sf_dir):
    return reconcile.null_counts(
        *_both(spark, sf_dir), ["o_orderkey", "o_totalprice", "o_orderpriority"]
    )


def freshness(spark, sf_dir):
    report = reconcile.freshness(
        table(spark, sf_dir, "events"), "ts", "2024-01-30 23:59:59", by=["event_type"]
    )
    return report.select("event_type", text_of("last_ts").alias("last_ts"), "lag_minutes", "stale")


def _status(spark, sf_dir):
    return inputs.job_status(table(spark, sf_dir, "events"))


def state_transitions(spark, sf_dir):
    rows = monitor.state_transitions(_status(spark, sf_dir), "job", "state", "ts", ["event_id"])
    return rows.withColumn("ts", text_of("ts"))


def job_alerts(spark, sf_dir):
    rows = monitor.job_alerts(_status(spark, sf_dir), "job", "state", "ts", ["event_id"])
    return rows.withColumn("ts", text_of("ts"))


def not_found_alerts(spark, sf_dir):
    return monitor.not_found_alerts(_status(spark, sf_dir), "state").withColumn("ts", text_of("ts"))


def metric_rollup(spark, sf_dir):
    metrics = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("job"),
        F.when(F.col("event_id") % 6 != 0, F.floor(F.col("value"))).alias("read_records"),
        F.length("props").cast("bigint").alias("read_bytes"),
    )
    return monitor.metric_rollup(metrics, "job", ["read_records", "read_bytes"])


def failure_alerts(spark, sf_dir):
    """Failed status checks in a row."""
    rows = monitor.failure_alerts(_status(spark, sf_dir), "job", "state", "ts", ["event_id"])
    return rows.withColumn("ts", text_of("ts"))


def failed_job_alerts(spark, sf_dir):
    """The same rule with the failures of the job itself as what is counted."""
    rows = monitor.failure_alerts(
        _status(spark, sf_dir), "job", "state", "ts", ["event_id"], failed=["FAILED"]
    )
    return rows.withColumn("ts", text_of("ts"))


def resubmit_actions(spark, sf_dir):
    expected = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("job"), inputs.job_name("c_custkey").alias("name")
    )
    status = inputs.order_status(table(spark, sf_dir, "orders"))
    return monitor.resubmit_actions(status, expected, "job", "name", "state", "ts", ["o_orderkey"])


def job_types(spark, sf_dir):
    return monitor.job_types(table(spark, sf_dir, "customer"), inputs.job_name("c_custkey"))


def part_kinds(spark, sf_dir):
    """Ordered keyword rules on another text column."""
    rules = ((("ring", "red"), "first"), (("bolt",), "second"), (("widget", "blue"), "third"))
    return monitor.job_types(table(spark, sf_dir, "part"), "p_name", rules=rules, default="other")


def _alerts(spark, sf_dir):
    return inputs.alerts(table(spark, sf_dir, "events"))


def alert_suppressed(spark, sf_dir):
    sent = suppress_repeats(_alerts(spark, sf_dir), "alert_type", "ts", ["event_id"])
    return sent.withColumn("ts", text_of("ts"))


def alert_suppressed_by_job(spark, sf_dir):
    """Suppression with many keys: per job instead of per type."""
    rows = table(spark, sf_dir, "events").select("user_id", "ts", "event_id")
    sent = suppress_repeats(rows, "user_id", "ts", ["event_id"], quiet_seconds=86_400)
    return sent.withColumn("ts", text_of("ts"))


def alert_routing(spark, sf_dir):
    return monitor.route_alerts(_alerts(spark, sf_dir)).withColumn("ts", text_of("ts"))


def daily_report(spark, sf_dir):
    counts = {"errors": F.col("level") == "error", "warnings": F.col("level") == "warning"}
    report = monitor.daily_report(_alerts(spark, sf_dir), "ts", counts)
    return report.withColumn("report_day", day_of("report_day"))


def resource_alerts(spark, sf_dir):
    metric = (
        F.when(F.col("event_id") % 3 == 0, "disk").when(F.col("event_id") % 3 == 1, "memory").otherwise("cpu")
    )
    readings = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("host"), metric.alias("metric"), "value", "event_id"
    )
    return monitor.resource_alerts(readings)


def _features(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    jobs = inputs.order_features(table(spark, sf_dir, "lineitem"), part)
    candidates = inputs.nation_features(
        table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation"), part
    )
    return jobs, candidates


def feature_match(spark, sf_dir):
    return match.match_candidates(*_features(spark, sf_dir))


def combined_match(spark, sf_dir):
    return match.match_combined(*_features(spark, sf_dir))


QUERIES = {f.__name__: f for f in (
    recon_count, recon_by_day, recon_keyed, recon_digest, recon_appended, recon_nulls, freshness, state_transitions, job_alerts,
    not_found_alerts, metric_rollup, failure_alerts, failed_job_alerts, resubmit_actions, job_types,
    part_kinds, alert_suppressed, alert_suppressed_by_job, alert_routing, daily_report, resource_alerts,
    feature_match, combined_match,
)}

_TARGET = """
WITH target AS (
  SELECT o_orderkey, o_custkey, o_orderdate,
         CASE WHEN o_orderkey % 89 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
         CASE WHEN o_orderkey % 83 <> 0 THEN o_orderpriority END AS o_orderpriority
  FROM orders WHERE o_orderkey % 97 <> 0
)
"""
_PAIRS = """
, pairs AS (
  SELECT s.o_orderkey, t.o_orderkey IS NULL AS missing, {duplicate} AS twice,
         concat_ws(',', CASE WHEN s.o_custkey IS DISTINCT FROM t.o_custkey THEN 'o_custkey' END,
           CASE WHEN s.o_totalprice IS DISTINCT FROM t.o_totalprice THEN 'o_totalprice' END,
           CASE WHEN s.o_orderpriority IS DISTINCT FROM t.o_orderpriority
                THEN 'o_orderpriority' END) AS names
  FROM orders s LEFT JOIN target t ON s.o_orderkey = t.o_orderkey)
SELECT o_orderkey,
       CASE WHEN missing THEN 'missing' WHEN twice THEN 'duplicate' ELSE 'changed' END AS status,
       CASE WHEN NOT missing AND NOT twice THEN names END AS changed_columns
FROM pairs WHERE missing OR twice OR names <> ''
"""
_STATUS = """
WITH status AS (
  SELECT user_id AS job, ts, event_id,
         CASE event_type WHEN 'view' THEN 'RUNNING' WHEN 'error' THEN 'FAILED'
              WHEN 'click' THEN 'CANCELED' WHEN 'signup' THEN 'NOT_FOUND' ELSE 'ERROR' END AS state
  FROM events
)
"""
_ALERTS = """
WITH alerts AS (
  SELECT CASE event_type WHEN 'signup' THEN 'recovery' WHEN 'purchase' THEN 'daily_report'
              ELSE event_type END AS alert_type,
         CASE event_type WHEN 'error' THEN 'error' WHEN 'click' THEN 'warning' ELSE 'info' END AS level,
         ts, event_id
  FROM events
)
"""
_CHANGED = """
, changed AS (
  SELECT *, lag(state) OVER (PARTITION BY job ORDER BY ts, event_id) AS previous_state FROM status
)
"""
_LEVEL = """CASE WHEN state = 'RUNNING' THEN 'info'
                 WHEN state IN ('FAILED', 'CANCELED') THEN 'error' END"""
_TS = "strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts"
_RUNS = _STATUS + """
, runs AS (
  SELECT *, count(*) FILTER (state = 'RUNNING')
              OVER (PARTITION BY job ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run
  FROM status
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY job, run ORDER BY ts, event_id) AS failures
  FROM runs WHERE state = '{failed}'
)
SELECT job, state, """ + _TS + """, event_id, failures FROM numbered WHERE failures % 3 = 0
"""
_SUPPRESSED = """
, firsts AS (
  SELECT {key}, epoch_us(ts) // 1000000 AS sec, min((ts, event_id)) AS at
  FROM {rows} GROUP BY 1, 2
), hops AS (
  SELECT {key}, sec, min(sec) OVER (PARTITION BY {key} ORDER BY sec
                       RANGE BETWEEN {quiet} FOLLOWING AND UNBOUNDED FOLLOWING) AS next_sec
  FROM firsts
), sent AS (
  SELECT {key}, min(sec) AS sec FROM firsts GROUP BY 1
  UNION ALL
  SELECT h.{key}, h.next_sec FROM sent s JOIN hops h ON h.{key} = s.{key} AND h.sec = s.sec
  WHERE h.next_sec IS NOT NULL
)
"""
_NAME = """CASE {0} % 5 WHEN 0 THEN 'Kafka2Ods_' WHEN 1 THEN 'mysql2ods_' WHEN 2 THEN 'CDC_sync_'
                WHEN 3 THEN 'load_doris_' ELSE 'report_' END || {0}"""
_FEATURES = """
WITH a AS (
  SELECT DISTINCT l_orderkey AS job, unnest(['source_table:' || p_brand, 'sink_table:' || l_suppkey])
         AS feature
  FROM lineitem JOIN part ON l_partkey = p_partkey
), b AS (
  SELECT n_name AS candidate, 'sink_table:' || s_suppkey AS feature
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
  UNION
  SELECT n_name, 'source_table:' || p_brand FROM part JOIN nation ON p_size = n_nationkey + 1
)
"""

SQL = {
    "recon_count": _TARGET + """
        SELECT s AS source_rows, t AS target_rows, abs(s - t) AS diff, abs(s - t) > 100 AS alert
        FROM (SELECT (SELECT count(*) FROM orders) AS s, (SELECT count(*) FROM target) AS t)""",
    "recon_by_day": _TARGET + """
        SELECT coalesce(s.d, t.d) AS partition_day, coalesce(sn, 0) AS source_rows,
               coalesce(tn, 0) AS target_rows, abs(coalesce(sn, 0) - coalesce(tn, 0)) AS diff,
               abs(coalesce(sn, 0) - coalesce(tn, 0)) > 1 AS alert
        FROM (SELECT strftime(o_orderdate, '%Y-%m-%d') AS d, count(*) AS sn FROM orders GROUP BY 1) s
        FULL JOIN (SELECT strftime(o_orderdate, '%Y-%m-%d') AS d, count(*) AS tn FROM target GROUP BY 1) t
          ON s.d = t.d""",
    "recon_keyed": _TARGET + _PAIRS.format(duplicate="false"),
    "recon_digest": _TARGET + _PAIRS.format(duplicate="false"),
    "recon_appended": _TARGET + _PAIRS.format(duplicate="s.o_orderkey % 79 = 0"),
    "recon_nulls": _TARGET + """
        SELECT 'o_orderkey' AS column, 0 AS source_nulls, 0 AS target_nulls, false AS alert
        UNION ALL SELECT 'o_totalprice', 0, 0, false
        UNION ALL
        SELECT 'o_orderpriority', (SELECT count(*) FROM orders WHERE o_orderpriority IS NULL), n, n > 0
        FROM (SELECT count(*) AS n FROM target WHERE o_orderpriority IS NULL)""",
    "freshness": """
        SELECT event_type, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last_ts,
               date_sub('minute', max(ts), TIMESTAMP '2024-01-30 23:59:59') AS lag_minutes,
               date_sub('second', max(ts), TIMESTAMP '2024-01-30 23:59:59') > 600 AS stale
        FROM events GROUP BY 1""",
    "state_transitions": _STATUS + _CHANGED + f"""
        SELECT job, state, {_TS}, event_id, previous_state, {_LEVEL} AS alert_level
        FROM changed WHERE state IS DISTINCT FROM previous_state""",
    "job_alerts": _STATUS + _CHANGED + f"""
        SELECT job, state, {_TS}, event_id, {_LEVEL} AS alert_level FROM changed
        WHERE state IS DISTINCT FROM previous_state AND state IN ('RUNNING', 'FAILED', 'CANCELED')
        UNION ALL
        SELECT job, state, {_TS}, event_id, 'error' FROM status WHERE state = 'NOT_FOUND'""",
    "not_found_alerts": _STATUS + f"""
        SELECT job, state, {_TS}, event_id, 'error' AS alert_level FROM status
        WHERE state = 'NOT_FOUND'""",
    "metric_rollup": """
        SELECT user_id AS job,
               CAST(sum(CASE WHEN event_id % 6 <> 0 THEN floor(value) ELSE 0 END) AS BIGINT)
                   AS total_read_records,
               CAST(sum(length(props)) AS BIGINT) AS total_read_bytes
        FROM events GROUP BY 1""",
    "failure_alerts": _RUNS.format(failed="ERROR"),
    "failed_job_alerts": _RUNS.format(failed="FAILED"),
    "resubmit_actions": f"""
        WITH last AS (
          SELECT o_custkey AS job, {_NAME.format('o_custkey')} AS name,
                 CASE o_orderstatus WHEN 'F' THEN 'FAILED' WHEN 'P' THEN 'CANCELED' ELSE 'RUNNING' END
                     AS state,
                 row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC)
                     AS rn
          FROM orders WHERE o_custkey % 5 = 0)
        SELECT job, name, state, 'restart' AS action FROM last
        WHERE rn = 1 AND state IN ('FAILED', 'CANCELED')
        UNION ALL
        SELECT c_custkey, {_NAME.format('c_custkey')}, NULL, 'resubmit' FROM customer
        WHERE c_custkey % 5 = 0 AND c_custkey NOT IN (SELECT o_custkey FROM orders)""",
    "job_types": """
        SELECT CASE c_custkey % 5 WHEN 0 THEN 'kafka' WHEN 1 THEN 'mysql_cdc' WHEN 2 THEN 'mysql_cdc'
                    WHEN 3 THEN 'doris' ELSE 'unknown' END AS job_type, count(*) AS jobs
        FROM customer GROUP BY 1""",
    "part_kinds": """
        SELECT CASE WHEN p_name LIKE '%ring%' OR p_name LIKE '%red%' THEN 'first'
                    WHEN p_name LIKE '%bolt%' THEN 'second'
                    WHEN p_name LIKE '%widget%' OR p_name LIKE '%blue%' THEN 'third'
                    ELSE 'other' END AS job_type, count(*) AS jobs
        FROM part GROUP BY 1""",
    "alert_suppressed": _ALERTS.replace("WITH", "WITH RECURSIVE") + _SUPPRESSED.format(
        key="alert_type", rows="alerts", quiet=1800) + f"""
        SELECT a.alert_type, a.level, {_TS}, a.event_id
        FROM sent JOIN firsts f USING (alert_type, sec)
        JOIN alerts a ON a.alert_type = f.alert_type AND (a.ts, a.event_id) = f.at""",
    "alert_suppressed_by_job": "WITH RECURSIVE one AS (SELECT 1)" + _SUPPRESSED.format(
        key="user_id", rows="events", quiet=86400) + f"""
        SELECT e.user_id, {_TS}, e.event_id
        FROM sent JOIN firsts f USING (user_id, sec)
        JOIN events e ON e.user_id = f.user_id AND (e.ts, e.event_id) = f.at""",
    "alert_routing": _ALERTS + f"""
        SELECT alert_type, level, {_TS}, event_id FROM alerts
        WHERE level <> 'info' OR alert_type IN ('recovery', 'daily_report')""",
    "daily_report": _ALERTS + """
        SELECT strftime(d, '%Y-%m-%d') AS report_day, count(*) AS rows,
               count(*) FILTER (level = 'error') AS errors, count(*) FILTER (level = 'warning') AS warnings
        FROM (SELECT CAST(ts - INTERVAL 8 HOUR AS DATE) + 1 AS d, level FROM alerts)
        WHERE isodow(d) <= 5 GROUP BY 1""",
    "resource_alerts": """
        SELECT host, metric, value, event_id FROM (
          SELECT user_id AS host, value, event_id,
                 CASE event_id % 3 WHEN 0 THEN 'disk' WHEN 1 THEN 'memory' ELSE 'cpu' END AS metric
          FROM events)
        WHERE value > CASE metric WHEN 'disk' THEN 85 WHEN 'memory' THEN 90 ELSE 80 END""",
    "feature_match": _FEATURES + """
        , p AS (
          SELECT job, candidate, count(*) AS shared,
                 count(*) FILTER (starts_with(feature, 'sink_table:')) AS shared_sinks
          FROM a JOIN b USING (feature) GROUP BY 1, 2),
        na AS (SELECT job, count(*) AS n FROM a GROUP BY 1),
        nb AS (SELECT candidate, count(*) AS n FROM b GROUP BY 1),
        s AS (
          SELECT job, candidate, shared, shared_sinks, 2 * shared + shared_sinks AS x,
                 na.n + nb.n - shared AS u
          FROM p JOIN na USING (job) JOIN nb USING (candidate)),
        t AS (SELECT *, x / (2 * u) AS score, (200 * x + 2 * u) // (4 * u) AS pct FROM s)
        SELECT job, candidate, shared, shared_sinks, score,
               CASE WHEN pct >= 80 THEN 'excellent' WHEN pct >= 60 THEN 'good'
                    WHEN pct >= 30 THEN 'fair' ELSE 'poor' END AS tier,
               CAST(row_number() OVER (PARTITION BY job ORDER BY score DESC, candidate) AS INTEGER) AS rank
        FROM t""",
    "combined_match": _FEATURES + """
        , f AS (SELECT DISTINCT feature FROM a),
        tot AS (SELECT count(*) AS n, count(*) FILTER (starts_with(feature, 'sink_table:')) AS sinks FROM f),
        nb AS (SELECT candidate, count(*) AS m FROM b GROUP BY 1),
        h AS (
          SELECT candidate, count(*) AS shared,
                 count(*) FILTER (starts_with(feature, 'sink_table:')) AS shared_sinks
          FROM f JOIN b USING (feature) GROUP BY 1),
        s AS (
          SELECT candidate, shared, shared_sinks, shared / (n + m - shared) AS base_score,
                 shared_sinks / sinks AS sink_coverage
          FROM h JOIN nb USING (candidate), tot),
        t AS (SELECT *, base_score * CAST(0.6 AS DOUBLE) + sink_coverage * CAST(0.4 AS DOUBLE) AS score FROM s)
        SELECT candidate, shared, shared_sinks, base_score, sink_coverage, score,
               CASE WHEN score >= 0.8 THEN 'high' WHEN score >= 0.6 THEN 'good'
                    WHEN score >= 0.4 THEN 'medium' ELSE 'low' END AS tier
        FROM t""",
}
