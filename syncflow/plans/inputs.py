"""The given tables in the shapes the operators work on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from syncflow import storage

AS_OF = "2024-01-31 00:00:00"
HALF = "2024-01-16 00:00:00"
MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"

# Declared columns of a cold-start event.
COLD_START_FIELDS = {
    "uid": "BIGINT", "platformType": "STRING", "userIP": "STRING", "version": "STRING",
    "deviceId": "STRING", "timestamp": "STRING",
}
# Declared columns of the row images below.
CHANGE_FIELDS = {
    "user_id": "BIGINT", "event_id": "BIGINT", "value": "DOUBLE", "created_at": "TIMESTAMP(3)",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Times are compared as UTC wall time, whatever the zone of the machine.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    schema = table(spark, sf_dir, name).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
    return reader.parquet(sf_dir)


class PartedStream:
    """A table that arrives in parts, in the order of ``by``: ``FILES`` files, so one micro-batch, each.

    NULLs come first. Parts are written by as many tasks as they have files.
    """

    FILES = 4

    def __init__(
        self, spark: SparkSession, sf_dir: str, name: str, by: str | Column, parts: int = 4, ends: list | None = None
    ):
        self.by = F.col(by) if isinstance(by, str) else by
        self.rows = table(spark, sf_dir, name)
        self.path = storage.work_path(spark, f"arriving-{name}")
        parts = len(ends) + 1 if ends else parts
        cuts = [i / parts for i in range(1, parts)]
        ends = ends or self.rows.agg(F.percentile_approx(self.by, cuts, 100_000).alias("ends")).first().ends
        self.cuts = [None, *(ends or [None] * len(cuts)), None]
        self.arrived, self.parts = 0, parts

    def arrive(self, upto: int | None = None) -> None:
        """Let the next parts come in, up to that number of them in all."""
        upto = self.parts if upto is None else upto
        for at in range(self.arrived, upto):
            lo, hi = self.cuts[at], self.cuts[at + 1]
            rows = self.rows
            rows = rows if lo is None else rows.where(self.by > F.lit(lo))
            rows = rows if hi is None else rows.where((self.by <= F.lit(hi)) | (self.by.isNull() if at == 0 else F.lit(False)))
            rows.repartition(self.FILES).write.mode("append").parquet(self.path)
        self.arrived = upto

    def read(self) -> DataFrame:
        reader = self.rows.sparkSession.readStream.schema(self.rows.schema)
        return reader.option("maxFilesPerTrigger", self.FILES).parquet(self.path)


def text_of(ts: str) -> Column:
    return F.date_format(ts, MICROS)


def day_of(ts: str) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def cold_start_payloads(events: DataFrame) -> DataFrame:
    """Events as JSON records; every fifth one lacks its device."""
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    record = F.struct(
        F.col("user_id").alias("uid"),
        F.col("event_type").alias("platformType"),
        F.concat(F.lit("192.0.2."), (F.col("user_id") % 256).cast("string")).alias("userIP"),
        F.col("props").alias("version"),
        F.when(
            F.col("event_id") % 5 != 0, F.concat(F.lit("dev-"), F.col("user_id").cast("string"))
        ).alias("deviceId"),
        millis.cast("string").alias("timestamp"),
    )
    return events.select("event_id", F.to_json(record).alias("value"))


def damaged_payloads(events: DataFrame) -> DataFrame:
    """The same records, each tenth one cut off before its end."""
    cut = F.col("value").substr(F.lit(1), F.length("value") - 5)
    return cold_start_payloads(events).withColumn(
        "value", F.when(F.col("event_id") % 10 == 0, cut).otherwise(F.col("value"))
    )


def op_code() -> Column:
    return (
        F.when(F.col("event_type") == "signup", "c")
        .when(F.col("event_type") == "error", "d")
        .otherwise("u")
    )


def changes(events: DataFrame) -> DataFrame:
    """Events as a changelog keyed by user, ordered by (ts, event_id)."""
    kind = F.when(F.col("event_type") == "error", "delete").otherwise("upsert")
    return events.select("user_id", "ts", "event_id", "value", kind.alias("kind"))


def envelopes(events: DataFrame) -> DataFrame:
    """The same changelog as JSON change envelopes; each ninth one sits below ``payload``."""
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    row = F.struct(
        "user_id", "event_id", "value", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS").alias("created_at")
    )
    body = F.struct(
        op_code().alias("op"),
        millis.alias("ts_ms"),
        F.when(F.col("event_type") == "error", row).alias("before"),
        F.when(F.col("event_type") != "error", row).alias("after"),
        F.struct(
            millis.alias("ts_ms"), F.lit("log.000001").alias("file"), F.col("event_id").alias("pos")
        ).alias("source"),
    )
    wrapped = F.to_json(F.struct(body.alias("payload")))
    return events.select(
        F.when(F.col("event_id") % 9 == 0, wrapped).otherwise(F.to_json(body)).alias("value")
    )


def job_status(events: DataFrame) -> DataFrame:
    """Events as a job-status history: the job is the user, the state goes by event type."""
    state = (
        F.when(F.col("event_type") == "view", "RUNNING")
        .when(F.col("event_type") == "error", "FAILED")
        .when(F.col("event_type") == "click", "CANCELED")
        .when(F.col("event_type") == "signup", "NOT_FOUND")
        .otherwise("ERROR")
    )
    return events.select(F.col("user_id").alias("job"), state.alias("state"), "ts", "event_id")


def job_name(key: str) -> Column:
    """A job name for an integer key."""
    part = F.col(key) % 5
    text = F.col(key).cast("string")
    return (
        F.when(part == 0, F.concat(F.lit("Kafka2Ods_"), text))
        .when(part == 1, F.concat(F.lit("mysql2ods_"), text))
        .when(part == 2, F.concat(F.lit("CDC_sync_"), text))
        .when(part == 3, F.concat(F.lit("load_doris_"), text))
        .otherwise(F.concat(F.lit("report_"), text))
    )


def order_status(orders: DataFrame) -> DataFrame:
    """Orders as a status history of one job per customer."""
    state = (
        F.when(F.col("o_orderstatus") == "F", "FAILED")
        .when(F.col("o_orderstatus") == "P", "CANCELED")
        .otherwise("RUNNING")
    )
    return orders.select(
        F.col("o_custkey").alias("job"), job_name("o_custkey").alias("name"), state.alias("state"),
        F.col("o_orderdate").alias("ts"), "o_orderkey",
    )


def alerts(events: DataFrame) -> DataFrame:
    """Events as an alert log."""
    level = (
        F.when(F.col("event_type") == "error", "error")
        .when(F.col("event_type") == "click", "warning")
        .otherwise("info")
    )
    kind = (
        F.when(F.col("event_type") == "signup", "recovery")
        .when(F.col("event_type") == "purchase", "daily_report")
        .otherwise(F.col("event_type"))
    )
    return events.select(kind.alias("alert_type"), level.alias("level"), "ts", "event_id")


def mirrored_orders(orders: DataFrame) -> DataFrame:
    """A copy of orders that lost rows, changed prices and lost priorities."""
    key = F.col("o_orderkey")
    return orders.where(key % 97 != 0).withColumns({
        "o_totalprice": F.when(key % 89 == 0, F.col("o_totalprice") + 1).otherwise(
            F.col("o_totalprice")
        ),
        "o_orderpriority": F.when(key % 83 != 0, F.col("o_orderpriority")),
    })


def order_features(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Feature sets of the orders: brands bought and suppliers delivering."""
    return (
        lineitem.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("l_orderkey").alias("job"),
            F.explode(F.array(
                F.concat(F.lit("source_table:"), F.col("p_brand")),
                F.concat(F.lit("sink_table:"), F.col("l_suppkey").cast("string")),
            )).alias("feature"),
        )
    )


def nation_features(supplier: DataFrame, nation: DataFrame, part: DataFrame) -> DataFrame:
    """Feature sets of the nations: their suppliers, and brands of the size they stand for."""
    sinks = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("candidate"),
        F.concat(F.lit("sink_table:"), F.col("s_suppkey").cast("string")).alias("feature"),
    )
    brands = part.join(nation, F.col("p_size") == F.col("n_nationkey") + 1).select(
        F.col("n_name").alias("candidate"),
        F.concat(F.lit("source_table:"), F.col("p_brand")).alias("feature"),
    )
    return sinks.unionByName(brands)
