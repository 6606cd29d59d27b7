"""Event-time watermarks and tumbling windows, for streams and tables alike."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from syncflow.functions.times import interval_text


def with_event_time_limit(df: DataFrame, ts: str, delay: str = "5 seconds") -> DataFrame:
    """Bounded out-of-orderness. Rows are only dropped as late by a stateful step after it."""
    return df.withWatermark(ts, interval_text(delay))


def tumbling(df: DataFrame, ts: str, size: str) -> DataFrame:
    """Add ``window_start`` and ``window_end`` of the window a row falls into."""
    return (
        df.withColumn("_window", F.window(ts, interval_text(size)))
        .withColumn("window_start", F.col("_window.start"))
        .withColumn("window_end", F.col("_window.end"))
        .drop("_window")
    )


def window_counts(
    df: DataFrame, ts: str, size: str, by: Sequence[str] = (), aggregates: Sequence[Column] = ()
) -> DataFrame:
    """Rows (and further aggregates) per tumbling window and group."""
    return (
        df.groupBy(F.window(ts, interval_text(size)).alias("_window"), *by)
        .agg(F.count(F.lit(1)).alias("rows"), *aggregates)
        .withColumn("window_start", F.col("_window.start"))
        .withColumn("window_end", F.col("_window.end"))
        .drop("_window")
    )


def as_event_time(df: DataFrame, ts: str) -> DataFrame:
    """Zone-less times as instants: a watermark has to be on TIMESTAMP."""
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        return df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df
