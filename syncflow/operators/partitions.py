"""Day partitions and hash distribution as DataFrame operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from syncflow.functions.times import as_day

# The dynamic partition window, in days around the current one, and
# the number of hash buckets.
RETAIN_DAYS = 90
AHEAD_DAYS = 3
BUCKETS = 10


def rows_per_day(df: DataFrame, day: str = "partition_day") -> DataFrame:
    return df.groupBy(day).agg(F.count(F.lit(1)).alias("rows"))


def retained(
    df: DataFrame, day: str = "partition_day", as_of=None, days: int = RETAIN_DAYS
) -> DataFrame:
    """Rows on days that are kept; prunes partitions when ``day`` is a partition column."""
    return df.where(F.col(day) >= F.date_sub(as_day(as_of), days))


def partition_coverage(
    df: DataFrame,
    day: str = "partition_day",
    as_of=None,
    days: int = RETAIN_DAYS,
    ahead: int = AHEAD_DAYS,
) -> DataFrame:
    """Every day of the partition window with its row count, empty days included.

    The calendar rows join the changes as zero counts of one aggregation, so there is no
    join, and only counts per day are shuffled.
    """
    today = as_day(as_of)
    first, last = F.date_sub(today, days), F.date_add(today, ahead)
    calendar = df.sparkSession.range(1).select(
        F.explode(F.sequence(first, last)).alias(day), F.lit(0).cast("bigint").alias("rows")
    )
    counts = rows_per_day(df.where(F.col(day).between(first, last)), day)
    return calendar.unionByName(counts).groupBy(day).agg(F.sum("rows").alias("rows"))


def bucket_of(keys: Sequence[str], buckets: int = BUCKETS, schema: T.StructType | None = None) -> Column:
    """Hash bucket of a key. With the schema, whole numbers of any width fall into the same one."""
    whole = [k for k in keys if schema and isinstance(schema[k].dataType, T.IntegralType)]
    return F.pmod(F.hash(*[F.col(k).cast("bigint") if k in whole else F.col(k) for k in keys]), F.lit(buckets))


def modulo_bucket(key: str, buckets: int = BUCKETS) -> Column:
    """Bucket of an integer key by plain modulo."""
    return F.pmod(F.col(key), F.lit(buckets)).cast("int")


def bucket_sizes(df: DataFrame, bucket: Column) -> DataFrame:
    return df.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("rows"))


def spread_randomly(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Round-robin distribution; without a number AQE picks the partition sizes."""
    return df.repartition(partitions) if partitions else df.hint("rebalance")
