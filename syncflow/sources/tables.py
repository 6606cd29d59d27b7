"""Relational and file scans: partitioned JDBC reads, look-back slices, JSON files."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from syncflow.functions.times import as_col, hours_before

# Fixed value: rows of one snapshot chunk.
SNAPSHOT_CHUNK_ROWS = 8096

# Hours of the two incremental profiles.
LOOKBACK_HOURS = {"hourly": 1, "daily": 24}


def jdbc_options(
    url: str,
    table: str,
    column: str | None = None,
    lower: object = None,
    upper: object = None,
    partitions: int | None = None,
    fetch_size: int = 1000,
    where: str | None = None,
    connection: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of a JDBC scan, range-partitioned when ``column`` is given.

    ``lower`` and ``upper`` only set the stride of the partitions; rows outside are still
    read. Give ``where`` to restrict the rows, which the database then does.
    """
    source = f"(SELECT * FROM {table} WHERE {where}) AS slice" if where else table
    options = {"url": url, "dbtable": source, "fetchsize": str(fetch_size), **(connection or {})}
    if column is not None:
        if None in (lower, upper, partitions):
            raise ValueError("a partitioned scan needs lower, upper and partitions")
        options.update(
            partitionColumn=column,
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=str(partitions),
        )
    return options


def read_jdbc(spark: SparkSession, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**options)).load()


def jdbc_lookback_where(column: str, hours: int, now: str = "NOW()") -> str:
    """Predicate text for the database: rows updated within the last ``hours``."""
    return f"{column} >= DATE_SUB({now}, INTERVAL {int(hours)} HOUR)"


def jdbc_bounds_options(url: str, table: str, column: str, connection=None) -> dict[str, str]:
    """Options of the one-row query that :func:`chunk_count` and the stride need."""
    text = f"(SELECT MIN({column}) lo, MAX({column}) hi, COUNT(*) n FROM {table}) AS bounds"
    return {"url": url, "dbtable": text, **(connection or {})}


def read_jdbc_chunked(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    chunk_rows: int = SNAPSHOT_CHUNK_ROWS,
    connection: Mapping[str, str] | None = None,
    partitions: int | None = None,
    **options,
) -> DataFrame:
    """Range-partitioned scan that fetches ``chunk_rows`` rows at a time.

    ``partitions`` is the number of tasks, and so of connections; without it every chunk is one,
    which only small tables can do with.
    """
    options.setdefault("fetch_size", chunk_rows)
    bounds = (
        spark.read.format("jdbc")
        .options(**jdbc_bounds_options(url, table, column, connection))
        .load()
        .first()
    )
    lo, hi, n = bounds
    if not n:
        return read_jdbc(spark, url=url, table=table, connection=connection, **options)
    return read_jdbc(
        spark, url=url, table=table, column=column, lower=lo, upper=hi + 1,
        partitions=partitions or chunk_count(n, chunk_rows), connection=connection, **options,
    )


def chunk_count(rows: int, chunk_rows: int = SNAPSHOT_CHUNK_ROWS) -> int:
    return max(1, math.ceil(rows / chunk_rows))


def snapshot_chunks(
    df: DataFrame, key: str, chunk_rows: int = SNAPSHOT_CHUNK_ROWS
) -> DataFrame:
    """Chunk ranges of a snapshot over ``key`` and the rows that fall into each.

    The number of chunks is ``ceil(rows / chunk_rows)`` and the key range is cut evenly,
    as the partitioned scan does. The bounds come from a scalar subquery, so nothing is
    fetched to the driver.
    """
    bounds = df.agg(F.min(key).alias("lo"), F.max(key).alias("hi"), F.count(F.lit(1)).alias("n"))
    chunks = F.ceil(F.col("n") / F.lit(chunk_rows))
    stride = F.ceil((F.col("hi") - F.col("lo") + 1) / chunks)
    plan = bounds.select(F.struct("lo", stride.alias("stride"))).scalar()
    chunk = F.call_function("div", F.col(key) - plan.getField("lo"), plan.getField("stride"))
    return (
        df.select(chunk.alias("chunk"), F.col(key).alias("_key"))
        .groupBy("chunk")
        .agg(
            F.min("_key").alias("first_key"),
            F.max("_key").alias("last_key"),
            F.count(F.lit(1)).alias("rows"),
        )
    )


def incremental_slice(df: DataFrame, ts: str, as_of=None, hours: int = 1) -> DataFrame:
    """Rows updated within the last ``hours`` before ``as_of``; reaches the scan as a filter.

    The lower bound is the whole predicate: a row stamped after ``as_of`` is read as well,
    which an overlap re-read with a keyed target absorbs.
    """
    return df.where(as_col(ts) >= hours_before(as_of, hours))


def read_json_files(
    spark: SparkSession, path: str, schema: T.StructType | str, streaming: bool = False, **options
) -> DataFrame:
    reader = spark.readStream if streaming else spark.read
    return reader.schema(schema).options(**options).json(path)


def read_text_payloads(
    spark: SparkSession, path: str, streaming: bool = False, **options
) -> DataFrame:
    """Files with one JSON payload per line, as the ``value`` column a topic would give."""
    reader = spark.readStream if streaming else spark.read
    return reader.options(**options).text(path)
