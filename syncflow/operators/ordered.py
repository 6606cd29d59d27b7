"""Rows in one order over the whole table, by ranges of that order.

A window over a key sorts all rows of that key in one task. Here rows are dealt out by ranges of
(key, order) instead, so a key with a third of all rows takes a third of the tasks. What a key hands
on from one range to the next is a summary row; only the first and last key of a range can have
others, so there are two such rows a range at most, whatever the table holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from syncflow import storage

AT = "_at"  # the place of a row: it grows along the order
PART = "_part"  # the range that the row is in; ranges are numbered along the order


def in_order(rows: DataFrame, *by: str | Column) -> DataFrame:
    """``rows`` with ``_at`` and ``_part``, sorted by ``by`` (NULLs first) and written by ranges.

    Rows that are equal in ``by`` are ordered as they are read, and may be split over ranges, so
    ``rows`` has to be read from files with nothing but row-wise steps on the way, or to be equal in
    all columns where equal in ``by``: a repeated task then gives the same rows again. The order of
    equal rows is settled once the table is written.
    """
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())
    ranges = tied.repartitionByRange(*by, "_tie").sortWithinPartitions(*by, "_tie").drop("_tie")
    placed = storage.written(ranges.withColumn(AT, F.monotonically_increasing_id()), "ordered")
    return placed.withColumn(PART, F.shiftright(AT, 33).cast("int"))


def within_part(*keys: str):
    """The window along the rows of a key that are in one range."""
    return Window.partitionBy(PART, *keys).orderBy(AT)


def counted_before(placed: DataFrame, *keys: str) -> DataFrame:
    """_part, the keys and ``_before``: rows of the key in earlier ranges, where there are any.

    At most one row a range, as only the key that a range begins with can have begun earlier.
    """
    runs = placed.groupBy(PART, *keys).agg(
        F.min(AT).alias("_from"), F.max(AT).alias("_to"), F.count("*").alias("_n")
    )
    ends = runs.groupBy(PART).agg(F.min("_from").alias("_lo"), F.max("_to").alias("_hi"))
    edges = runs.join(F.broadcast(ends), PART).where("_from = _lo OR _to = _hi")
    so_far = Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    return edges.select(PART, *keys, F.sum("_n").over(so_far).alias("_before")).where("_before > 0")


def filled(placed: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """``placed`` with the last value of ``column`` that is not NULL, up to each row of the whole order."""
    here = Window.partitionBy(PART).orderBy(AT).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = placed.groupBy(PART).agg(F.max_by(column, F.when(F.col(column).isNotNull(), F.col(AT))).alias("_last"))
    # One row a range, so one task orders as many rows as there are ranges.
    earlier = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select(PART, F.last("_last", ignorenulls=True).over(earlier).alias("_carried"))
    known = F.coalesce(F.last(column, ignorenulls=True).over(here), F.col("_carried"))
    return placed.join(F.broadcast(carried), PART).withColumn(name or column, known).drop("_carried")


def numbered(placed: DataFrame, *keys: str, name: str = "_index") -> DataFrame:
    """``placed`` with the number of each row within its key, from 0."""
    before = counted_before(placed, *keys).withColumnsRenamed({k: f"_of_{i}" for i, k in enumerate(keys)})
    before = before.withColumnRenamed(PART, "_in")
    same = F.col(PART) == F.col("_in")
    for i, key in enumerate(keys):
        same &= F.col(key).eqNullSafe(F.col(f"_of_{i}"))
    here = placed.withColumn(name, (F.row_number().over(within_part(*keys)) - 1).cast("long"))
    # One row a range at most, so the broadcast is bounded by the number of ranges.
    return here.join(F.broadcast(before), same, "left").select(
        *placed.columns, (F.col(name) + F.coalesce("_before", F.lit(0))).alias(name)
    )
