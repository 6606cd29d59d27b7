"""Seeded row generation: sequences and random text as column expressions."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Sequence:
    """Values ``start..end`` in turn, wrapping around. Numbers, or ISO times with ``step``."""

    start: object
    end: object
    step: str = "1 second"


@dataclass(frozen=True)
class RandomText:
    """Text of a fixed length that depends on seed, column and row only."""

    length: int


def generated(index: Column, name: str, kind, seed: int = 0) -> Column:
    """One generated column as an expression over a row index that starts at 0."""
    if isinstance(kind, RandomText):
        blocks = -(-kind.length // 32)
        parts = [
            F.md5(F.concat_ws(":", F.lit(f"{seed}:{name}:{b}"), index.cast("string")).cast("binary"))
            for b in range(blocks)
        ]
        return F.substring(F.concat(*parts), 1, kind.length)
    if isinstance(kind, Sequence) and isinstance(kind.start, int):
        return F.lit(kind.start).cast("bigint") + F.pmod(index, F.lit(kind.end - kind.start + 1))
    if isinstance(kind, Sequence):
        day = len(str(kind.start)) == len("yyyy-MM-dd")
        start, end = (F.expr(f"timestamp_ntz'{v}'") for v in (kind.start, kind.end))
        step = F.lit(86400 if day else _seconds(kind.step))
        count = F.floor(F.timestamp_diff("SECOND", start, end) / step) + 1
        value = F.timestamp_add("SECOND", F.pmod(index, count) * step, start)
        return value.cast("date") if day else value
    raise TypeError(f"unknown generator for {name}: {kind!r}")


def _seconds(step: str) -> int:
    amount, unit = step.split()
    return int(amount) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]


def with_generated(
    df: DataFrame, index: Column, columns: Mapping[str, object], seed: int = 0
) -> DataFrame:
    """Add generated columns to rows that already carry an index."""
    return df.withColumns({n: generated(index, n, k, seed) for n, k in columns.items()})


def read_generated(
    spark: SparkSession,
    columns: Mapping[str, object],
    rows: int | None = None,
    rows_per_second: int | None = None,
    seed: int = 0,
) -> DataFrame:
    """Generated table of ``rows`` rows, or an endless stream of ``rows_per_second``."""
    if rows_per_second:
        base = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
        base = base.select(F.col("value").alias("id"))
    else:
        base = spark.range(rows)
    return with_generated(base, F.col("id"), columns, seed).select(*columns)
