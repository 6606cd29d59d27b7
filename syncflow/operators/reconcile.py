"""Reconciliation of a source table with its mirror."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from syncflow import storage
from syncflow.functions.times import as_instant

# Tolerated row difference, and minutes without new data.
MAX_ROW_DIFF = 100
MAX_LAG_MINUTES = 10

# Buckets of a digest are 2**DIGEST_BITS on each level.
DIGEST_BITS = 12
DIGEST_LEVELS = 2


def _tagged_counts(df: DataFrame, keys: Sequence[str], side: int) -> DataFrame:
    n, zero = F.count(F.lit(1)), F.lit(0).cast("bigint")
    return df.groupBy(*keys).agg(
        (n if side == 0 else zero).alias("source_rows"), (n if side == 1 else zero).alias("target_rows")
    )


def compare_counts(
    source: DataFrame, target: DataFrame, by: Sequence[str] = (), max_diff: int = MAX_ROW_DIFF
) -> DataFrame:
    """Row counts of both sides, their difference and whether it exceeds ``max_diff``.

    With ``by`` one row per group. Each side is counted before the shuffle and the counts
    are added up in one aggregation: no join, and groups missing on a side count 0.
    """
    both = _tagged_counts(source, by, 0).unionByName(_tagged_counts(target, by, 1))
    diff = F.abs(F.col("source_rows") - F.col("target_rows"))
    return (
        both.groupBy(*by)
        .agg(F.sum("source_rows").alias("source_rows"), F.sum("target_rows").alias("target_rows"))
        .withColumn("diff", diff)
        .withColumn("alert", F.col("diff") > max_diff)
    )


def compare_rows(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    unique_keys: bool = False,
) -> DataFrame:
    """Keys that differ: ``missing`` in the target, ``extra`` there, ``changed`` or ``duplicate``.

    ``changed_columns`` names the differing columns (NULLs compare as equal). With
    ``unique_keys``, for sides known to hold each key once (a primary key, a keyed mirror),
    it is a full join. Otherwise each side is combined by key ahead of the shuffle, so that
    a key repeated without end is reported instead of multiplied.
    """
    pairs = (_joined if unique_keys else _combined)(source, target, keys, columns)
    names = [F.when(~F.col(f"_s.{c}").eqNullSafe(F.col(f"_t.{c}")), F.lit(c)) for c in columns]
    status = (
        F.when(F.col("target_rows") == 0, "missing")
        .when(F.col("source_rows") == 0, "extra")
        .when((F.col("source_rows") > 1) | (F.col("target_rows") > 1), "duplicate")
        .when(~F.col("_s").eqNullSafe(F.col("_t")), "changed")
    )
    return (
        pairs.withColumn("status", status)
        .where(F.col("status").isNotNull())
        .select(
            *keys,
            "status",
            F.when(F.col("status") == "changed", F.concat_ws(",", *names)).alias("changed_columns"),
        )
    )


def _joined(source: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    def side(df: DataFrame, image: str, rows: str) -> DataFrame:
        named = [F.col(k).alias(f"{image}_{i}") for i, k in enumerate(keys)]
        return df.select(*named, F.struct(*columns).alias(image), F.lit(1).alias(rows))

    # A NULL key is a key like others.
    same = [F.col(f"_s_{i}").eqNullSafe(F.col(f"_t_{i}")) for i in range(len(keys))]
    both = side(source, "_s", "source_rows").join(side(target, "_t", "target_rows"), same, "full")
    named = [F.coalesce(f"_s_{i}", f"_t_{i}").alias(k) for i, k in enumerate(keys)]
    return both.select(*named, "_s", "_t", "source_rows", "target_rows").fillna(0, ["source_rows", "target_rows"])


def _bucket(level: int) -> Column:
    return F.shiftright("_key", DIGEST_BITS * level).bitwiseAND(F.lit(2**DIGEST_BITS - 1)).alias(f"_b{level}")


def unlike_buckets(
    source: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str], levels: int = DIGEST_LEVELS
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Both sides with buckets ``_b0``, ``_b1``, ..., and the buckets of the last level in which they differ.

    A digest tree, from the root down: each side adds up hashes of its rows by bucket ahead of the shuffle,
    so what is exchanged is a number a bucket and task; the next level looks only into buckets that are
    unlike. Equal sides differ in no bucket of the first level, and exchange nothing else.
    """
    def digests(df: DataFrame, sign: int) -> DataFrame:
        # Hashes skip NULLs, so where they are is hashed as well.
        key = F.xxhash64(*keys, *[F.col(k).isNull() for k in keys])
        row = F.xxhash64(*keys, *columns, *[F.col(c).isNull() for c in (*keys, *columns)])
        named = df.withColumn("_key", key).withColumn("_row", row.cast("decimal(20,0)") * sign)
        return named.select("*", *[_bucket(level) for level in range(levels)]).withColumn("_side", F.lit(sign))

    here, there = digests(source, 1), digests(target, -1)
    unlike = None
    for level in range(levels):
        by = [f"_b{i}" for i in range(level + 1)]
        sums = []
        for side in (here, there):
            # A level has 2**DIGEST_BITS buckets for each that is unlike above it. The first
            # level's are few enough for a broadcast; what further ones take goes by measured size.
            seen = side if unlike is None else side.join(F.broadcast(unlike) if level == 1 else unlike, by[:-1], "left_semi")
            sums.append(seen.select(*by, "_side", "_row"))
        both = sums[0].unionByName(sums[1]).groupBy(*by).agg(F.sum("_side").alias("n"), F.sum("_row").alias("digest"))
        unlike = storage.written(both.where("n <> 0 OR digest <> 0").select(*by), "unlike")
    return here, there, unlike


def compare_digests(
    source: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str], levels: int = DIGEST_LEVELS
) -> DataFrame:
    """``compare_rows`` for sides that hold each key once and differ little, far apart or large.

    Only rows of buckets whose digests differ are brought together by key.
    """
    here, there, unlike = unlike_buckets(source, target, keys, columns, levels)
    by = unlike.columns
    sides = [df.join(unlike, by, "left_semi").select(*keys, *columns) for df in (here, there)]
    return compare_rows(*sides, keys, columns, unique_keys=True)


def _combined(source: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    def tagged(df: DataFrame, here: str, other: str) -> DataFrame:
        image = df.select(*keys, F.struct(*columns).alias(here))
        return image.withColumn(other, F.lit(None).cast(image.schema[here].dataType))

    both = tagged(source, "_s", "_t").unionByName(tagged(target, "_t", "_s"))
    return both.groupBy(*keys).agg(
        F.count("_s").alias("source_rows"), F.count("_t").alias("target_rows"),
        F.max("_s").alias("_s"), F.max("_t").alias("_t"),
    )


def null_counts(source: DataFrame, target: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs per column on both sides, and whether the target lost values."""
    def counted(df: DataFrame, side: str) -> DataFrame:
        counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
        cells = [F.struct(F.lit(c).alias("column"), F.col(c).alias("n")) for c in columns]
        other = "target_nulls" if side == "source_nulls" else "source_nulls"
        return counts.select(F.inline(F.array(*cells))).select(
            "column", F.col("n").alias(side), F.lit(0).cast("bigint").alias(other)
        )

    both = counted(source, "source_nulls").unionByName(counted(target, "target_nulls"))
    return (
        both.groupBy("column")
        .agg(F.sum("source_nulls").alias("source_nulls"), F.sum("target_nulls").alias("target_nulls"))
        .withColumn("alert", F.col("target_nulls") > F.col("source_nulls"))
    )


def freshness(
    df: DataFrame, ts: str, as_of=None, by: Sequence[str] = (), max_minutes: int = MAX_LAG_MINUTES
) -> DataFrame:
    """Minutes since the last change; stale above ``max_minutes`` or when there is no row."""
    lag = F.timestamp_diff("MINUTE", F.col("last_ts"), as_instant(as_of))
    seconds = F.timestamp_diff("SECOND", F.col("last_ts"), as_instant(as_of))
    return (
        df.groupBy(*by)
        .agg(F.max(ts).alias("last_ts"))
        .withColumn("lag_minutes", lag)
        .withColumn("stale", F.coalesce(seconds > max_minutes * 60, F.lit(True)))
    )
