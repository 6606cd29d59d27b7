"""Changelogs: normalising operations and materialising the latest row of each key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from syncflow.functions.times import as_col
from syncflow.operators.transform import kept_where
from syncflow.sources.cdc import image_cells, includes_snapshot, parse_envelope, start_changes

UPSERT, DELETE = "upsert", "delete"

# Operation codes of change events. r is a snapshot row.
OP_KINDS = {"c": UPSERT, "r": UPSERT, "u": UPSERT, "d": DELETE}


def op_kind(col) -> Column:
    """``upsert``, ``delete``, or NULL for a code that is no row change."""
    out = F.lit(None).cast("string")
    for code, kind in OP_KINDS.items():
        out = F.when(as_col(col) == code, F.lit(kind)).otherwise(out)
    return out


def normalise(events: DataFrame, keep: Sequence[str] = ("seq",)) -> DataFrame:
    """Decoded envelopes to ``kind``, order columns and the row image as plain columns.

    The row is the image after the change, or the one before it for a delete. Events that
    are no row change, or carry no image at all, are dropped.
    """
    row = F.coalesce(F.col("after"), F.col("before"))
    return (
        events.select(op_kind("op").alias("kind"), *keep, row.alias("_row"))
        .where(F.col("kind").isNotNull() & F.col("_row").isNotNull())
        .select("kind", *keep, "_row.*")
    )


def decode_changes(
    df: DataFrame,
    fields: Mapping[str, object],
    value: str = "value",
    keep: Sequence[str] = (),
    timestamp_standard: str = "SQL",
    kind: str = "kind",
    seq: str = "seq",
    decimals: str = "string",
) -> DataFrame:
    """Change envelopes straight to normalised changes; only the image that counts is typed.

    ``decimals`` is how the source sends them: ``string``, ``double`` or ``precise`` (binary). ``kind`` and ``seq`` name the columns of operation and order, which no field may be called.
    """
    if {kind, seq} & set(fields):
        raise ValueError(f"fields may not be called {kind!r} or {seq!r}: choose other names for these")
    row = F.coalesce(F.col("after"), F.col("before"))
    return (
        parse_envelope(df, list(fields), value, keep)
        .select(op_kind("op").alias(kind), *keep, F.col("seq").alias(seq), row.alias("_row"))
        .where(F.col(kind).isNotNull() & F.col("_row").isNotNull())
        .select(kind, *keep, seq, *image_cells("_row", fields, timestamp_standard, decimals))
    )


def retract_unmatched(changes: DataFrame, predicate: Column | str, kind: str = "kind") -> DataFrame:
    """A filter on a changelog: a row that no longer passes is deleted, not left as it was."""
    passes = F.coalesce(predicate if isinstance(predicate, Column) else F.expr(predicate), F.lit(False))
    return changes.withColumn(kind, F.when(passes, F.col(kind)).otherwise(F.lit(DELETE)))


def drop_incomplete(
    changes: DataFrame, required: Sequence[str], keys: Sequence[str], kind: str = "kind",
    observation: Observation | str | None = None,
) -> DataFrame:
    """Not-null rule on a changelog: a delete only has to have its key. Counts as ``kept_where`` does."""
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required], F.lit(True))
    has_key = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in keys], F.lit(True))
    return kept_where(changes, F.when(F.col(kind) == DELETE, has_key).otherwise(complete), observation)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of every key by ``order``.

    ``max`` over a struct that begins with the order columns is combined before the
    shuffle, so a key with a third of all rows sends one row per map task. Rows that tie on
    ``order`` are told apart by their other columns, the same way on every run.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    # Maps cannot be compared; their text stands in for them.
    maps = [c for c in rest if has_map(df.schema[c].dataType)]
    plain = [c for c in rest if c not in maps]
    place = F.struct(*order, *plain, *[F.to_json(F.struct(c)).alias(f"_text_{i}") for i, c in enumerate(maps)])
    if not maps:
        last = F.max(place)
    else:
        last = F.max_by(F.struct(*order, *rest), place)
    return (
        df.groupBy(*keys)
        .agg(last.alias("_last"))
        .select(*keys, *[F.col(f"_last.`{c}`").alias(c) for c in (*order, *rest)])
    )


def has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(has_map(f.dataType) for f in kind)
    return isinstance(kind, T.MapType) or isinstance(kind, T.ArrayType) and has_map(kind.elementType)


def live_rows(
    changes: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    kind: str = "kind",
    enable_delete: bool = True,
) -> DataFrame:
    """The table a changelog amounts to.

    With ``enable_delete`` a key whose last change is a delete is gone; without it delete
    events are ignored and the last upsert stays.
    """
    if not enable_delete:
        changes = changes.where(F.col(kind) != DELETE)
    last = latest_per_key(changes, keys, order)
    return last.where(F.col(kind) != DELETE).drop(kind)


def snapshot_and_changes(
    snapshot: DataFrame,
    changes: DataFrame,
    startup: str = "initial",
    snapshot_mode: str = "initial",
    phase: str = "phase",
    kind: str = "kind",
    **start,
) -> DataFrame:
    """One changelog out of the table as it was and the changes after it.

    ``phase`` (0 for snapshot rows, 1 for changes) goes first into the order, so any change
    wins over the snapshot. Startup and snapshot mode decide which branches take part.
    """
    later = start_changes(changes, startup, **start).withColumn(phase, F.lit(1))
    if not includes_snapshot(startup, snapshot_mode):
        return later
    first = snapshot.withColumn(phase, F.lit(0)).withColumn(kind, F.lit(UPSERT))
    return first.unionByName(later, allowMissingColumns=True)


def merge_latest(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Target after a batch. Applying a batch again, or an older one late, changes nothing."""
    return latest_per_key(target.unionByName(batch), keys, order)


def moved_days(
    changes: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    day: str,
    kind: str = "kind",
) -> DataFrame:
    """Live keys whose last change placed them on another day than their first one."""
    position = F.struct(*order)
    ends = changes.groupBy(*keys).agg(
        F.min(F.struct(position.alias("at"), F.col(day).alias("day"))).alias("_first"),
        F.max(F.struct(position.alias("at"), F.col(day).alias("day"), F.col(kind).alias("kind"))).alias(
            "_last"
        ),
    )
    return ends.where(
        (F.col("_last.kind") != DELETE) & ~F.col("_first.day").eqNullSafe(F.col("_last.day"))
    ).select(
        *keys, F.col("_first.day").alias("first_day"), F.col("_last.day").alias("last_day")
    )


def append_versus_unique(
    changes: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    day: str,
    kind: str = "kind",
) -> DataFrame:
    """Rows per day in an append-only target against live keys per day in a keyed one."""
    appended = changes.groupBy(day).agg(
        F.count(F.lit(1)).alias("appended_rows"), F.lit(0).cast("bigint").alias("live_keys")
    )
    unique = (
        live_rows(changes.select(*keys, *order, day, kind), keys, order, kind)
        .groupBy(day)
        .agg(F.lit(0).cast("bigint").alias("appended_rows"), F.count(F.lit(1)).alias("live_keys"))
    )
    return appended.unionByName(unique).groupBy(day).agg(
        F.sum("appended_rows").alias("appended_rows"), F.sum("live_keys").alias("live_keys")
    )
