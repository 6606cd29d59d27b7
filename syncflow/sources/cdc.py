"""Change events: envelope decoding, startup positions and the snapshot branch."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from syncflow.functions.times import MAX_EPOCH_MILLIS, MIN_EPOCH_MILLIS, utc_wall
from syncflow.functions.types import (
    binary_decimal, binary_decimal_text, cast_text, resolve_type, time_precision, wide_decimal,
)

_CORRUPT = "_corrupt_record"

# The modes a change scan can start in, and the snapshot modes that
# read the table as it is before the changes.
STARTUP_MODES = ("initial", "earliest-offset", "latest-offset", "specific-offset", "timestamp")
SNAPSHOT_MODES = {
    "initial": True,
    "when_needed": True,
    "never": False,
    "schema_only": False,
    "schema_only_recovery": False,
}


# How decimals come: as text or numbers, or as Base64 of their binary form.
DECIMAL_MODES = ("string", "double", "precise")


def _cell(col: Column, to, timestamp_standard: str, decimals: str) -> Column:
    """A value of a row image. Times come as text, or as numbers: epoch days, and epoch
    milliseconds or, for columns declared with more than three digits, microseconds."""
    unit = 1000 if time_precision(to) > 3 else 1
    wide = wide_decimal(to)
    cast, to = cast_text(col, to, timestamp_standard), resolve_type(to)
    if isinstance(to, T.DecimalType) and decimals == "precise":
        return binary_decimal(col, to)
    if wide and decimals == "precise":
        return binary_decimal_text(col, *wide)
    is_number = col.rlike(r"^-?\d+$")
    if isinstance(to, (T.TimestampType, T.TimestampNTZType)):
        number = col.try_cast("bigint")
        number = F.when(number.between(MIN_EPOCH_MILLIS * unit, MAX_EPOCH_MILLIS * unit), number)
        instant = F.timestamp_micros(number) if unit > 1 else F.timestamp_millis(number)
        moment = utc_wall(instant) if isinstance(to, T.TimestampNTZType) else instant
        return F.when(is_number, moment).otherwise(cast)
    if isinstance(to, T.DateType):
        return F.when(is_number, F.date_add(F.lit("1970-01-01").cast("date"), col.try_cast("int"))).otherwise(cast)
    return cast


def image_cells(
    image: str, fields: Mapping[str, object], timestamp_standard: str = "SQL", decimals: str = "string"
) -> list[Column]:
    """Typed columns of a row image that was parsed as text."""
    if decimals not in DECIMAL_MODES:
        raise ValueError(f"unknown decimal mode: {decimals!r}")
    return [_cell(F.col(f"{image}.`{n}`"), t, timestamp_standard, decimals).alias(n) for n, t in fields.items()]


def parse_envelope(
    df: DataFrame, fields: Sequence[str], value: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """Parse ``{op, ts_ms, before, after, source}`` envelopes, bare or below ``payload``.

    Gives ``op``, ``seq`` (log file by number and name, position, row and time: a total order
    within one source; the clock comes last, as it may step back) and the images ``before`` and ``after`` as text fields. Tombstones (no value),
    schema-change events and anything else without an ``op`` are dropped.
    """
    image = T.StructType([T.StructField(n, T.StringType()) for n in fields])
    position = T.StructType(
        [T.StructField(n, T.StringType()) for n in ("ts_ms", "file", "pos", "row")]
    )
    body = [
        T.StructField("op", T.StringType()),
        T.StructField("ts_ms", T.StringType()),
        T.StructField("before", image),
        T.StructField("after", image),
        T.StructField("source", position),
    ]
    schema = T.StructType(
        [*body, T.StructField("payload", T.StructType(body)), T.StructField(_CORRUPT, T.StringType())]
    )
    parsed = F.from_json(
        F.col(value).cast("string"),
        schema,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT},
    )

    def either(name: str) -> Column:
        return F.coalesce(F.col(name), F.col(f"payload.{name}"))

    def number(name: str) -> Column:
        return F.coalesce(F.col(name).try_cast("bigint"), F.lit(0))

    log_number = F.regexp_extract(F.col("source.file"), r"(\d+)$", 1).try_cast("bigint")
    seq = F.struct(
        F.coalesce(log_number, F.lit(0)).alias("log"),
        F.coalesce(F.col("source.file"), F.lit("")).alias("file"),
        number("source.pos").alias("pos"),
        number("source.row").alias("row"),
        F.coalesce(F.col("source.ts_ms").try_cast("bigint"), number("ts_ms")).alias("ts_ms"),
    )
    return (
        # A tombstone parses to a row of NULLs, which the test for an op drops.
        df.select(*keep, F.inline(F.array(parsed)))
        .where(F.col(_CORRUPT).isNull())
        .select(*keep, *[either(f.name).alias(f.name) for f in body])
        .where(F.col("op").isNotNull())
        .select(*keep, "op", seq.alias("seq"), "before", "after")
    )


def decode_envelope(
    df: DataFrame,
    fields: Mapping[str, object],
    value: str = "value",
    keep: Sequence[str] = (),
    timestamp_standard: str = "SQL",
    decimals: str = "string",
) -> DataFrame:
    """Change envelopes with both images typed; an image that is absent is NULL."""
    def typed(name: str) -> Column:
        image = F.struct(*image_cells(name, fields, timestamp_standard, decimals))
        return F.when(F.col(name).isNotNull(), image).alias(name)

    parsed = parse_envelope(df, list(fields), value, keep)
    return parsed.select(*keep, "op", "seq", typed("before"), typed("after"))


def includes_snapshot(startup: str, snapshot_mode: str = "initial") -> bool:
    """Whether the scan begins with the rows the table holds already."""
    if startup not in STARTUP_MODES:
        raise ValueError(f"unknown startup mode: {startup!r}")
    if snapshot_mode not in SNAPSHOT_MODES:
        raise ValueError(f"unknown snapshot mode: {snapshot_mode!r}")
    return startup == "initial" and SNAPSHOT_MODES[snapshot_mode]


def start_changes(
    changes: DataFrame,
    startup: str = "initial",
    seq: str = "seq",
    position: Column | None = None,
    ts: str | None = None,
    since: Column | None = None,
) -> DataFrame:
    """The changes a scan sees when started in the given mode.

    ``latest-offset`` takes the changes after ``position`` (the end of the log at start
    time), ``specific-offset`` those from ``position`` on, ``timestamp`` those with ``ts``
    at or after ``since``.
    """
    if startup not in STARTUP_MODES:
        raise ValueError(f"unknown startup mode: {startup!r}")
    if startup in ("latest-offset", "specific-offset") and position is None:
        raise ValueError(f"startup mode {startup!r} needs a position")
    if startup == "timestamp" and (ts is None or since is None):
        raise ValueError("startup mode 'timestamp' needs ts and since")
    if startup == "latest-offset":
        return changes.where(F.col(seq) > position)
    if startup == "specific-offset":
        return changes.where(F.col(seq) >= position)
    if startup == "timestamp":
        return changes.where(F.col(ts) >= since)
    return changes
