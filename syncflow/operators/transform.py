"""Row transforms of a flow: mapping, cleaning, filtering, placement and the sink's column list."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from syncflow.functions.times import as_col, as_day


def _expr(value) -> Column:
    return value if isinstance(value, Column) else F.expr(value)


def map_columns(df: DataFrame, mapping: Mapping[str, str] | None) -> DataFrame:
    """Project ``source -> target`` names; without a mapping every column is kept."""
    if not mapping:
        return df
    return df.select(*[F.col(f"`{src}`").alias(dst) for src, dst in mapping.items()])


def compute_columns(df: DataFrame, computed: Mapping[str, Column | str] | None) -> DataFrame:
    """Add derived columns; each expression sees the columns before this step."""
    return df.withColumns({n: _expr(e) for n, e in computed.items()}) if computed else df


def clean_columns(df: DataFrame, clean: Mapping[str, Column | str] | None) -> DataFrame:
    """Replace columns by cleaned ones, e.g. ``{"user_ip": "COALESCE(user_ip, '0.0.0.0')"}``."""
    return compute_columns(df, clean)


def filter_rows(df: DataFrame, predicate: Column | str | None) -> DataFrame:
    return df if predicate is None else df.where(predicate)


def default_values(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """NULL replaced by a default, column by column."""
    return df.withColumns({n: F.coalesce(F.col(n), F.lit(v)) for n, v in defaults.items()})


def place_by_day(
    df: DataFrame, ts: str, day_col: str = "partition_day", fallback_day=None, as_text: bool = False
) -> DataFrame:
    """Add the day partition of ``ts``, with ``fallback_day`` (default: today) where it is NULL."""
    day = F.when(as_col(ts).isNotNull(), F.to_date(as_col(ts))).otherwise(as_day(fallback_day))
    return df.withColumn(day_col, F.date_format(day, "yyyy-MM-dd") if as_text else day)


def enforce_not_null(
    df: DataFrame, required: Sequence[str], observation: Observation | str | None = None
) -> DataFrame:
    """Drop rows with a NULL in a required column, and count them (see ``kept_where``)."""
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required], F.lit(True))
    return kept_where(df, complete, observation)


def kept_where(df: DataFrame, keep: Column, observation: Observation | str | None = None) -> DataFrame:
    """The rows for which ``keep`` is true. ``rows_in`` and ``rows_dropped`` go to the observation, which
    is an ``Observation`` for a batch, or a name under which a stream's progress has them."""
    keep = F.coalesce(keep, F.lit(False))
    if observation is not None:
        df = df.observe(
            observation, F.count(F.lit(1)).alias("rows_in"), F.count_if(~keep).alias("rows_dropped")
        )
    return df.where(keep)


def sink_columns(df: DataFrame, columns: Sequence[str] | Mapping[str, object]) -> DataFrame:
    """The sink's explicit column list, in its order and, if types are given, cast to them."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing for the sink: {missing}")
    if not isinstance(columns, Mapping):
        return df.select(*[F.col(f"`{c}`") for c in columns])
    return df.select(*[F.col(f"`{c}`").cast(t).alias(c) for c, t in columns.items()])


def too_long(limits: Mapping[str, int]) -> Column:
    """True where a text column exceeds the length the sink declares for it."""
    tests = [F.coalesce(F.length(F.col(c)) > n, F.lit(False)) for c, n in limits.items()]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """First rows for a look at the data (a debugging aid, so any ``n`` rows will do)."""
    return df.limit(n)
