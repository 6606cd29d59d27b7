"""Append-only target, partitioned by day: every row is kept, repeated ones too."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from syncflow import storage
from syncflow.operators.partitions import RETAIN_DAYS
from syncflow.sinks.commits import CommitLog, widened

_ATTEMPT = "_load_attempt"
# Every so many commits the whole list of loads is written, the others name what they add.
_LISTED_EVERY = 64


def _state(log: CommitLog) -> tuple[dict, list[str], list[str]]:
    """The last commit, the attempts that are in, and those of them that were merged before."""
    entries = log.since("attempts")
    attempts: list[str] = []
    merged: list[str] = []
    for entry in entries:
        if "attempts" in entry:
            attempts, merged = list(entry["attempts"]), list(entry["merged"])
        else:
            attempts.append(entry["added"])
    return entries[-1] if entries else {}, attempts, merged


def _read(spark: SparkSession, path: str, schema: T.StructType, attempts: list[str]) -> DataFrame:
    if not attempts:
        return spark.createDataFrame([], schema)
    whole = T.StructType([*schema.fields, T.StructField(_ATTEMPT, T.StringType())])
    reader = spark.read.schema(whole).option("basePath", f"{path}/data")
    return reader.parquet(*[f"{path}/data/{_ATTEMPT}={a}" for a in attempts]).select(*schema.names)


def _write(rows: DataFrame, path: str, day: str, rebalance: bool, max_records_per_file: int) -> str:
    # Begins with a letter, so that it never looks like a number.
    attempt = f"try{uuid.uuid4().hex}"
    rows = rows.hint("rebalance", day) if rebalance else rows
    rows.write.partitionBy(day).option("maxRecordsPerFile", max_records_per_file).parquet(
        f"{path}/data/{_ATTEMPT}={attempt}"
    )
    return attempt


def append_by_day(
    df: DataFrame,
    path: str,
    label: str,
    day: str = "partition_day",
    rebalance: bool = True,
    max_records_per_file: int = 0,
    owner: str | None = None,
) -> bool:
    """Append a load to the day partitions; a label that is in already changes nothing.

    Every attempt writes to a folder of its own, and counts only once it is recorded, so what
    a broken attempt left is never read. The columns are recorded too: later loads may add
    columns or widen numbers, nothing else. ``owner`` names the flow; a label that another one
    used is an error. ``rebalance`` evens out file sizes (a hot day is split over several
    files) at the price of a shuffle; a micro-batch that falls into one day can do without.
    """
    log = CommitLog(df.sparkSession, path)
    if log.has(label, owner):
        return False
    last, attempts, merged = _state(log)
    if last and last["day"] != day:
        raise ValueError(f"{path} is partitioned by {last['day']!r}, not by {day!r}")
    schema = widened(last.get("schema"), df.schema)
    rows = df.select(*[F.col(f"`{c}`").cast(schema[c].dataType).alias(c) for c in df.columns])
    attempt = _write(rows, path, day, rebalance, max_records_per_file)
    state = {"schema": schema.jsonValue(), "day": day}
    if not last or (last["version"] + 1) % _LISTED_EVERY == 0:
        log.record(label, owner, **state, attempts=[*attempts, attempt], merged=merged)
    else:
        log.record(label, owner, **state, added=attempt)
    return True


def read_by_day(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the loads recorded by now; a load that is recorded later is not seen."""
    last, attempts, _ = _state(CommitLog(spark, path))
    if not last:
        raise FileNotFoundError(f"no load was recorded in {path}")
    return _read(spark, path, T.StructType.fromJson(last["schema"]), attempts)


def merge_loads(spark: SparkSession, path: str) -> int:
    """Write the loads since the last call together, so that readers find few large files.

    Each row is written again once. The single loads stay until ``drop_replaced``.
    """
    log = CommitLog(spark, path)
    last, attempts, merged = _state(log)
    single = [a for a in attempts if a not in set(merged)]
    if len(single) < 2:
        return 0
    schema = T.StructType.fromJson(last["schema"])
    attempt = _write(_read(spark, path, schema, single), path, last["day"], True, 0)
    done = [*merged, attempt]
    log.record(f"merged-{attempt}", schema=last["schema"], day=last["day"], attempts=done, merged=done)
    return len(single)


def drop_replaced(spark: SparkSession, path: str) -> int:
    """Delete folders of broken or merged loads; run it when nobody reads or writes the table."""
    live = set(_state(CommitLog(spark, path))[1])
    names = storage.child_names(spark, f"{path}/data")
    dead = [n for n in names if n.startswith(f"{_ATTEMPT}=") and n.partition("=")[2] not in live]
    return sum(storage.delete(spark, f"{path}/data/{n}") for n in dead)


def drop_old_days(
    spark: SparkSession, path: str, as_of: dt.date, days: int = RETAIN_DAYS
) -> list[str]:
    """Delete the day partitions older than ``days`` before ``as_of``; gives the days dropped."""
    limit = (as_of - dt.timedelta(days=days)).isoformat()
    last, attempts, _ = _state(CommitLog(spark, path))
    dropped = set()
    for attempt in attempts:
        folder = f"{path}/data/{_ATTEMPT}={attempt}"
        for name in storage.child_names(spark, folder):
            value = name.partition("=")[2]
            # ISO days compare as text; the partition of NULL days has another form and stays.
            if name.startswith(f"{last['day']}=") and value[:4].isdigit() and value < limit:
                storage.delete(spark, f"{folder}/{name}")
                dropped.add(value)
    return sorted(dropped)
