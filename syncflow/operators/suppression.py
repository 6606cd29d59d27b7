"""Suppression of repeated alerts: one per type within a quiet period.

Whether an alert is sent depends on the last one sent, so a type is a chain in time. Sent times are whole
seconds, hence all that matters of a type is *which seconds* have an alert; repeated seconds are removed
ahead of the shuffle, and what is left is gathered into spans of time at least as long as the quiet period.

A span does not need to know what came before to be worked on. From outside it takes one number, how many
of its first seconds are still quiet, and hands on the same number to the span after it. That function
is a step function, and all spans work theirs out at the same time. Functions of adjacent spans are
composed: first along blocks of ``BLOCK`` spans, then over the blocks of a type, of which a year has
15. From there the number that each block, and then each span, is given is known, and the spans, again all
at the same time, say which of their seconds are sent. A pause as long as the quiet period makes a function
constant, which is the usual case and cuts the chain.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from syncflow import storage
from syncflow.functions.times import epoch_seconds

# Fixed value: seconds during which an alert of the same type is not repeated.
QUIET_SECONDS = 1800

# Seconds of a span, if the quiet period is not longer; spans whose functions are composed together.
SPAN = 32_768
BLOCK = 64

# The functions below travel with the job, so that executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: A step function: where its steps begin (the first at 0), and its values.
Steps = tuple[np.ndarray, np.ndarray]


def first_after_quiet(seconds: np.ndarray, ready: int, quiet: int) -> tuple[list[int], int]:
    """Seconds at which an alert is sent, given sorted seconds with alerts and the earliest
    second that may send; also that second as it is afterwards."""
    if quiet < 1:
        raise ValueError("the quiet period has to be a second at least")
    sent = []
    at = np.searchsorted(seconds, ready)
    while at < len(seconds):
        sent.append(int(seconds[at]))
        ready = sent[-1] + quiet
        at = np.searchsorted(seconds, ready)
    return sent, ready


def span_steps(seconds: np.ndarray, quiet: int, span: int) -> Steps:
    """What a span with alerts at the sorted ``seconds`` (from its start) makes of the quiet seconds it
    is given: how many of the first seconds after it are quiet."""
    following = np.searchsorted(seconds, seconds + quiet)
    last = np.where(following < len(seconds), following, np.arange(len(seconds)))
    while (further := last[last]).tobytes() != last.tobytes():
        last = further
    left = np.maximum(seconds[last] + quiet - span, 0)  # by the first second that is sent
    starts = np.concatenate(([0], seconds[seconds < quiet - 1] + 1))
    first = np.searchsorted(seconds, starts)
    return shortened(starts, np.append(left, 0)[np.minimum(first, len(seconds))])


def shortened(starts: np.ndarray, values: np.ndarray) -> Steps:
    is_step = np.concatenate(([True], values[1:] != values[:-1]))
    return starts[is_step], values[is_step]


def value_at(steps: Steps, x) -> np.ndarray:
    return steps[1][np.searchsorted(steps[0], x, side="right") - 1]


def then(before: Steps, after: Steps) -> Steps:
    """``after`` of ``before``."""
    return shortened(before[0], value_at(after, before[1]))


def _chain(spans: list[dict]) -> list[Steps]:
    """The functions of some spans, in order; a span without alerts in between leaves nothing quiet."""
    quietened: Steps = (np.zeros(1, np.int64), np.zeros(1, np.int64))
    out, before = [], None
    for row in spans:
        if before is not None and row["span"] != before + 1:
            out[-1] = then(out[-1], quietened)
        out.append((np.asarray(row["starts"], np.int64), np.asarray(row["values"], np.int64)))
        before = row["span"]
    return out


_FIELDS = {
    "starts": pa.list_(pa.int64()), "values": pa.list_(pa.int64()), "late": pa.bool_(),
    "block": pa.int64(), "span": pa.int64(), "given": pa.int64(), "_second": pa.int64(),
}


def _rowwise(step: Callable[[dict], list[tuple]], columns: list[str], keep: list[str]) -> Callable:
    """``step`` on each row, with the row's ``keep`` columns, as they are, ahead of what it gives."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            used = batch.drop_columns(["type"]).to_pylist()
            found = [(i, out) for i, row in enumerate(used) for out in step(row)]
            at = pa.array([i for i, _ in found], pa.int64())
            made = list(zip(*[out for _, out in found], strict=True)) or [[]] * len(columns)
            new = [pa.array(values, _FIELDS[c]) for values, c in zip(made, columns, strict=True)]
            yield pa.RecordBatch.from_arrays([*[batch.column(k).take(at) for k in keep], *new], names=[*keep, *columns])

    return run


def _functions(quiet: int, span: int):
    def step(row: dict) -> list[tuple]:
        starts, values = span_steps(np.sort(np.asarray(row["offsets"], np.int64)), quiet, span)
        return [(starts.tolist(), values.tolist())]

    return step


def _composed(row: dict) -> list[tuple]:
    """A block as one function, from its first span to the end of its last place."""
    spans = row["spans"]
    steps = _chain(spans)
    whole = steps[0]
    for more in steps[1:]:
        whole = then(whole, more)
    if (spans[-1]["span"] + 1) % BLOCK:
        whole = whole[0][:1], np.zeros(1, np.int64)
    return [(whole[0].tolist(), whole[1].tolist(), spans[0]["span"] % BLOCK > 0)]


def _given_to_blocks(row: dict) -> list[tuple]:
    """The quiet seconds that each block of a type is given."""
    out, given, before = [], 0, None
    for block in row["blocks"]:
        if before is not None and block["span"] != before + 1 or block["late"]:
            given = 0
        out.append((block["span"], given))
        given = int(value_at((np.asarray(block["starts"]), np.asarray(block["values"])), given))
        before = block["span"]
    return out


def _given_to_spans(row: dict) -> list[tuple]:
    out, given = [], row["given"]
    for span, steps in zip(row["spans"], _chain(row["spans"]), strict=True):
        out.append((span["span"], given))
        given = int(value_at(steps, given))
    return out


def _sent(quiet: int, span: int):
    def step(row: dict) -> list[tuple]:
        seconds = np.sort(np.asarray(row["offsets"], np.int64))
        sent, _ = first_after_quiet(seconds, row["given"], quiet)
        return [(row["span"] * span + second,) for second in sent]

    return step


def _ordered(*columns: str) -> Column:
    return F.array_sort(F.collect_list(F.struct(*columns)))


def sent_seconds(seconds: DataFrame, key: str, quiet: int) -> DataFrame:
    """The key and ``_second`` of what is sent, given the distinct (key, ``_second``) with alerts."""
    span = max(SPAN, 1 << (quiet - 1).bit_length())
    number, steps = "bigint", "starts array<bigint>, values array<bigint>"

    def mapped(df: DataFrame, step, columns: str, keep: list[str]) -> DataFrame:
        names = [c.split()[0] for c in columns.split(", ")]
        kept = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keep)
        return df.mapInArrow(_rowwise(step, names, keep), f"{kept}, {columns}")

    typed = seconds.select(F.col(key).alias("type"), "_second")
    place = F.floor(F.col("_second") / span)
    spans = storage.written(
        typed.groupBy("type", place.alias("span")).agg(
            F.collect_list((F.col("_second") - place * span).cast("int")).alias("offsets")
        ), "spans",
    )
    block = F.floor(F.col("span") / BLOCK).alias("block")
    functions = mapped(spans, _functions(quiet, span), steps, ["type", "span"])
    blocks = storage.written(
        functions.groupBy("type", block).agg(_ordered("span", "starts", "values").alias("spans")), "blocks"
    )
    whole = mapped(blocks, _composed, f"{steps}, late boolean", ["type", "block"])
    chains = whole.withColumnRenamed("block", "span").groupBy("type").agg(
        _ordered("span", "starts", "values", "late").alias("blocks")
    )
    to_blocks = mapped(chains, _given_to_blocks, f"block {number}, given {number}", ["type"])
    same = [F.col("a.type").eqNullSafe(F.col("b.type")) & (F.col(f"a.{x}") == F.col(f"b.{x}")) for x in ("block", "span")]
    met = blocks.alias("a").join(to_blocks.alias("b"), same[0]).select("a.type", "spans", "given")
    to_spans = mapped(met, _given_to_spans, f"span {number}, given {number}", ["type"])
    told = spans.alias("a").join(to_spans.alias("b"), same[1]).select("a.type", "a.span", "offsets", "given")
    sent = mapped(told, _sent(quiet, span), f"_second {number}", ["type"])
    return sent.select(F.col("type").alias(key), "_second")


def suppress_repeats(
    alerts: DataFrame,
    key: str,
    ts: str,
    tie: Sequence[str] = (),
    quiet_seconds: int = QUIET_SECONDS,
) -> DataFrame:
    """The alerts that are sent; of several in the same second, the first by ``ts`` and ``tie``.

    NULL is a type like others; alerts without a time are left out (``monitor.untimed``).
    """
    if quiet_seconds < 1:
        raise ValueError("the quiet period has to be a second at least")
    timed = alerts.withColumn("_second", epoch_seconds(alerts, ts)).where(F.col("_second").isNotNull())
    # At most one second in a quiet period is sent, so this is small for all but very many
    # types. Written out, its size is known, and the join below is planned by that size:
    # the alerts are shuffled only if the sent seconds are too many to be broadcast.
    sent = storage.written(sent_seconds(timed.select(key, "_second").distinct(), key, quiet_seconds), "sent")
    order = [ts, *tie]
    rest = [c for c in alerts.columns if c not in order and c != key]
    return (
        timed.join(
            sent.toDF("_key", "_at"),
            F.col(key).eqNullSafe(F.col("_key")) & (F.col("_second") == F.col("_at")),
        )
        .groupBy(key, "_second")
        .agg(F.min(F.struct(*order, *rest)).alias("_alert"))
        .select(key, *[F.col(f"_alert.`{c}`").alias(c) for c in (*order, *rest)])
        .select(*alerts.columns)
    )
