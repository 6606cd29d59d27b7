"""Alert suppression on a stream, in event time.

An alert is only decided on when no earlier one of its type can come any more, which is when the watermark
has passed it. Until then it waits in the type's state: the first alert of each second, so as many
rows as the delay and a micro-batch have seconds at most, less those that an alert already sent keeps quiet.
They are held as an Arrow table along time, without the type, which is the same in all. A timer
decides what waits when the watermark passes it, with or without new alerts, and drops the state of a type
whose quiet period is over.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from syncflow.functions.times import epoch_seconds, interval_text
from syncflow.operators.suppression import QUIET_SECONDS, first_after_quiet

_LONG_AGO = -(2**62)


#: New rows that are put with those waiting at a time, at least; else as many as there are waiting.
MERGED_ROWS = 50_000


def _packed(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(rows)
    return sink.getvalue().to_pybytes()


def _first_of_seconds(parts: list[pa.Table], order: list[str]) -> pa.Table:
    """The rows of all parts along time, of each second only the first."""
    rows = pa.concat_tables(parts, promote_options="permissive").combine_chunks()
    at = pc.sort_indices(rows, sort_keys=[(c, "ascending") for c in ("_second", *order)])
    second = rows["_second"].combine_chunks().take(at).to_numpy()
    return rows.take(at.filter(pa.array(np.append(True, second[1:] != second[:-1])))).combine_chunks()


def _keeper(columns: list[str], key_column: str, order: list[str], quiet: int):
    held = [c for c in (*columns, "_second") if c != key_column]
    order = [c for c in order if c != key_column]

    def keep(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        ready, waiting, new = _LONG_AGO, None, []
        if state.exists:
            ready, packed = state.get
            waiting = pa.ipc.open_stream(packed).read_all().select(held) if packed else None
        # Only the first alert of a second can be sent, so that is all that is held.
        for rows in batches:
            rows = rows.loc[rows["_second"] >= ready, held]
            if len(rows):
                new.append(pa.Table.from_pandas(rows, preserve_index=False).replace_schema_metadata(None))
            if sum(map(len, new)) >= max(MERGED_ROWS, 0 if waiting is None else len(waiting)):
                waiting, new = _first_of_seconds([*([] if waiting is None else [waiting]), *new], order), []
        if new:
            waiting, new = _first_of_seconds([*([] if waiting is None else [waiting]), *new], order), []
        watermark = state.getCurrentWatermarkMs()
        if waiting is not None:
            seconds = waiting["_second"].to_numpy()
            end = int(np.searchsorted(seconds, watermark // 1000))
            sent, ready = first_after_quiet(seconds[:end], ready, quiet)
            if sent:
                due = waiting.take(np.searchsorted(seconds, sent)).to_pandas()
                due[key_column] = [key[0]] * len(due)
                yield due[columns]
            waiting = waiting.slice(max(end, int(np.searchsorted(seconds, ready))))
        if waiting is not None and len(waiting):
            state.update((ready, _packed(waiting)))
            timer = (waiting["_second"][0].as_py() + 1) * 1000 - 1
        elif ready * 1000 > watermark:
            state.update((ready, None))
            timer = ready * 1000
        else:
            if state.exists:
                state.remove()
            return
        state.setTimeoutTimestamp(max(timer, watermark + 1))

    return keep


def suppress_repeats_stream(
    alerts: DataFrame, key: str, ts: str, tie: tuple[str, ...] = (), quiet_seconds: int = QUIET_SECONDS,
    delay: str = "0s",
) -> DataFrame:
    """Alerts that are sent, for a stream whose alerts come at most ``delay`` late, in any order.

    The same as ``suppress_repeats`` gives for the alerts before the watermark, which stays ``delay``
    behind the latest alert; alerts that come later than that are dropped, as the stream's progress
    counts (``numRowsDroppedByWatermark``).
    """
    if quiet_seconds < 1:
        raise ValueError("the quiet period has to be a second at least")
    schema = T.StructType([alerts.schema[c] for c in alerts.columns])
    timed = alerts.withColumn("_second", epoch_seconds(alerts, ts)).where(F.col("_second").isNotNull())
    return (
        timed.withColumn("_event", F.timestamp_seconds("_second"))
        .withWatermark("_event", interval_text(delay))
        .groupBy(F.col(key))
        .applyInPandasWithState(
            _keeper(alerts.columns, key, [ts, *tie], quiet_seconds),
            schema,
            "ready bigint, waiting binary",
            "append",
            GroupStateTimeout.EventTimeTimeout,
        )
    )
