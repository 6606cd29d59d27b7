"""Declarative flows: source, format, watermark, transform and sink in one description.

``build`` turns a description into a DataFrame and ``run`` writes it, the same way for a
table and for a stream. Expressions are Spark SQL text; an unknown column fails when the
flow is built, through Spark's own analysis.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, fields

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from syncflow.functions import times
from syncflow.functions.types import resolve_type
from syncflow.operators import changelog, transform
from syncflow.sinks.append import append_by_day
from syncflow.sinks.keyed import KeyedTable
from syncflow.sinks.outputs import encode_for_kafka, flush_options, print_rows, rolling_options, write_json_files
from syncflow.sources import cdc, datagen, events, tables
from syncflow.streaming import run as streams
from syncflow.streaming.windows import as_event_time, tumbling, window_counts, with_event_time_limit

SOURCE_KINDS = ("kafka", "cdc", "jdbc", "parquet", "json", "text", "datagen", "frame")
SINK_MODELS = ("append", "keyed", "json", "kafka", "print", "discard")


@dataclass(frozen=True)
class Source:
    """``fields`` declares the columns; ``options`` go to the reader of ``kind``.

    With ``encoded`` the reader gives JSON text in ``value``, as a topic does. ``cdc`` is
    such a source whose records are change envelopes; ``startup`` and ``start`` say from which
    change on they count. With ``startup`` initial, ``snapshot`` is the table as it was before the
    changes, in columns of the same names, unless ``snapshot_mode`` leaves it out. ``decimals`` says
    how change envelopes carry decimals (``sources.cdc.DECIMAL_MODES``). ``flush``
    bounds the micro-batches of a stream, as ``outputs.flush_options`` has it.
    """

    kind: str
    fields: Mapping[str, object] = field(default_factory=dict)
    options: Mapping[str, object] = field(default_factory=dict)
    encoded: bool | None = None
    timestamp_format: str = "SQL"
    zone: str | None = None
    startup: str = "initial"
    start: Mapping[str, object] = field(default_factory=dict)
    snapshot: Source | None = None
    snapshot_mode: str = "initial"
    decimals: str = "string"
    lookback_hours: int | None = None
    lookback_column: str = "update_time"
    flush: Mapping[str, object] = field(default_factory=dict)


@dataclass(frozen=True)
class Watermark:
    column: str
    delay: str = "5 seconds"


@dataclass(frozen=True)
class Window:
    column: str
    size: str
    counts_by: Sequence[str] | None = None


@dataclass(frozen=True)
class Transform:
    """Applied in this order: computed columns, filter, clean, mapping, window."""

    computed: Mapping[str, str] = field(default_factory=dict)
    filter: str | None = None
    clean: Mapping[str, str] = field(default_factory=dict)
    mapping: Mapping[str, str] = field(default_factory=dict)
    window: Window | None = None


@dataclass(frozen=True)
class Sink:
    """``day_from`` is the time column the day partition comes from, named as it is in the
    source; ``event_millis`` the epoch-millisecond column where there is no time column.
    ``rolling`` bounds the files of a JSON sink, as ``outputs.rolling_options`` has it.
    ``buckets`` of a keyed target has no default: choose it by size, some hundred MB to a few GB a
    bucket."""

    model: str
    path: str | None = None
    label_prefix: str = "load"
    columns: Sequence[str] | Mapping[str, object] | None = None
    not_null: Sequence[str] = ()
    keys: Sequence[str] = ()
    order: Sequence[str] = ()
    buckets: int | None = None
    enable_delete: bool = True
    day_column: str | None = "partition_day"
    day_from: str | None = None
    event_millis: str | None = None
    day_as_text: bool = False
    options: Mapping[str, str] = field(default_factory=dict)
    rolling: Mapping[str, object] = field(default_factory=dict)


@dataclass(frozen=True)
class SyncSpec:
    name: str
    source: Source
    sink: Sink
    transform: Transform = field(default_factory=Transform)
    watermark: Watermark | None = None

    @classmethod
    def from_dict(cls, given: Mapping) -> SyncSpec:
        """From nested mappings, e.g. a parsed YAML file. Unknown entries are an error."""
        return _make(cls, given)


# Columns that changes carry to a keyed target: the operation, and the place in the log.
_KIND, _SEQ = "_op_kind", "_op_seq"

_NESTED = {
    "source": Source, "snapshot": Source, "sink": Sink, "transform": Transform, "watermark": Watermark, "window": Window,
}


def _make(cls, given: Mapping):
    unknown = set(given) - {f.name for f in fields(cls)}
    if unknown:
        raise ValueError(f"unknown entries for {cls.__name__}: {sorted(unknown)}")
    return cls(**{
        k: _make(_NESTED[k], v) if k in _NESTED and isinstance(v, Mapping) else v
        for k, v in given.items() if v is not None
    })


def _scan(spark: SparkSession, src: Source, streaming: bool, frame: DataFrame | None) -> DataFrame:
    if src.kind not in SOURCE_KINDS:
        raise ValueError(f"unknown source kind: {src.kind!r}")
    if frame is not None:
        return frame
    options = dict(src.options)
    if streaming and src.flush:
        options |= flush_options(**src.flush)[0]
    reader = spark.readStream if streaming else spark.read
    if src.kind == "kafka" or src.kind == "cdc" and "path" not in options:
        return events.read_kafka(spark, streaming, **options)
    if src.kind == "cdc":
        path = options.pop("path")
        return reader.options(**options).text(path)
    if src.kind == "jdbc":
        if src.lookback_hours and "where" not in options:
            options["where"] = tables.jdbc_lookback_where(src.lookback_column, src.lookback_hours)
        return tables.read_jdbc(spark, **options)
    if src.kind == "datagen":
        return datagen.read_generated(spark, src.fields, **options)
    path = options.pop("path")
    if src.kind == "text":
        return reader.options(**options).text(path)
    if src.fields:
        types = [f"`{n}` {_ddl(t)}" for n, t in src.fields.items()]
        reader = reader.schema(", ".join(types))
    return reader.options(**options).format(src.kind).load(path)


def _ddl(kind) -> str:
    return resolve_type(kind).simpleString()


def build(
    spark: SparkSession,
    spec: SyncSpec,
    streaming: bool = False,
    frame: DataFrame | None = None,
    as_of=None,
    fallback_day=None,
    snapshot_only: bool = False,
    observation: Observation | str | None = None,
) -> DataFrame:
    """The flow as a DataFrame, up to the sink.

    ``observation`` counts the rows that the not-null rule sees and drops (``transform.kept_where``).

    ``frame`` replaces the scan. ``as_of`` and ``fallback_day`` stand in for the clock. A table
    read includes the snapshot of a change source; of a stream it comes apart, by
    ``snapshot_only``.
    """
    src, step, sink = spec.source, spec.transform, spec.sink
    is_cdc = src.kind == "cdc"
    if snapshot_only:
        df = _snapshot(spark, spec)
    else:
        df = _scan(spark, src, streaming, frame)
        if is_cdc:
            df = changelog.decode_changes(
                df, src.fields, timestamp_standard=src.timestamp_format, kind=_KIND, seq=_SEQ, decimals=src.decimals
            )
            by_clock = {"ts": f"{_SEQ}.ts_ms"} if src.startup == "timestamp" else {}
            df = cdc.start_changes(df, src.startup, seq=_SEQ, **{**by_clock, **src.start})
            if not streaming and _has_snapshot(src):
                df = _snapshot(spark, spec).unionByName(df)
        elif src.encoded or src.encoded is None and src.kind in ("kafka", "text"):
            df = events.decode_json(df, src.fields, timestamp_standard=src.timestamp_format)
    if src.zone:
        zoneless = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp_ntz"]
        df = df.withColumns({c: times.to_utc(F.col(c), src.zone) for c in zoneless})
    if src.lookback_hours and src.kind != "jdbc":
        df = tables.incremental_slice(df, src.lookback_column, as_of, src.lookback_hours)

    df = transform.compute_columns(df, step.computed)
    if sink.day_column and sink.event_millis:
        day = times.event_day_from_millis(F.col(sink.event_millis), fallback_day)
        df = df.withColumn(sink.day_column, times.day_text(day) if sink.day_as_text else day)
    elif sink.day_column and sink.day_from:
        df = transform.place_by_day(
            df, F.col(sink.day_from), sink.day_column, fallback_day, sink.day_as_text
        )
    if spec.watermark:
        df = as_event_time(df, spec.watermark.column)
        df = with_event_time_limit(df, spec.watermark.column, spec.watermark.delay)
    if is_cdc and step.filter is not None:
        df = changelog.retract_unmatched(df, step.filter, _KIND)
    else:
        df = transform.filter_rows(df, step.filter)
    df = transform.clean_columns(df, step.clean)
    if step.mapping:
        # What the sink needs beside the mapped columns goes along unchanged.
        extra = [sink.day_column, _KIND, _SEQ]
        along = {c: c for c in extra if c in df.columns and c not in step.mapping}
        df = transform.map_columns(df, {**along, **step.mapping})
    if step.window and step.window.counts_by is not None:
        df = window_counts(df, step.window.column, step.window.size, step.window.counts_by)
    elif step.window:
        df = tumbling(df, step.window.column, step.window.size)
    if sink.columns:
        # A keyed target also needs the kind of change and its place in the order.
        along = [c for c in (_KIND, *(sink.order or [_SEQ])) if sink.model == "keyed"]
        listed = list(sink.columns)
        extra = [c for c in along if c in df.columns and c not in listed]
        columns = sink.columns
        if isinstance(columns, Mapping):
            columns = {**columns, **{c: df.schema[c].dataType for c in extra}}
        else:
            columns = [*listed, *extra]
        df = transform.sink_columns(df, columns)
    if is_cdc and sink.not_null and sink.keys:
        return changelog.drop_incomplete(df, sink.not_null, sink.keys, _KIND, observation)
    return transform.enforce_not_null(df, sink.not_null, observation) if sink.not_null else df


def _has_snapshot(src: Source) -> bool:
    return src.snapshot is not None and cdc.includes_snapshot(src.startup, src.snapshot_mode)


def _snapshot(spark: SparkSession, spec: SyncSpec) -> DataFrame:
    """The table before the changes, as upserts that any change comes after."""
    fields = {n: resolve_type(t) for n, t in spec.source.fields.items()}
    rows = _scan(spark, spec.source.snapshot, False, None)
    no_changes = spark.createDataFrame([], "value string")
    order = changelog.decode_changes(no_changes, spec.source.fields, kind=_KIND, seq=_SEQ).schema[_SEQ].dataType
    # NULL comes before every place in the log.
    first = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in order])
    return rows.select(
        F.lit(changelog.UPSERT).alias(_KIND), first.alias(_SEQ),
        *[F.col(f"`{n}`").cast(t).alias(n) for n, t in fields.items()],
    )


def keyed_table(spark: SparkSession, spec: SyncSpec) -> KeyedTable:
    """The mirror a flow keeps."""
    sink = spec.sink
    if not sink.buckets:
        raise ValueError("a keyed sink needs the number of its buckets")
    order = sink.order or [_SEQ]
    return KeyedTable(spark, sink.path, sink.keys, order, sink.buckets, _KIND, spec.name)


def run(
    spark: SparkSession,
    spec: SyncSpec,
    mode: str = "batch",
    label: str | None = None,
    checkpoint: str | None = None,
    interval: str | None = None,
    frame: DataFrame | None = None,
    as_of=None,
    fallback_day=None,
    counts: dict[str, int] | None = None,
):
    """Write the flow: ``batch`` once, under ``label``; ``stream`` until stopped, or until the
    input is used up when no ``interval`` is given. A stream gives its query, a batch whether
    the load was new (where the target keeps labels).

    How many rows the not-null rule saw and dropped goes into ``counts``, for a batch; a stream has it in
    its progress, together with the rows that came too late: ``streaming.run.flow_counts`` and ``FlowCounter``.
    """
    sink = spec.sink
    if sink.model not in SINK_MODELS:
        raise ValueError(f"unknown sink model: {sink.model!r}")
    if mode not in ("batch", "stream"):
        raise ValueError(f"unknown mode: {mode!r}")
    streaming = mode == "stream"
    seen = spec.name if streaming else Observation(spec.name) if counts is not None else None
    df = build(spark, spec, streaming, frame, as_of, fallback_day, observation=seen)
    if streaming:
        if _has_snapshot(spec.source):
            if sink.model != "keyed":
                raise ValueError("a stream with a snapshot needs a keyed sink")
            # Under a label of its own: it goes in once, however often the stream is started.
            first = build(spark, spec, False, None, as_of, fallback_day, snapshot_only=True)
            keyed_table(spark, spec).upsert(first, f"{sink.label_prefix}-snapshot", sink.enable_delete)
        bounds = spec.source.flush.get("interval") or sink.rolling.get("rollover")
        return _run_stream(spark, spec, df, checkpoint, interval or bounds)
    out = _run_batch(spark, spec, df, label)
    if counts is not None and sink.not_null and out is not False:
        counts.update(seen.get)
    return out


def _run_batch(spark, spec: SyncSpec, df: DataFrame, label: str | None):
    sink = spec.sink
    full_label = f"{sink.label_prefix}-{label}"
    if sink.model in ("append", "keyed") and label is None:
        raise ValueError("a batch load needs a label")
    if sink.model == "append":
        return append_by_day(df, sink.path, full_label, sink.day_column, owner=spec.name)
    if sink.model == "keyed":
        return keyed_table(spark, spec).upsert(df, full_label, sink.enable_delete)
    if sink.model == "json":
        return write_json_files(df, sink.path, **_file_options(sink))
    if sink.model == "kafka":
        encoded = encode_for_kafka(df, sink.keys)
        return encoded.write.format("kafka").options(**sink.options).save()
    if sink.model == "print":
        return print_rows(df)
    return df.write.format("noop").mode("overwrite").save()


def _file_options(sink: Sink) -> dict[str, str]:
    return {**(rolling_options(**sink.rolling)[0] if sink.rolling else {}), **sink.options}


def _run_stream(spark, spec: SyncSpec, df: DataFrame, checkpoint: str, interval: str | None):
    sink = spec.sink
    if sink.model == "append":
        return streams.stream_to_day_table(
            df, sink.path, checkpoint, sink.label_prefix, sink.day_column, interval, spec.name, spec.name
        )
    if sink.model == "keyed":
        return streams.stream_to_keyed_table(
            df, keyed_table(spark, spec), checkpoint, sink.label_prefix, sink.enable_delete, interval,
            spec.name,
        )
    if sink.model == "json":
        return streams.stream_to_day_files(
            df, sink.path, checkpoint, None, interval, "json", _file_options(sink), spec.name
        )
    if sink.model == "kafka":
        df = encode_for_kafka(df, sink.keys)
    if sink.model == "print":
        writer = df.writeStream.foreachBatch(lambda batch, number: print_rows(batch))
    else:
        formats = {"kafka": "kafka", "discard": "noop"}
        writer = df.writeStream.format(formats[sink.model]).options(**sink.options)
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(**streams.trigger_of(interval)).queryName(spec.name).start()
