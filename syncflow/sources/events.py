"""JSON event streams: the Kafka reader and the tolerant decoder."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from syncflow.functions.types import cast_text

_CORRUPT = "_corrupt_record"

# Where a consumer starts. "group-offsets" needs no option: the
# checkpoint of the query holds the position, and earliest is its first start.
STARTUP_OFFSETS = {
    "earliest-offset": "earliest",
    "latest-offset": "latest",
    "group-offsets": "earliest",
}


def kafka_options(
    servers: str,
    topic: str,
    startup: str = "earliest-offset",
    group_id: str | None = None,
    max_offsets_per_trigger: int | None = None,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Reader options of a topic scan."""
    if startup not in STARTUP_OFFSETS:
        raise ValueError(f"unknown startup mode: {startup!r}")
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": STARTUP_OFFSETS[startup],
    }
    if group_id:
        options["kafka.group.id"] = group_id
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return {**options, **(extra or {})}


def read_kafka(spark: SparkSession, streaming: bool = True, **options) -> DataFrame:
    """Topic as a DataFrame with a ``value`` column (needs the Kafka package on the classpath)."""
    resolved = kafka_options(**options)
    if not streaming:
        # A bounded read ends at "latest", so it cannot start there.
        if resolved["startingOffsets"] == "latest":
            raise ValueError("a batch read cannot start at latest-offset")
        resolved.pop("maxOffsetsPerTrigger", None)
    reader = spark.readStream if streaming else spark.read
    return reader.format("kafka").options(**resolved).load()


def parse_json(
    df: DataFrame,
    fields: Sequence[str],
    value: str = "value",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Parse every payload once, into text fields plus ``raw`` and ``rejected``.

    A record is rejected when it is empty, malformed, or its root is not an object. An
    object that lacks fields, even all of them, is kept. ``inline`` makes the parse a
    generator of its own, so that filters on the outcome do not repeat the parse.
    """
    schema = T.StructType(
        [T.StructField(f, T.StringType()) for f in fields] + [T.StructField(_CORRUPT, T.StringType())]
    )
    text = F.col(value).cast("string")
    parsed = F.from_json(text, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    blank = F.col("raw").isNull() | ~F.col("raw").rlike(r"\S")
    return (
        df.select(*keep, text.alias("raw"), F.inline(F.array(parsed)))
        .withColumn("rejected", blank | F.col(_CORRUPT).isNotNull())
        .drop(_CORRUPT)
    )


def decode_json(
    df: DataFrame,
    fields: Mapping[str, object],
    value: str = "value",
    keep: Sequence[str] = (),
    timestamp_standard: str = "SQL",
) -> DataFrame:
    """Accepted records with typed fields: a missing or unusable field is NULL."""
    parsed = parse_json(df, list(fields), value, keep).where(~F.col("rejected"))
    typed = [cast_text(F.col(f"`{n}`"), t, timestamp_standard).alias(n) for n, t in fields.items()]
    return parsed.select(*keep, *typed)


def rejected_json(
    df: DataFrame, fields: Sequence[str], value: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """The complement of :func:`decode_json`: the raw text of the records that were dropped."""
    return parse_json(df, list(fields), value, keep).where("rejected").select(*keep, "raw")
