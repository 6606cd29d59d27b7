"""File, topic and debug outputs, and writing one result to several of them."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from syncflow.functions.times import interval_text


def write_json_files(df: DataFrame, path: str, mode: str = "append", **options) -> None:
    """Line-delimited JSON; NULL fields are written, so every line has every field."""
    df.write.mode(mode).option("ignoreNullFields", "false").options(**options).json(path)


def encode_for_kafka(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``key`` and ``value`` of topic records: the row, and its key columns, as JSON."""
    plain = {"ignoreNullFields": "false"}
    value = F.to_json(F.struct(*df.columns), plain).alias("value")
    if not keys:
        return df.select(value)
    return df.select(F.to_json(F.struct(*keys), plain).alias("key"), value)


def numbered_json_files(path: str, **options) -> Callable[[DataFrame, int], None]:
    """Writer for micro-batches whose repetition replaces what it wrote before."""
    def write(batch: DataFrame, number: int) -> None:
        write_json_files(batch, f"{path}/batch={number}", "overwrite", **options)

    return write


def write_nowhere(df: DataFrame) -> None:
    """Run the whole query and discard the rows."""
    df.write.format("noop").mode("overwrite").save()


def print_rows(df: DataFrame, prefix: str = "", show: Callable[[str], object] = print) -> None:
    """Every row as a line of JSON on the standard output of the task that has it.

    Executors print their own rows, as a debugging sink on a cluster does; nothing passes the driver.
    ``show`` can put something else in the place of ``print``; it is sent to the tasks.
    """
    lines = df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("line"))

    def each(rows: Iterator[Row]) -> None:
        for row in rows:
            show(prefix + row["line"])

    lines.foreachPartition(each)


def rolling_options(
    file_bytes: int, row_bytes: int, rollover: str = "1 minute"
) -> tuple[dict[str, str], dict[str, str]]:
    """Writer options and trigger that stand for a rolling-file policy.

    Spark closes a file by row count, hence the size is converted with an average row
    size; the rollover interval becomes the trigger interval.
    """
    rows = max(1, file_bytes // max(1, row_bytes))
    return {"maxRecordsPerFile": str(rows)}, {"processingTime": interval_text(rollover)}


def flush_options(
    interval: str, max_offsets: int | None = None, max_files: int | None = None, max_bytes: int | None = None
) -> tuple[dict[str, str], dict[str, str]]:
    """Reader options and trigger that bound a micro-batch by rows, files or bytes and by time."""
    options = {}
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if max_files:
        options["maxFilesPerTrigger"] = str(max_files)
    if max_bytes:
        options["maxBytesPerTrigger"] = str(max_bytes)
    return options, {"processingTime": interval_text(interval)}


def fan_out(df: DataFrame, writers: Sequence[Callable[[DataFrame], object]]) -> list:
    """Hand one result to several writers while computing it once."""
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return [write(held) for write in writers]
    finally:
        held.unpersist()


def fan_out_committed(
    df: DataFrame, targets: Mapping[str, Callable[[DataFrame], DataFrame]], path: str
) -> DataStreamWriter:
    """Each micro-batch to several targets below ``path``, visible in all of them or in none.

    ``targets`` gives what each one takes of a batch. Every target's rows are written to a folder of the batch,
    replacing what a broken attempt left there, and then one row with the batch's number is added to the
    commits. A reader (``read_committed``) takes only batches that are committed, so a crash between two
    writers shows in no target, and the batch that is run again shows once.
    """
    def write(batch: DataFrame, number: int) -> None:
        def to(name: str, part: Callable[[DataFrame], DataFrame]):
            return lambda rows: part(rows).write.mode("overwrite").parquet(f"{path}/{name}/batch={number}")

        fan_out(batch, [to(name, part) for name, part in targets.items()])
        commit = batch.sparkSession.range(number, number + 1).select(F.col("id").alias("committed"))
        commit.write.mode("overwrite").parquet(f"{path}/_commits/batch={number}")

    return df.writeStream.foreachBatch(write)


def read_committed(spark: SparkSession, path: str, target: str, schema: T.StructType) -> DataFrame:
    """What committed batches wrote to a target of ``fan_out_committed``."""
    rows = spark.read.schema(T.StructType([*schema, T.StructField("batch", T.LongType())])).parquet(f"{path}/{target}")
    commits = spark.read.schema("committed long").parquet(f"{path}/_commits/*")
    return rows.join(commits, F.col("batch") == F.col("committed"), "left_semi").drop("batch")


def fan_out_stream(
    df: DataFrame, writers: Sequence[Callable[[DataFrame, int], object]]
) -> DataStreamWriter:
    """Each micro-batch to several writers, which get the batch number to be repeatable."""
    def write(batch: DataFrame, number: int) -> None:
        fan_out(batch, [lambda rows, w=w: w(rows, number) for w in writers])

    return df.writeStream.foreachBatch(write)
