"""Reading a table in chunks of its key while it goes on changing.

A chunk is a range of the key. It is read between two places in the log, ``low`` and ``high``, and what is
read may hold any of the changes between them. So the changes of the chunk's keys from ``low`` to ``high``
replace its rows before the chunk is given out, which makes it the table as of ``high``; only changes
after ``high`` follow. Chunks are read independently of each other, each with places of its own, and no lock
is held.

Chunks have equal numbers of rows, however the key is distributed: their bounds are quantiles of the key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from syncflow.operators import changelog, ordered
from syncflow.sources.tables import SNAPSHOT_CHUNK_ROWS, chunk_count, jdbc_options

#: Ranges that one sketch is asked for at most: more are more scans than a database takes at a time.
MAX_RANGES = 10_000


def even_chunks(rows: DataFrame, key: str, chunk_rows: int = SNAPSHOT_CHUNK_ROWS) -> DataFrame:
    """chunk, first_key, last_key and rows of chunks that have ``chunk_rows`` rows each.

    Exact: rows are numbered along the key by ranges. Rows of one key stay together, so chunks are only
    larger where a key has several rows; rows without a key are in no chunk.
    """
    placed = ordered.numbered(ordered.in_order(rows.select(key).where(F.col(key).isNotNull()), key))
    keys = placed.groupBy(key).agg(F.min("_index").alias("_index"), F.count("*").alias("n"))
    chunk = F.call_function("div", F.col("_index"), F.lit(chunk_rows)).alias("chunk")
    return keys.groupBy(chunk).agg(
        F.min(key).alias("first_key"), F.max(key).alias("last_key"), F.sum("n").alias("rows")
    )


def quantile_bounds(rows: DataFrame, key: str, chunks: int) -> list:
    """Keys at which ``chunks`` ranges of about as many rows each begin, but for the first.

    From a quantile sketch that is merged from all partitions; it is off by a fiftieth of a chunk at most.
    """
    if not 1 <= chunks <= MAX_RANGES:
        raise ValueError(f"between 1 and {MAX_RANGES} chunks")
    cuts = [i / chunks for i in range(1, chunks)]
    if not cuts:
        return []
    found = rows.agg(F.percentile_approx(key, cuts, 50 * max(chunks, 200)).alias("ends")).first().ends
    return sorted(set(found or []))


def range_predicates(column: str, bounds: Sequence) -> list[str]:
    """A predicate for each range, every row in one of them; rows without a key are in the first."""
    if not bounds:
        return ["1 = 1"]
    text = [f"'{b}'" if not isinstance(b, (int, float)) else str(b) for b in bounds]
    inner = [f"{column} > {lo} AND {column} <= {hi}" for lo, hi in zip(text, text[1:], strict=False)]
    return [f"{column} <= {text[0]} OR {column} IS NULL", *inner, f"{column} > {text[-1]}"]


def read_jdbc_evenly(
    spark: SparkSession, url: str, table: str, column: str, partitions: int | None = None,
    chunk_rows: int = SNAPSHOT_CHUNK_ROWS, connection: dict | None = None,
) -> DataFrame:
    """A table by ranges of ``column`` with about as many rows each, one task and connection a range.

    The key alone is read first, for its quantiles.
    """
    keys = spark.read.format("jdbc").options(
        **jdbc_options(url, f"(SELECT {column} FROM {table}) AS keys", connection=connection)
    ).load()
    count = partitions or min(MAX_RANGES, chunk_count(keys.count(), chunk_rows))
    predicates = range_predicates(column, quantile_bounds(keys, column, count))
    return spark.read.jdbc(url, table, predicates=predicates, properties=dict(connection or {}))


def located(rows: DataFrame, chunks: DataFrame, key: str) -> DataFrame:
    """``rows`` with the columns of the chunk that their key falls into.

    ``chunks`` has first_key and any other columns, each beginning where the one before ends; keys before
    the first chunk are in the first one. Both sides are put into one order by key and the chunk is carried
    along, so nothing is compared in pairs, and a chunk or key may have any number of rows.
    """
    about = [c for c in chunks.columns if c not in ("first_key", "last_key", "rows")]
    first = chunks.agg(F.min("first_key")).scalar()
    lower = F.when(F.col("first_key") == first, F.lit(None)).otherwise(F.col("first_key"))
    starts = chunks.select(lower.alias(key), F.struct(*about).alias("_chunk"))
    missing = F.lit(None).cast(starts.schema["_chunk"].dataType).alias("_chunk")
    both = starts.withColumn("_is_row", F.lit(False)).unionByName(
        rows.select("*", missing, F.lit(True).alias("_is_row")), allowMissingColumns=True
    )
    placed = ordered.filled(ordered.in_order(both, key, "_is_row"), "_chunk")
    return placed.where("_is_row").select(*rows.columns, *[F.col("_chunk")[c].alias(c) for c in about])


def consistent_snapshot(
    read: DataFrame, chunks: DataFrame, changes: DataFrame, key: str, seq: str = "seq", kind: str = "kind",
) -> DataFrame:
    """One changelog out of a chunked read and the changes that went on meanwhile.

    ``read`` has the rows of all chunks, with their ``chunk``; ``chunks`` has chunk, first_key, low and high,
    places in the log like ``seq``; ``changes`` has key, ``seq``, ``kind`` and the columns of ``read``.
    ``phase`` is 0 for the rows of the snapshot, each chunk as of its high place, and 1 for later changes; by
    (phase, seq) the last row of a key counts. Changes up to ``low`` are in the chunk already and left out.
    """
    marks = chunks.select("chunk", F.col("low").alias("_low"))
    placed = located(changes, chunks.select("chunk", "first_key", "low", "high"), key)
    columns = [c for c in read.columns if c != "chunk"]
    as_read = read.join(marks, "chunk").select(*columns, F.col("_low").alias(seq), F.lit(changelog.UPSERT).alias(kind))
    during = placed.where((F.col(seq) > F.col("low")) & (F.col(seq) <= F.col("high"))).select(*columns, seq, kind)
    chunk_rows = changelog.latest_per_key(as_read.unionByName(during), [key], [seq])
    snapshot = chunk_rows.where(F.col(kind) != changelog.DELETE).withColumn("phase", F.lit(0))
    after = placed.where(F.col(seq) > F.col("high")).select(*columns, seq, kind).withColumn("phase", F.lit(1))
    return snapshot.unionByName(after)
