"""Helpers that several corpus operators share."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from syncflow import storage

_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone, the first of each name; safe with odd, repeated or clashing names."""
    rows, at = plain(df, *names)
    return rows.select(*[F.col(at[name]).alias(name) for name in names])


def plain(df: DataFrame, *names: str) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with columns c0, c1, ... and where the named ones are; ``toDF(*df.columns)`` undoes it."""
    held = [f"c{i}" for i in range(len(df.columns))]
    return df.toDF(*held), {name: held[df.columns.index(name)] for name in names}


def written(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and safe from lost executors.

    The shuffle files behind it are given up as soon as it is written.
    """
    spark = df.sparkSession
    path = storage.work_path(spark, name)
    before = spark.conf.get(_FREE_SHUFFLES)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        df.write.option("compression", codec).parquet(path)
    finally:
        spark.conf.set(_FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def digests(pieces: DataFrame, keys: list[str], order: list[str], separator: bytes) -> DataFrame:
    """The keys and ``digest``: SHA-256 (hex) of each key's ``body`` columns (binary) along ``order``.

    Bodies are joined by ``separator``. A digest can only be taken from front to back, so the pieces of a key
    pass through one task, but one after the other: sorted by Spark, and nothing but the state is held.
    """
    fields = [f for f in pieces.schema.fields if f.name in keys]
    kind = StructType([*sorted(fields, key=lambda f: keys.index(f.name)), StructField("digest", StringType())])

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state, schema = None, None, None
        for batch in batches:
            schema = pa.schema([*[batch.schema.field(k) for k in keys], ("digest", pa.string())])
            done = []
            named = zip(*[batch.column(k).to_pylist() for k in keys], strict=True)
            for key, body in zip(named, batch.column("body"), strict=True):
                if state is None or key != at:
                    if state is not None:
                        done.append((*at, state.hexdigest()))
                    at, state = key, hashlib.sha256()
                else:
                    state.update(separator)
                state.update(body.as_buffer() if body.is_valid else b"")
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, row, strict=True)) for row in done], schema)
        if state is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, (*at, state.hexdigest()), strict=True))], schema)

    dealt = pieces.select(*keys, *order, "body").repartition(*keys).sortWithinPartitions(*keys, *order)
    return dealt.select(*keys, "body").mapInArrow(take, kind)


def row_key(*columns: str):
    """A number for a row: equal rows have equal keys, and so equal results."""
    return F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in columns])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of an Arrow column as one byte array, and the offsets of each (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_binary(column.type):
        kind = pa.large_string() if pa.types.is_string(column.type) else pa.large_binary()
        column = column.cast(kind)
    column = column.fill_null("" if pa.types.is_large_string(column.type) else b"")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return held[ends[0] : ends[-1]], ends - ends[0]


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One hash of two 64-bit hashes; the order matters."""
    h = a * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h += b
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_BYTE_HASH = np.random.Generator(np.random.PCG64(11)).integers(0, 2**64, 256, np.uint64)
_BASE = 0x9E3779B97F4A7C15
_PIECE = 1 << 19


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & (2**64 - 1), np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _pieces(data: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cuts of about ``_PIECE`` bytes that fall between words; ``starts`` are text starts."""
    at = 0
    while at < len(data):
        end = min(at + _PIECE, len(data))
        while end < len(data):
            window = _SPACE[data[end : end + 4096]]
            nearest = starts[np.searchsorted(starts, end) :][:1]
            if window.any() or len(nearest) and nearest[0] < end + 4096:
                space = end + int(window.argmax()) if window.any() else len(data)
                end = min(space, int(nearest[0]) if len(nearest) else len(data))
                break
            end = min(end + 4096, len(data))
        end = max(end, at + 1)
        yield at, end
        at = end


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, A-Z in lower case, and the number of words in each text.

    Words are runs of bytes other than ASCII white space. Texts are worked on in pieces cut
    between words, so memory does not depend on their length.
    """
    hashes, firsts = [], []
    for lo, hi in _pieces(data, offsets[:-1]):
        part = _LOWER[data[lo:hi]]
        inside = np.concatenate(([False], ~_SPACE[part], [False]))
        cut = offsets[(offsets > lo) & (offsets < hi)] - lo
        split = np.zeros(hi - lo + 1, bool)
        split[cut] = True
        begins = np.nonzero(inside[1:] & (~inside[:-1] | split))[0]
        ends = np.nonzero(inside[:-1] & (~inside[1:] | split))[0]
        up, down = _powers(_BASE, hi - lo), _powers(pow(_BASE, -1, 2**64), hi - lo)
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(_BYTE_HASH[part] * up, out=sums[1:])
        word = (sums[ends] - sums[begins]) * down[begins]
        hashes.append(mix(word, (ends - begins).astype(np.uint64)))
        firsts.append(begins + lo)
    words = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    at = np.concatenate(firsts) if firsts else np.zeros(0, np.int64)
    return words, np.diff(np.searchsorted(at, offsets))


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of ``edges`` (a, b).

    Alternating large and small stars. Every round is one table in the shared folder; edges
    never outnumber the given ones, and nothing but a count goes to the driver.
    """
    both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    held = written(both.where("a <> b").distinct(), "edges")
    before = None
    while True:
        near = held.union(held.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (
            near.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a <> b").distinct()
        )
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        ).select("e.a", "e.b").where("a <> b").distinct()
        held = written(small, "edges")
        now = held.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = held.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return held.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
