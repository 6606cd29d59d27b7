"""Blocks of documents, and counting their hashes across the corpus.

Documents are laid into blocks of some megabytes, one row each, in the shared folder. A block sends
every distinct hash it holds once, packed by bucket, so that a hash which a third of all documents
hold arrives once a block; a bucket answers with one value a hash, in the order they were sent. The
block computes its hashes again from its text to know what the answers are for, so neither positions
nor texts travel with them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

BLOCK_BYTES = 4 << 20
BUCKET_KEYS = 2_000_000  # hashes in a bucket, about: 16 MB, and as much again to sort them
_SCHEMA = "block long, ids array<long>, copies array<int>, ends array<long>, data binary"


_LAID = pa.schema([
    ("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("copies", pa.list_(pa.int32())),
    ("ends", pa.list_(pa.int64())), ("data", pa.binary()),
])
_SENT = pa.schema([
    ("bucket", pa.int32()), ("block", pa.int64()), ("n", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary()),
])


def _laying(block_bytes: int) -> Callable:
    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, nth = TaskContext.get().partitionId() << 32, 0
        pack = zstandard.ZstdCompressor(level=3)
        ids: list = []
        copies: list[int] = []
        texts: list[bytes] = []
        size, last = 0, object()

        def block() -> pa.RecordBatch:
            ends = np.cumsum([len(t) for t in texts])
            return pa.RecordBatch.from_pydict(
                {"block": [first + nth], "ids": [ids], "copies": [copies], "ends": [ends.tolist()],
                 "data": [pack.compress(b"".join(texts))]}, _LAID,
            )

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if (doc_id, text) == last:
                    copies[-1] += 1  # the same row again
                    continue
                last = (doc_id, text)
                text = (text or "").encode()
                if texts and size + len(text) > block_bytes:
                    yield block()
                    nth, ids, copies, texts, size = nth + 1, [], [], [], 0
                ids.append(doc_id)
                copies.append(1)
                texts.append(text)
                size += len(text)
        if texts:
            yield block()

    return lay


def lay_out(sorted_docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Blocks of ``sorted_docs`` (doc_id, text), each within a partition and in its order."""
    return written(sorted_docs.select("doc_id", "text").mapInArrow(_laying(block_bytes), _SCHEMA), "blocks")


def opened(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a block and the offsets of its documents."""
    data = zstandard.ZstdDecompressor().decompress(row["data"])
    return np.frombuffer(data, np.uint8), np.array([0, *row["ends"]], np.int64)


def _by_bucket(spread: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The order that brings sorted keys together by bucket, and the buckets' bounds in it."""
    bucket = ((spread >> np.uint64(20)) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers byte plane by byte plane, so that those with leading zeros compress."""
    return numbers.view(np.uint8).reshape(len(numbers), -1).T.tobytes()


def _unplaned(data: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.frombuffer(data, np.uint8).reshape(width, -1).T.copy().view(kind).ravel()


def _sending(hashes: Callable, buckets: int) -> Callable:
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, counts, spread = hashes(row)
                order, bounds = _by_bucket(spread, buckets)
                keys, counts = keys[order], np.minimum(counts[order], 255).astype(np.uint8)
                rows: dict[str, list] = {"bucket": [], "block": [], "n": [], "keys": [], "counts": []}
                for bucket in np.nonzero(np.diff(bounds))[0].tolist():
                    lo, hi = bounds[bucket], bounds[bucket + 1]
                    rows["bucket"].append(bucket)
                    rows["block"].append(row["block"])
                    rows["n"].append(int(hi - lo))
                    rows["keys"].append(_planes(np.diff(keys[lo:hi], prepend=np.uint64(0))))
                    rows["counts"].append(counts[lo:hi].tobytes())
                yield pa.RecordBatch.from_pydict(rows, _SENT)

    return send


def _answering(kind: str) -> Callable:
    def answer(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["block"])
        keys = np.concatenate([np.cumsum(_unplaned(r["keys"], np.uint64), dtype=np.uint64) for r in rows])
        order = np.argsort(keys, kind="stable")
        ranked = keys[order]
        fresh = np.concatenate(([True], ranked[1:] != ranked[:-1]))
        if kind == "first":
            values = np.empty(len(keys), bool)
            values[order] = fresh
        else:
            counts = np.concatenate([np.frombuffer(r["counts"], np.uint8) for r in rows])
            starts = np.nonzero(fresh)[0]
            totals = np.add.reduceat(counts[order].astype(np.int64), starts)
            held = np.minimum(totals, 65535) if kind == "held" else totals > 1
            values = np.empty(len(keys), np.uint16 if kind == "held" else bool)
            values[order] = np.repeat(held, np.diff(np.append(starts, len(keys))))
        bounds = np.cumsum([0, *(r["n"] for r in rows)])
        parts = [values[lo:hi] for lo, hi in zip(bounds[:-1], bounds[1:], strict=True)]
        packed = [_planes(p) if kind == "held" else np.packbits(p).tobytes() for p in parts]
        return pa.table({
            "block": pa.array([r["block"] for r in rows], pa.int64()),
            "bucket": pa.array([r["bucket"] for r in rows], pa.int32()),
            "told": pa.array(packed, pa.binary()),
        })

    return answer


def ask(blocks: DataFrame, hashes: Callable, keys: float, kind: str) -> DataFrame:
    """What the corpus holds of the hashes of each block: (block, <kind>, <kind>_buckets).

    ``hashes`` maps a block's row to its sorted distinct hashes, the number of places that hold each,
    and the numbers that choose their buckets; ``keys`` is about how many there are in all. Kinds:
    ``held``, the number of places in the corpus (up to 65,535); ``shared``, whether there are two or
    more; ``first``, whether no block before this one holds the hash.
    """
    buckets = int(keys // BUCKET_KEYS) + 1
    sent = blocks.mapInArrow(_sending(hashes, buckets), "bucket int, block long, n long, keys binary, counts binary")
    answers = sent.groupBy("bucket").applyInArrow(_answering(kind), "block long, bucket int, told binary")
    told = written(answers, "answers").groupBy("block").agg(F.collect_list(F.struct("bucket", "told")).alias(kind))
    return told.withColumn(f"{kind}_buckets", F.lit(buckets))


def told(row: dict, kind: str, keys: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """The answers for a block's sorted keys."""
    out = np.zeros(len(keys), np.int64)
    if row[kind]:
        order, bounds = _by_bucket(spread, row[f"{kind}_buckets"])
        for answer in row[kind]:
            where = order[bounds[answer["bucket"]] : bounds[answer["bucket"] + 1]]
            out[where] = (
                _unplaned(answer["told"], np.uint16) if kind == "held"
                else np.unpackbits(np.frombuffer(answer["told"], np.uint8), count=len(where))
            )
    return out
