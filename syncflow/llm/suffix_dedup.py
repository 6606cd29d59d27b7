"""Suffix-array dedup: repeated strings found by a difference-cover sort of suffixes.

Two suffixes that agree on their first ``length`` bytes agree, within ``v`` bytes, at a place that the
difference cover D modulo v samples in both of them. So:

1. the suffixes at sampled places are sorted by their leading tuple of ``length - v + 1`` bytes and
   named by it; names that occur once are discarded;
2. since the order is wanted to a depth of ``length`` only, one recursion is enough: every suffix, sampled or
   not, within reach of a name that is left is sorted by its ``length``-byte prefix, and adjacent
   prefixes are compared. The first suffix of each run of equals stays, the others mark their bytes.

Sorting is done bucket by bucket on 64-bit fingerprints of the tuples and prefixes, of which each block
of documents sends the distinct ones (see ``blocks``): the order of the buckets is not the alphabet's,
but equal prefixes are neighbours, which is all that is used. The bucket is chosen by other bits than
the fingerprint. Copies of whole texts are settled ahead: their first document has it all.

Results for odd input: a NULL text is empty; a NULL doc_id is before all others; rows that are the same
document again get the same result each; rows of one doc_id with different texts count as documents in
the order of their texts; texts shorter than ``length`` lose nothing; an empty table gives an empty
result. Texts are whole, in blocks of some megabytes; a longer text is a block of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks
from .common import mix, pick, written

LENGTH = 100
# Perfect difference sets: every difference modulo v is that of two members. Fixed values.
COVERS = {
    7: (0, 1, 3), 13: (0, 1, 3, 9), 31: (0, 1, 3, 8, 12, 18), 57: (0, 1, 3, 13, 32, 36, 43, 52),
}
_PIECE = 1 << 16
_PARTITION_BYTES = 48 << 20
_SCHEMA = "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary"


def cover_for(length: int) -> int:
    """The modulus to use: tuples keep two fifths of the length, and 8 bytes at least."""
    return max((v for v in COVERS if v <= min(length * 3 // 5, length - 7)), default=0)


def _fingerprints(data: np.ndarray, n: int, length: int, at: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Two fingerprints of the ``length`` bytes from each of the first n places, or those in ``at``.

    Lengths double from 8 bytes on; a length in between is two overlapping halves. ``data`` has
    ``length`` bytes behind the last place.
    """
    width = 8
    held = np.lib.stride_tricks.sliding_window_view(data, 8).copy().view(np.uint64).ravel()
    while width * 2 <= length:
        held = mix(held[:-width], held[width:])
        width *= 2
    at = np.arange(n) if at is None else at
    left, right = held[at], held[at + length - width]
    return mix(left, right), mix(right ^ np.uint64(0x94D049BB133111EB), left)


def _sampled(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sampled places of a block, and the two fingerprints of the tuples there."""
    v = cover_for(length)
    width = length - v + 1
    covered = np.zeros(v, bool)
    covered[list(COVERS[v])] = True
    places, first, second = [], [], []
    padded = np.concatenate((data, np.zeros(length, np.uint8)))
    sizes = np.diff(offsets)
    for lo in range(0, len(data), _PIECE):
        hi = min(lo + _PIECE, len(data))
        doc = np.searchsorted(offsets, np.arange(lo, hi), "right") - 1
        inner = np.arange(lo, hi) - offsets[doc]
        at = np.nonzero(covered[inner % v] & (inner + width <= sizes[doc]))[0]
        a, b = _fingerprints(padded[lo : hi + length], hi - lo, width, at)
        places.append(at + lo)
        first.append(a)
        second.append(b)
    return np.concatenate(places), np.concatenate(first), np.concatenate(second)


def _distinct(first: np.ndarray, second: np.ndarray):
    keys, at, which, counts = np.unique(first, return_index=True, return_inverse=True, return_counts=True)
    return keys, second[at], at, which, counts


def _tuples(length: int) -> Callable:
    def hashes(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        data, offsets = blocks.opened(row)
        if not len(data):
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
        keys, spread, _, _, counts = _distinct(*_sampled(data, offsets, length)[1:])
        return keys, counts, spread

    return hashes


def _merged(row: dict, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The places whose suffix is within reach of a shared name, and fingerprints of their prefixes."""
    data, offsets = blocks.opened(row)
    none = np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    if not len(data):
        return none
    width = length - cover_for(length) + 1
    places, first, second = _sampled(data, offsets, length)
    keys, spread, _, which, _ = _distinct(first, second)
    named = places[blocks.told(row, "shared", keys, spread)[which] > 0] if len(keys) else places
    doc = np.searchsorted(offsets, named, "right") - 1
    lo = np.maximum(named - (length - width), offsets[doc])
    hi = np.minimum(named, offsets[doc + 1] - length) + 1
    lo, hi = lo[lo < hi], hi[lo < hi]
    marks = np.zeros(len(data) + 1, np.int32)
    np.add.at(marks, lo, 1)
    np.subtract.at(marks, hi, 1)
    reached = np.nonzero(np.cumsum(marks[:-1]) > 0)[0]
    if not len(reached):
        return none
    padded = np.concatenate((data, np.zeros(length, np.uint8)))
    firsts, seconds = [], []
    for piece in np.split(reached, np.searchsorted(reached, np.arange(_PIECE, len(data), _PIECE))):
        if len(piece):
            base, n = piece[0], int(piece[-1] - piece[0]) + 1
            a, b = _fingerprints(padded[base : base + n + length], n, length, piece - base)
            firsts.append(a)
            seconds.append(b)
    return reached, np.concatenate(firsts), np.concatenate(seconds)


def _prefixes(length: int) -> Callable:
    def hashes(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        _, first, second = _merged(row, length)
        keys, spread, _, _, counts = _distinct(first, second)
        return keys, counts, spread

    return hashes


def _cutting(length: int) -> Callable:
    kind = pa.schema([
        ("doc_id", pa.int64()), ("n_bytes", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary()),
    ])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                data, offsets = blocks.opened(row)
                gone = np.zeros(len(data) + 1, np.int32)
                reached, first, second = _merged(row, length)
                if len(reached):
                    keys, spread, at, which, _ = _distinct(first, second)
                    stays = np.zeros(len(reached), bool)
                    stays[at[blocks.told(row, "first", keys, spread) > 0]] = True
                    starts = reached[~stays]
                    np.add.at(gone, starts, 1)
                    np.subtract.at(gone, starts + length, 1)
                removed = np.cumsum(gone[:-1]) > 0
                out = []
                for i, (lo, hi) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                    mask = removed[lo:hi]
                    spans, kept = [], data[lo:hi]
                    if mask.any():
                        edges = np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0)).tolist()
                        spans = [{"start": a, "end": b} for a, b in zip(edges[::2], edges[1::2], strict=True)]
                        kept = kept[~mask]
                    out += [{"doc_id": row["ids"][i], "n_bytes": hi - lo, "spans": spans, "kept": kept.tobytes()}] * row["copies"][i]
                yield pa.RecordBatch.from_pylist(out, kind)

    return cut


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, the removed ``spans`` of bytes and the ``kept`` bytes of every document."""
    if not cover_for(length):
        raise ValueError("length has to be 14 at least")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    named = rows.select("doc_id", F.octet_length("text").alias("n"), F.xxhash64("text").alias("h"), F.crc32("text").alias("c"))
    seen = named.where((F.col("n") >= length) & F.col("doc_id").isNotNull())
    firsts = seen.groupBy("n", "h", "c").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    copies = written(seen.join(firsts.drop("last"), ["n", "h", "c"]).where("doc_id > first").drop("first"), "copies")

    total = named.agg(F.sum("n")).first()[0] or 0
    keyed = rows.withColumns({"n": F.octet_length("text"), "h": F.xxhash64("text"), "c": F.crc32("text")})
    others = keyed.join(copies, ["doc_id", "n", "h", "c"], "left_anti").select("doc_id", "text")
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // _PARTITION_BYTES + 1)
    laid = blocks.lay_out(others.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text"))

    shared = blocks.ask(laid, _tuples(length), total * len(COVERS[cover_for(length)]) / cover_for(length), "shared")
    merged = laid.join(shared, "block", "left")
    first = blocks.ask(merged, _prefixes(length), total, "first")
    cut = merged.join(first, "block", "left").mapInArrow(_cutting(length), _SCHEMA)
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n").cast("long").alias("end")))
    return cut.unionByName(copies.select(
        "doc_id", F.col("n").cast("long").alias("n_bytes"), whole.alias("spans"), F.lit(b"").alias("kept")
    ))
