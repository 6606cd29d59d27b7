"""Best-fit packing of tokenised documents into sequences: minimum bin slack.

Every sequence takes the longest piece left and, by a subset-sum over the lengths that are left (a
bitset of the sums that can be reached), the combination that fills it most. Only lengths matter for
that, so the search works on the histogram of lengths, which has ``capacity`` entries however large
the corpus is, and a combination that is found is used as often as its lengths last. The pieces are
then numbered within their length on the cluster and look their place up.

Results for odd input: a NULL or empty text is one piece that holds the end token alone; repeated
rows are packed as often as they occur; an empty table gives an empty result. A text of any length is
tokenised whole and cut into pieces of the capacity, of which the first may be shorter.
"""

from __future__ import annotations

import json
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import pick, written
from .token_count import _byte_symbols

CAPACITY = 2048
END = 0
_SALTED_ROWS = 200_000  # rows of one length that are numbered in one task, on average
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
# The split pattern that byte-level vocabularies of this kind share, a fixed value.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Texts of these letters alone are split alike by both libraries: their classes are long settled.
_SETTLED = regex.compile("[\0-ɏ‐-‧]*")


class Encoder:
    """Token ids of texts under a ``tokenizers`` file, without added special tokens.

    tiktoken gives the same ids several times faster where the ranks of the file are its ids, and
    is used for texts in settled letters; all others go to ``tokenizers`` itself, and so do texts with
    white-space runs so long that tiktoken's pattern search gives up on them.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.plain = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, byte_of = spec["model"]["vocab"], {s: b for b, s in enumerate(_byte_symbols())}
        pieces = spec["model"]["merges"]
        in_order = [vocab["".join(p)] for p in pieces] == list(range(256, 256 + len(pieces)))
        ranks = {bytes(byte_of[s] for s in token): i for token, i in vocab.items()}
        special = {token["content"]: token["id"] for token in spec["added_tokens"]}
        self.fast = tiktoken.Encoding(
            "given", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens=special
        ) if in_order and spec["normalizer"] is None else None

    def ids(self, text: str) -> np.ndarray:
        if self.fast and _SETTLED.fullmatch(text):
            try:
                return self.fast.encode_to_numpy(text, allowed_special="all").astype("<u4")
            except ValueError:  # its stack for backtracking is full
                pass
        return np.array(self.plain.encode(text, add_special_tokens=False).ids, "<u4")


_ENCODERS: dict[str, Encoder] = {}


def _cutting(path: str, capacity: int, end: int) -> Callable:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _ENCODERS:
            _ENCODERS[path] = Encoder(path)
        encoder = _ENCODERS[path]
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = np.append(encoder.ids(text or ""), np.array([end], "<u4"))
                first = len(ids) % capacity or capacity
                starts = [0, *range(first, len(ids), capacity)]
                for piece, (lo, hi) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
                    rows.append((doc_id, piece, lo, hi - lo, zlib.crc32(ids[lo:hi].tobytes())))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return cut


def cut_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """The pieces of every document: doc_id, piece, start, length, ids_crc32."""
    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_cutting(path, capacity, end), _PIECES)


def fullest(left: list[int], room: int) -> dict[int, int]:
    """The lengths, with how often each, whose sum is the largest that fits into ``room``.

    ``left[n]`` pieces of length n may be used. Bit s of ``reached`` says that a sum of s can be had;
    copies of a length come in by powers of two.
    """
    reached, full, steps = 1, (2 << room) - 1, []
    for length in range(min(room, len(left) - 1), 0, -1):
        copies, some = min(left[length], room // length), 1
        while copies > 0 and not reached >> room & 1:
            some = min(some, copies)
            more = (reached | reached << some * length) & full
            if more != reached:
                steps.append((length, some, reached))
                reached = more
            copies -= some
            some *= 2
        if reached >> room & 1:
            break
    used, total = Counter(), reached.bit_length() - 1
    for length, some, before in reversed(steps):
        if not before >> total & 1:
            used[length] += some
            total -= some * length
    return dict(used)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """Fillings with how many sequences use each, until no piece is left."""
    left = [0] * (capacity + 1)
    for length, n in counts.items():
        left[length] = n
    fillings = []
    for longest in range(capacity, 0, -1):
        while left[longest]:
            left[longest] -= 1
            filling = Counter({longest: 1}) + Counter(fullest(left, capacity - longest))
            left[longest] += 1
            times = min(left[length] // n for length, n in filling.items())
            for length, n in filling.items():
                left[length] -= n * times
            fillings.append((times, dict(filling)))
    return fillings


def _places(fillings: list[tuple[int, dict[int, int]]]) -> dict[str, np.ndarray]:
    """For each run of equally placed pieces of a length: first key, first sequence, copies, offset."""
    used, sequence, runs = Counter(), 0, []
    for times, filling in fillings:
        offset = 0
        for length, n in sorted(filling.items(), reverse=True):
            runs.append(((length << 48) + used[length], sequence, n, offset, length))
            used[length] += n * times
            offset += n * length
        sequence += times
    held = np.array(sorted(runs), np.int64).reshape(-1, 5)
    return dict(zip(("key", "sequence", "copies", "offset", "length"), held.T.copy(), strict=True))


def _placing(places: dict[str, np.ndarray]) -> Callable:
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            key = (length << 48) + batch.column("nth").to_numpy()
            run = np.searchsorted(places["key"], key, "right") - 1
            nth, copies = key - places["key"][run], places["copies"][run]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in names] + [
                    pa.array(places["sequence"][run] + nth // copies),
                    pa.array(places["offset"][run] + nth % copies * length),
                ],
                names=[*names, "sequence_id", "offset"],
            )

    return place


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with sequence_id and offset; they are read twice, so give a written table."""
    rows = pieces.count()
    salts = rows // _SALTED_ROWS + 1
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    counts = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    per_length = pieces.groupBy("length").agg(F.count("*").alias("n"))
    places = _places(plan({r["length"]: r["n"] for r in per_length.collect()}, capacity))  # at most `capacity` rows
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    order = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    numbered = (
        salted.withColumn("nth", F.row_number().over(order)).join(first, ["length", "salt"])
        .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("nth") - 1 + F.col("first")).alias("nth"))
    )
    return numbered.mapInArrow(_placing(places), _PIECES + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """Every piece of ``docs`` and its place: no sequence is longer than ``capacity``."""
    return pack(written(cut_pieces(docs, path, capacity, end), "pieces"), capacity)
