"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence matrix.

Documents with equal n-gram sets are one row of the matrix. Its columns are counted first, block by
block. An n-gram of one row adds to no overlap, so a row that has fewer shared n-grams than its size
demands of any partner (size-derived bound) is dropped. The rows left are multiplied on their rarest
columns only: of n entries, n - ceil(t n) + 1 in order of rarity must hit a partner (the same bound, by
prefix), so a passage that thousands of documents hold does not pair them. In every column the first
document is multiplied with all others; then, with what is linked taken together, each pair of the
column whose components still differ. The product is taken over ``COLUMN_BLOCKS`` blocks of columns, one
after the other: each adds to the overlap counts of the pairs that are left, from the rows' entries in that
block alone, and a pair goes as soon as its count and what either row has in later blocks fall short of
the bound. No pair above the threshold is lost, and pairs within a group of copies are not listed.

Results for odd input: a text without words has no set and links with nothing; fewer than ``n`` words
are one n-gram; a row without doc_id is not linked (component_id NULL); rows that share a doc_id are
one node: what any of their texts links with belongs together; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks
from .common import components, mix, pick, plain, text_bytes, word_hashes, written

COLUMN_BLOCKS = 4
_SHARED = [f"shared{k}" for k in range(COLUMN_BLOCKS)]
_EDGES = np.array([(k << 64) // COLUMN_BLOCKS for k in range(1, COLUMN_BLOCKS)], np.uint64)
_SIGNED = "doc_id long, n_shingles long, s1 long, s2 long"


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of every text."""
    words, counts = word_hashes(data, offsets)
    ends = np.cumsum(counts)
    if len(words) >= n:
        grams = words[: len(words) - n + 1]
        for i in range(1, n):
            grams = mix(grams, words[i : len(words) - n + 1 + i])
    else:
        grams = words[:0]
    for lo, hi in zip((ends - counts).tolist(), ends.tolist(), strict=True):
        if hi - lo >= n:
            yield np.unique(grams[lo : hi - n + 1])
        elif hi > lo:
            whole = words[lo : lo + 1] + np.uint64(hi - lo)  # cannot equal that of n words
            for i in range(lo + 1, hi):
                whole = mix(whole, words[i : i + 1])
            yield whole
        else:
            yield words[:0]


def _signing(n: int) -> Callable:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = np.uint64(0x632BE59BD9B4E019)
        for batch in batches:
            rows = []
            for grams in shingle_sets(*text_bytes(batch.column("text")), n):
                rows.append((len(grams), int(mix(grams, salt).sum().view(np.int64)), int(mix(grams ^ salt, grams).sum().view(np.int64))))
            columns = list(zip(*rows, strict=True)) or [[]] * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns)],
                names=["doc_id", "n_shingles", "s1", "s2"],
            )

    return sign


def _block_hashes(n: int) -> Callable:
    def hashes(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys, counts = np.unique(np.concatenate(list(shingle_sets(*blocks.opened(row), n))), return_counts=True)
        return keys, counts, keys

    return hashes


def _need(sizes, percent: int):
    """The overlap that a set of this size demands of any partner."""
    return -(-sizes * percent // 100)


def _by_columns(grams: np.ndarray) -> dict[str, bytes]:
    """The entries of a row in each block of columns; columns are sorted, so blocks are slices."""
    parts = np.split(grams, np.searchsorted(grams, _EDGES))
    return {name: part.tobytes() for name, part in zip(_SHARED, parts, strict=True)}


def _bounding(n: int, percent: int) -> Callable:
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n", pa.int64()), ("rare", pa.list_(pa.int64())), ("place", pa.list_(pa.int64())),
        *((name, pa.binary()) for name in _SHARED),
    ])

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sets = list(shingle_sets(*blocks.opened(row), n))
                keys = np.unique(np.concatenate(sets))
                held = blocks.told(row, "held", keys, keys)
                out: list[dict] = []
                for doc_id, grams in zip(row["ids"], sets, strict=True):
                    times = held[np.searchsorted(keys, grams)]
                    shared, need = grams[times > 1], _need(len(grams), percent)
                    if len(grams) and len(shared) >= need:
                        rare = np.lexsort((grams, times))[: len(grams) - need + 1]
                        place = np.flatnonzero(times[rare] > 1)
                        out.append({
                            "doc_id": doc_id, "n": len(grams), "rare": grams[rare[place]].view(np.int64),
                            "place": place, **_by_columns(shared),
                        })
                yield pa.RecordBatch.from_pylist(out, schema)

    return bound


def _multiplying(percent: int) -> Callable:
    """The counts of a batch of pairs after one more block of columns, for pairs that may reach the bound."""
    names = ("a", "b", "na", "nb", "overlap")
    kind = pa.schema([(name, pa.int64()) for name in names])

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, na, nb, overlap, ra, rb = (batch.column(c).to_pylist() for c in (*names, "ra", "rb"))
            out: dict[str, list] = {name: [] for name in names}
            before, left = None, np.zeros(0, np.uint64)
            for i in range(batch.num_rows):
                if a[i] != before:
                    before, left = a[i], np.frombuffer(batch.column("sa")[i].as_buffer(), np.uint64)
                right = np.frombuffer(batch.column("sb")[i].as_buffer(), np.uint64)
                count = overlap[i]
                if len(left) and len(right):
                    at = np.minimum(np.searchsorted(left, right), len(left) - 1)
                    count += int((left[at] == right).sum())
                most = count + min(ra[i], rb[i])
                if 100 * most >= percent * (na[i] + nb[i] - most):
                    for name, value in zip(names, (a[i], b[i], na[i], nb[i], count), strict=True):
                        out[name].append(value)
            yield pa.RecordBatch.from_pydict(out, kind)

    return multiply


def _linked(pairs: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, na, nb) that reach the threshold: their counts, block of columns by block."""
    at = pairs.withColumn("overlap", F.lit(0).cast("long"))
    for k, name in enumerate(_SHARED):
        later = sum((F.octet_length(c) for c in _SHARED[k + 1 :]), F.lit(0))
        entries = rows.select("doc_id", name, F.call_function("div", later, F.lit(8)).cast("long").alias("rest"))
        met = at.join(entries.toDF("b", "sb", "rb"), "b").join(entries.toDF("a", "sa", "ra"), "a")
        at = written(met.select("a", "b", "na", "nb", "overlap", "sa", "sb", "ra", "rb").mapInArrow(
            _multiplying(percent), "a long, b long, na long, nb long, overlap long"
        ), "overlaps")
    return at.select("a", "b")


def _fits(percent: int):
    """Whether two rows of a column can be linked: by their sizes, and by what they have left.

    Of a linked pair, this holds in the first column that the two share.
    """
    left = F.least(F.col("na") - F.col("at"), F.col("nb") - F.col("bt"))
    return left * (100 + percent) >= (F.col("na") + F.col("nb")) * percent


def links(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b): links that join the same documents as all links do."""
    entries = rows.select("doc_id", "n", F.explode(F.arrays_zip("rare", "place")).alias("e")).select(
        F.col("e.rare").alias("gram"), "doc_id", "n", F.col("e.place").alias("place")
    )
    columns = entries.groupBy("gram").agg(F.count("*").alias("size"), F.min(F.struct("doc_id", "n", "place")).alias("first"))
    entries = written(entries.join(columns.where("size > 1"), "gram"), "entries")
    pairs = entries.select(
        F.col("first.doc_id").alias("a"), F.col("doc_id").alias("b"), F.col("first.n").alias("na"), F.col("n").alias("nb"),
        F.col("first.place").alias("at"), F.col("place").alias("bt"),
    ).where("a <> b").where(_fits(percent)).select("a", "b", "na", "nb").distinct()
    found = _linked(pairs, rows, percent)

    parts = components(found)
    known = entries.join(parts.toDF("doc_id", "part"), "doc_id", "left").select(
        "gram", "doc_id", "n", "place", F.coalesce("part", "doc_id").alias("part")
    )
    open_columns = known.groupBy("gram").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo < hi")
    known = written(known.join(open_columns.select("gram"), "gram"), "open-entries")
    left, right = known.toDF("gram", "a", "na", "at", "pa"), known.toDF("gram", "b", "nb", "bt", "pb")
    rest = left.join(right, "gram").where("pa < pb").where(_fits(percent)).select("a", "b", "na", "nb").distinct()
    return found.union(_linked(rest, rows, percent))


def join(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles and component_id of every document, linked at ``percent`` or more."""
    texts = pick(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    signed = written(texts.mapInArrow(_signing(n), _SIGNED), "signatures")
    kind = ["n_shingles", "s1", "s2"]
    kinds = signed.where("n_shingles > 0 and doc_id is not null").groupBy(*kind).agg(F.min("doc_id").alias("rep"))
    kinds = written(kinds, "kinds")
    shingles = kinds.agg(F.sum("n_shingles")).first()[0] or 0

    reps = texts.join(kinds.select(F.col("rep").alias("doc_id")).distinct(), "doc_id")
    laid = blocks.lay_out(reps.sortWithinPartitions("doc_id", "text"))
    answers = blocks.ask(laid, _block_hashes(n), shingles, "held")
    rows = written(laid.join(answers, "block").mapInArrow(
        _bounding(n, percent),
        "doc_id long, n long, rare array<long>, place array<long>, " + ", ".join(f"{c} binary" for c in _SHARED),
    ), "rows")
    parts = components(written(links(rows, percent), "all-links"))
    placed = kinds.join(parts.toDF("rep", "part"), "rep", "left").select(*kind, F.coalesce("part", "rep").alias("part"))
    joined = signed.join(placed, kind, "left")
    return joined.select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("part", "doc_id")).alias("component_id")
    )


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """Of each group of linked documents the one with the smallest doc_id, with all its columns."""
    placed = join(docs, n, percent)
    gone = placed.where("component_id <> doc_id").select(F.col("doc_id").alias("gone")).distinct()
    rows, at = plain(docs, "doc_id")
    return rows.join(gone, F.col(at["doc_id"]).cast("long") == F.col("gone"), "left_anti").toDF(*docs.columns)
