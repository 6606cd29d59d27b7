"""Approximate nearest neighbours by inner product: inverted lists and an adaptive dimension scan.

**Lists.** A bounded sample (``SAMPLE`` vectors, chosen by hash) gives coarse centroids on as many levels as
the table needs, ``BRANCH`` centroids a level at most: each level codes the residual of the one before, and
a vector's codes name its list, so the number of lists grows with the table and lists stay short. Every
vector is indexed.

**Probes.** Inner products of a query with the members of a cell are spread about that with its centroid,
by the query's length times the cell's mean residual. This gives the score that ``k`` vectors are expected
to reach, and how many of them each cell holds. A query goes down into the cells that hold ``COVER`` of
them, richest first: some few where vectors are clustered, most of the lists where they have no
structure. Nothing caps their number.

**Scan.** Vectors get one more component that gives all of a tile the same length (a query has 0 there),
so the largest inner product is the smallest distance. They are rotated at random and kept in blocks of
``BLOCK`` columns. A query adds up partial distances block by block, for all candidates of a list that are
left, and tests after each block whether a candidate can still be among the ``k`` nearest: the partial
distance over d of D columns estimates the whole one with an error of about 1 / sqrt(d), so what is above
the k-th nearest so far by a factor of 1 + ``CERTAINTY`` / sqrt(d) is abandoned. Those that reach the last
block are scored on the original vectors, in double precision.

Equal vectors are one entry, with the k + 1 smallest vec_ids of them; equal queries are asked once. Lists are
cut into tiles of some ``TILE`` entries, and tiles are dealt out to buckets. A query is sent once to
each bucket that holds lists it probes, and the queries of a bucket are cut into tiles as well.

Results for odd input: vectors that are NULL, zero, or have NULL or non-finite components, and rows without
a vec_id, take no part, neither as queries nor as candidates; vectors are compared with those of equal
dimension only (other dimensions than the sample's most frequent one are probed by zero padding or their
leading part); a row repeated with the same vec_id and vector counts once; a vec_id with several vectors
has each as a candidate and asks with each, and none of them is found by it; fewer than k candidates are
all found. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import pick, written

SAMPLE = 20_000  # vectors that the index is fitted on, about
LIST_SIZE = 500  # vectors in a list, about
BRANCH = 256  # centroids on a level, at most
COVER = 0.985  # of the expected neighbours that are looked for
BLOCK = 16  # columns
CERTAINTY = 2.1  # standard errors of a partial distance
TILE = 2048  # entries of a list that are scanned together
BUCKET = 8192  # entries in a bucket, about
VISITORS = 1024  # queries that meet a bucket together

_Z = np.linspace(-9.0, 9.0, 7201)
_ABOVE = np.array([0.5 * math.erfc(z / math.sqrt(2.0)) for z in _Z])


def _above(z: np.ndarray) -> np.ndarray:
    """The share of a normal distribution above z."""
    return np.interp(z, _Z, _ABOVE)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * a @ b.T


def _centroids(rows: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    centroids = rows[rng.choice(len(rows), min(k, len(rows)), replace=False)].copy()
    for _ in range(rounds):
        nearest = _distances(rows, centroids).argmin(1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, rows)
        held = np.bincount(nearest, minlength=len(centroids))
        centroids[held > 0] = sums[held > 0] / held[held > 0, None]
    return centroids


class Levels:
    """Centroids of each level, fitted on a sample of vectors of one dimension."""

    def __init__(self, sample: np.ndarray, lists: int, branch: int = BRANCH, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.dim = sample.shape[1]
        depth = 1
        while branch**depth < lists:
            depth += 1
        width = next(n for n in range(1, branch + 1) if n**depth >= lists)
        self.books, left = [], sample
        for _ in range(depth):
            self.books.append(_centroids(left, width, rng))
            left = left - self.books[-1][_distances(left, self.books[-1]).argmin(1)]

    def fitted(self, rows: np.ndarray) -> np.ndarray:
        """Rows in the dimension of the index."""
        out = np.zeros((len(rows), self.dim))
        width = min(self.dim, rows.shape[1])
        out[:, :width] = rows[:, :width]
        return out

    def encode(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes on each level and the squared residual after it."""
        left, codes, squares = self.fitted(rows), [], []
        for book in self.books:
            codes.append(_distances(left, book).argmin(1))
            left = left - book[codes[-1]]
            squares.append((left * left).sum(1))
        return np.stack(codes, 1), np.stack(squares, 1)


def _by_dimension(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and stacked vectors of each dimension."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    for dim in np.unique(sizes):
        at = np.flatnonzero(sizes == dim)
        yield at, column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), dim)


def _floats(rows: np.ndarray) -> pa.Array:
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(rows.reshape(-1)))


def _coding(levels: Levels):
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.zeros((batch.num_rows, len(levels.books)), np.int64)
            squares = np.zeros((batch.num_rows, len(levels.books)))
            for at, rows in _by_dimension(batch.column("vector")):
                codes[at], squares[at] = levels.encode(rows)
            # The cells on the way down, as numbers.
            cells = np.zeros_like(codes)
            for level in range(codes.shape[1]):
                above = cells[:, level - 1] if level else 0
                cells[:, level] = above * BRANCH + codes[:, level] + (0 if level else 1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, _floats(cells).cast(pa.list_(pa.int64())), _floats(squares)],
                names=[*batch.schema.names, "cells", "squares"],
            )

    return code


def _descending(levels: Levels, level: int, k: int, cover: float):
    """From the cells that a query is in to those below that hold what it looks for."""
    kind = pa.schema([
        ("q", pa.int64()), ("vector", pa.list_(pa.float64())), ("cell", pa.int64()), ("score", pa.float64()), ("goal", pa.float64()),
    ])

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = levels.books[level]
        for batch in batches:
            below = batch.column("below").to_pylist()
            cells = batch.column("cell").to_numpy(zero_copy_only=False)
            scores = batch.column("score").to_numpy(zero_copy_only=False)
            goals = batch.column("goal").to_numpy(zero_copy_only=False)
            rows, found = [], []
            for at, vectors in _by_dimension(batch.column("vector")):
                fitted = levels.fitted(vectors)
                dots, lengths = fitted @ book.T, np.sqrt((fitted * fitted).sum(1))
                for i, row in enumerate(at.tolist()):
                    codes = np.array([b["code"] for b in below[row]])
                    counts = np.array([b["n"] for b in below[row]], float)
                    spread = lengths[i] * np.sqrt(np.array([b["square"] for b in below[row]]) / levels.dim) + 1e-12
                    middle = scores[row] + dots[i, codes]
                    goal = goals[row] if level else _goal(middle, spread, counts, k)
                    held = counts * _above((goal - middle) / spread)
                    order = np.argsort(-held, kind="stable")
                    until = np.cumsum(held[order])
                    n = int(np.searchsorted(until, cover * until[-1])) + 1 if until[-1] > 0 else 0
                    for j in order[:n].tolist():
                        rows.append(row)
                        above = int(cells[row])
                        found.append((above * BRANCH + int(codes[j]) + (0 if level else 1), float(middle[j]), float(goal)))
            taken = batch.select(["q", "vector"]).take(pa.array(rows, pa.int64()))
            new = list(zip(*found, strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [*taken.columns, pa.array(new[0], pa.int64()), pa.array(new[1], pa.float64()), pa.array(new[2], pa.float64())],
                schema=kind,
            )

    return descend


def _goal(middle: np.ndarray, spread: np.ndarray, counts: np.ndarray, k: int) -> float:
    """The score that ``k`` members of the cells are expected to reach."""
    low, high = float((middle - 9 * spread).min()), float((middle + 9 * spread).max())
    for _ in range(40):
        goal = (low + high) / 2
        if (counts * _above((goal - middle) / spread)).sum() > k:
            low = goal
        else:
            high = goal
    return low


_ROTATIONS: dict[int, np.ndarray] = {}


def _rotation(n: int) -> np.ndarray:
    """A random rotation of ``n`` dimensions, always the same."""
    if n not in _ROTATIONS:
        q, r = np.linalg.qr(np.random.default_rng(n).standard_normal((n, n)))
        _ROTATIONS[n] = q * np.sign(np.diag(r))
    return _ROTATIONS[n]


def _lengths(rows: np.ndarray) -> np.ndarray:
    most = np.abs(rows).max(1)
    return most * np.sqrt(((rows / most[:, None]) ** 2).sum(1))


class Tile:
    """Candidates in column blocks, lists next to each other.

    Within a list, vectors whose lengths have the same power of two make a run. A run is scaled to a length
    of 1 at most, and one more component makes all lengths 1, so one long vector spoils no other's distances.
    """

    def __init__(self, vectors: np.ndarray, lists: np.ndarray, names: np.ndarray):
        lengths = _lengths(vectors)
        powers = np.frexp(lengths)[1]
        order = np.lexsort((names, -powers, lists))
        self.vectors, self.names = vectors[order], names[order]
        lists, powers, lengths = lists[order], powers[order], lengths[order]
        is_new = (lists[1:] != lists[:-1]) | (powers[1:] != powers[:-1])
        starts = np.flatnonzero(np.concatenate(([True], is_new)))
        ends = np.append(starts[1:], len(lists))
        longest = np.maximum.reduceat(lengths, starts)
        self.runs = list(zip(lists[starts].tolist(), starts.tolist(), ends.tolist(), longest.tolist(), strict=True))
        scale = np.repeat(longest, ends - starts)
        dim = vectors.shape[1] + 1
        self.turn = _rotation(dim)
        missing = np.sqrt(np.maximum(1.0 - (lengths / scale) ** 2, 0.0))
        turned = (self.vectors / scale[:, None]) @ self.turn[:-1] + missing[:, None] * self.turn[-1]
        self.cuts = [*range(0, dim, BLOCK), dim]
        # What is left after the last block but one is scored as a whole.
        self.blocks = [np.ascontiguousarray(turned[:, a:b]) for a, b in zip(self.cuts, self.cuts[1:-1], strict=False)]
        self.squares = [(block * block).sum(1) for block in self.blocks]
        self.scanned = 0  # components that were looked at

    def search(self, queries: np.ndarray, wanted: list[list[int]], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of queries, places and scores of the k nearest to each in its lists (best list first), as
        far as the tests let them through."""
        self.queries, self.lengths = queries, _lengths(queries)
        turned = (queries / self.lengths[:, None]) @ self.turn[:-1]
        self.asked = [turned[:, a:b] for a, b in zip(self.cuts, self.cuts[1:-1], strict=False)]
        self.best, self.at = np.full((len(queries), k), -np.inf), np.full((len(queries), k), -1)
        present = {which for which, *_ in self.runs}
        first: dict[int, list[int]] = {}
        others: dict[int, list[int]] = {}
        for q, lists in enumerate(wanted):
            for nth, which in enumerate(x for x in lists if x in present):
                (others if nth else first).setdefault(which, []).append(q)
        # The best list is scored whole, for all queries; the k-th score there limits the others.
        for visitors in (first, others):
            for which, lo, hi, longest in self.runs:
                asking = np.array(visitors.get(which, []), int)
                for part in range(0, len(asking), VISITORS):
                    self._scan(lo, hi, longest, asking[part : part + VISITORS])
        q, nth = np.nonzero(self.at >= 0)
        at = self.at[q, nth]
        return q, at, np.einsum("ij,ij->i", self.vectors[at], queries[q])

    def _scan(self, lo: int, hi: int, longest: float, asking: np.ndarray) -> None:
        """One run for some queries: tests block by block, then the scores of what is left."""
        least = self.best[asking, -1]
        with np.errstate(over="ignore"):
            limit = np.maximum(2.0 - 2.0 * least / (longest * self.lengths[asking]), 0.0)
        stay = self._tested(lo, hi, asking, limit) if np.isfinite(least).any() else np.ones((hi - lo, len(asking)), bool)
        rows, columns = np.nonzero(stay)
        if len(rows) * 16 > stay.size:
            scores = (self.vectors[lo:hi] @ self.queries[asking].T)[rows, columns]
        else:
            scores = np.einsum("ij,ij->i", self.vectors[lo + rows], self.queries[asking[columns]])
        near = scores >= least[columns]
        if near.any():
            self._keep(asking[columns[near]], lo + rows[near], scores[near])

    def _tested(self, lo: int, hi: int, asking: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Which (candidate, query) pass all tests. A block is looked at for whole columns while most pairs
        are left, and pair by pair afterwards."""
        dim = self.cuts[-1]
        partial, pairs = np.zeros((hi - lo, len(asking))), None
        for block, squares, asked, end in zip(self.blocks, self.squares, self.asked, self.cuts[1:], strict=False):
            most = limit * (1.0 + CERTAINTY / math.sqrt(end)) ** 2 * (end / dim) + 1e-12
            if pairs is None:
                mine = asked[asking]
                partial += squares[lo:hi, None] + (mine * mine).sum(1) - 2.0 * block[lo:hi] @ mine.T
                self.scanned += partial.size * block.shape[1]
                stay = partial <= most
                if stay.mean() < 0.1:
                    pairs = np.nonzero(stay)
                    partial = partial[pairs]
                else:
                    partial[~stay] = np.inf  # abandoned for good
            else:
                gap = block[lo + pairs[0]] - asked[asking[pairs[1]]]
                self.scanned += gap.size
                partial = partial + np.einsum("ij,ij->i", gap, gap)
                stay = partial <= most[pairs[1]]
                pairs, partial = (pairs[0][stay], pairs[1][stay]), partial[stay]
        if pairs is None:
            return np.isfinite(partial)
        out = np.zeros((hi - lo, len(asking)), bool)
        out[pairs] = True
        return out

    def _keep(self, q: np.ndarray, at: np.ndarray, scores: np.ndarray) -> None:
        """Take found candidates into the k best of their queries."""
        k = self.best.shape[1]
        some = np.unique(q)
        q = np.concatenate((np.repeat(some, k), q))
        at = np.concatenate((self.at[some].ravel(), at))
        scores = np.concatenate((self.best[some].ravel(), scores))
        order = np.lexsort((self.names[at], -scores, q))
        q, at, scores = q[order], at[order], scores[order]
        nth = np.arange(len(q)) - np.searchsorted(q, q)
        top = nth < k
        self.best[q[top], nth[top]], self.at[q[top], nth[top]] = scores[top], at[top]


def _scanning(k: int):
    kind = pa.schema([("q", pa.int64()), ("score", pa.float64()), ("entry", pa.int64())])

    def scan(table: pa.Table) -> pa.Table:
        asks = table.column("lists").is_valid()
        held, visits = table.filter(pa.compute.invert(asks)), table.filter(asks)
        if not held.num_rows or not visits.num_rows:
            return kind.empty_table()
        (_, vectors), (_, queries) = next(_by_dimension(held.column("vector"))), next(_by_dimension(visits.column("vector")))
        tile = Tile(vectors, held.column("list").to_numpy(), held.column("id").to_numpy())
        q, at, scores = tile.search(queries, visits.column("lists").to_pylist(), k)
        return pa.table([pa.array(visits.column("id").to_numpy()[q]), pa.array(scores), pa.array(tile.names[at])], schema=kind)

    return scan


def usable(table: DataFrame) -> DataFrame:
    """vec_id and vector (double) of the rows that take part, each once, with the vector's hashes h1 and h2."""
    rows = pick(table, "vec_id", "embedding").select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector")
    ).where(
        "vec_id is not null and size(vector) > 0"
        " and forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
        " and exists(vector, x -> x <> 0)"
    )
    hashed = rows.select("*", F.xxhash64("vector").alias("h1"), F.xxhash64(F.lit(1), "vector").alias("h2"))
    return hashed.dropDuplicates(["vec_id", "h1", "h2"])


def _distinct(rows: DataFrame) -> DataFrame:
    """id, h1, h2, vector: one row for equal vectors, by the smallest vec_id. Vectors are shuffled only here."""
    least = rows.groupBy("h1", "h2").agg(F.min("vec_id").alias("vec_id"))
    # A vec_id may have several vectors, so a number of the entry's own is needed.
    return rows.join(least, ["vec_id", "h1", "h2"]).select(F.xxhash64("h1", "h2").alias("id"), "h1", "h2", "vector")


def fit(entries: DataFrame, sample: int = SAMPLE, list_size: int = LIST_SIZE, branch: int = BRANCH) -> Levels | None:
    """Levels fitted on some ``sample`` entries; a table of any size sends about so many to the driver."""
    count = entries.count()
    if not count:
        return None
    # By a hash of the entry's number, so a table with more rows has a smaller part of them chosen.
    share = min(1.0, sample / count)
    chosen = entries.where(F.pmod(F.xxhash64(F.lit(7), "id"), F.lit(2**40)) < int(share * 2**40) + 1)
    vectors = [np.asarray(r["vector"], np.float64) for r in chosen.select("id", "vector").orderBy("id").collect()]
    if not vectors:
        vectors = [np.asarray(r["vector"], np.float64) for r in entries.select("vector").limit(1).collect()]
    sizes = [len(v) for v in vectors]
    dim = max(set(sizes), key=lambda n: (sizes.count(n), n))
    return Levels(np.stack([v for v in vectors if len(v) == dim]), max(1, round(count / list_size)), branch)


def _probed(asked: DataFrame, coded: DataFrame, levels: Levels, k: int, cover: float) -> DataFrame:
    """id, vector, cell and score of the lists that each query probes."""
    at = asked.select(
        F.col("id").alias("q"), "vector", F.lit(0).cast("long").alias("cell"), F.lit(0.0).alias("score"), F.lit(0.0).alias("goal")
    )
    for level in range(len(levels.books)):
        cell, above = F.col("cells")[level], F.lit(0).cast("long") if level == 0 else F.col("cells")[level - 1]
        sizes = coded.groupBy(above.alias("cell"), cell.alias("to")).agg(
            F.count("*").alias("n"), F.avg(F.col("squares")[level]).alias("square")
        )
        code = F.col("to") - 1 if level == 0 else F.pmod("to", F.lit(BRANCH))
        below = sizes.groupBy("cell").agg(
            F.sort_array(F.collect_list(F.struct(code.cast("int").alias("code"), "n", "square"))).alias("below")
        )
        # The first level is one row of BRANCH cells at most; further levels meet by shuffle.
        below = F.broadcast(below) if level == 0 else below
        at = at.join(below, "cell").mapInArrow(
            _descending(levels, level, k, cover), "q long, vector array<double>, cell long, score double, goal double"
        )
    return at


def nearest(
    table: DataFrame, queries: DataFrame, k: int = 20, cover: float = COVER, sample: int = SAMPLE,
    list_size: int = LIST_SIZE, branch: int = BRANCH,
) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` nearest rows of ``table`` to each row of ``queries``.

    Both have vec_id and embedding. Nearest first, ties to the smaller vec_id; no row is found by its own vec_id.
    """
    rows = written(usable(table), "vectors")
    asking = written(usable(queries), "queries")
    entries = written(_distinct(rows), "entries")
    levels = fit(entries, sample, list_size, branch)
    kind = "query_id long, rank int, vec_id long, score double"
    if levels is None:
        return table.sparkSession.createDataFrame([], kind)
    coded = written(entries.mapInArrow(
        _coding(levels), "id long, h1 long, h2 long, vector array<double>, cells array<long>, squares array<double>"
    ), "coded")
    asked = written(_distinct(asking), "asked")
    # One more than wanted, as a query may find itself.
    found = written(_scanned(coded, asked, _probed(asked, coded, levels, k + 1, cover), k + 1), "found")
    # The copies behind an entry: the k + 1 smallest, as a query is found by no more than one of its own.
    smallest = Window.partitionBy("h1", "h2").orderBy("vec_id")
    copies = rows.select(F.xxhash64("h1", "h2").alias("entry"), "h1", "h2", "vec_id").withColumn(
        "nth", F.row_number().over(smallest)
    ).where(F.col("nth") <= k + 1).select("entry", "vec_id")
    best = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    top = found.join(copies, "entry").withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= k + 1)
    lists = top.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("nth", "vec_id", "score"))).alias("top"))
    answers = asking.select(F.col("vec_id").alias("query_id"), F.xxhash64("h1", "h2").alias("q")).join(lists, "q")
    kept = F.slice(F.filter("top", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return answers.select("query_id", F.posexplode(kept).alias("rank", "hit")).select(
        "query_id", (F.col("rank") + 1).cast("int").alias("rank"), "hit.vec_id", "hit.score"
    )


def _scanned(coded: DataFrame, asked: DataFrame, probed: DataFrame, k: int) -> DataFrame:
    """q, score and entry: the k nearest of each query in each bucket that it visits."""
    dim = F.size("vector").alias("dim")
    held = coded.select("id", dim, "vector", F.element_at("cells", -1).alias("list"))
    tiles = held.groupBy("list").agg((F.floor((F.count("*") - 1) / F.lit(TILE)) + 1).cast("int").alias("tiles"))
    buckets = int(-(-coded.count() // BUCKET)) or 1

    def bucket(tile):
        return F.pmod(F.xxhash64("list", tile), F.lit(buckets)).cast("int").alias("bucket")

    dealt = held.join(tiles, "list").withColumn("bucket", bucket(F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int")))
    # A query's lists by bucket, best first; its vector goes once to each.
    wanted = probed.select(F.col("q").alias("id"), F.col("cell").alias("list"), (-F.col("score")).alias("far"))
    wanted = wanted.join(tiles, "list").withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    grouped = wanted.withColumn("bucket", bucket(F.col("tile"))).groupBy("id", "bucket").agg(
        F.sort_array(F.collect_set(F.struct("far", "list"))).alias("lists")
    )
    visits = written(grouped.join(asked, "id").select("id", dim, "vector", "bucket", F.col("lists.list").alias("lists")), "visits")
    crowds = visits.groupBy("dim", "bucket").agg(
        (F.floor((F.count("*") - 1) / F.lit(VISITORS)) + 1).cast("int").alias("crowds")
    )
    here = dealt.join(crowds, ["dim", "bucket"]).select(
        "dim", "bucket", F.explode(F.sequence(F.lit(0), F.col("crowds") - 1)).alias("crowd"), "id", "vector", "list",
        F.lit(None).cast("array<long>").alias("lists"),
    )
    there = visits.join(crowds, ["dim", "bucket"]).select(
        "dim", "bucket", F.pmod(F.xxhash64("id"), F.col("crowds")).cast("int").alias("crowd"), "id", "vector",
        F.lit(None).cast("long").alias("list"), "lists",
    )
    return here.unionByName(there).groupBy("dim", "bucket", "crowd").applyInArrow(
        _scanning(k), "q long, score double, entry long"
    )
