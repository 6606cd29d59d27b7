"""Embedding near-dedup: inverted lists, product-quantised residuals, exact rerank.

Vectors are scaled to length 1. A bounded sample (``SAMPLE`` vectors) gives coarse centroids and, in
each of ``SUBSPACES`` parts of the residual, a codebook. Every vector is indexed: its nearest centroid
is its list, and its residual is kept as one code a subspace, with the distance that coding moved it.
Every vector also searches: it probes the nearest lists of its own label, adds up table-lookup distances
to the codes there (asymmetric: the query itself is not coded), and reranks what may be near by the exact
cosine in double precision. May be near is what lies no farther than the cosine allows plus the entry's
own coding error, so by the triangle inequality the lookup loses no pair; only lists that neither side
probes do.

Equal vectors of a label are one entry that knows how many it stands for, so copies never meet. A pair
can be found from either side; it is looked at once, from the entry with the smaller vec_id if that one
probes the other's list, else from the other. A list is worked on in tiles of entries against tiles of
visitors, and a tile gives link counts and a spanning forest, no pairs.

Results for odd input: a vector that is NULL, zero, or has NULL or non-finite components, or a NULL
label, links with nothing; vectors of another dimension than the most frequent of the sample are
indexed by zero padding or their leading part and linked only with those of equal dimension; a NULL
vec_id links with nothing; repeated rows count as vectors of their own; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, pick, written

MIN_COSINE = 0.93
SAMPLE = 20_000  # vectors that the index is fitted on, at most
LIST_SIZE = 500  # entries in an inverted list, about, before labels divide it
MAX_LISTS = 4096
SUBSPACES = 16
CODES = 64
PROBES = 16
TILE = 1024
_ROUNDING = 1e-9  # added to the distance up to which entries are reranked


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * a @ b.T


def _centres(rows: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    centres = rows[rng.choice(len(rows), min(k, len(rows)), replace=False)].copy()
    for _ in range(rounds):
        nearest = _squared(rows, centres).argmin(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, rows)
        counts = np.bincount(nearest, minlength=len(centres))
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


class Index:
    """Coarse centroids and a codebook for each subspace."""

    def __init__(self, sample: np.ndarray, lists: int, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.dim = sample.shape[1]
        self.width = -(-self.dim // SUBSPACES)
        self.coarse = _centres(sample, lists, rng)
        residual = self._cut(sample - self.coarse[_squared(sample, self.coarse).argmin(1)])
        self.books = [_centres(residual[:, s], CODES, rng) for s in range(SUBSPACES)]

    def _cut(self, rows: np.ndarray) -> np.ndarray:
        padded = np.zeros((len(rows), self.width * SUBSPACES))
        padded[:, : rows.shape[1]] = rows
        return padded.reshape(len(rows), SUBSPACES, self.width)

    def fitted(self, row: np.ndarray) -> np.ndarray:
        out = np.zeros(self.dim)
        out[: len(row)] = row[: self.dim]
        return out

    def encode(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The probed lists of each row, nearest first, the codes of its residual and its coding error."""
        lists = _squared(rows, self.coarse).argsort(1, kind="stable")[:, :PROBES]
        residual = self._cut(rows - self.coarse[lists[:, 0]])
        codes = [_squared(residual[:, s], book).argmin(1) for s, book in enumerate(self.books)]
        coded = np.stack([book[code] for book, code in zip(self.books, codes, strict=True)], 1)
        errors = np.sqrt(((residual - coded) ** 2).sum((1, 2)))
        return lists, np.stack(codes, 1).astype(np.uint8), errors

    def distances(self, queries: np.ndarray, which: int, codes: np.ndarray) -> np.ndarray:
        """Squared distances of the queries to coded entries of a list, by table lookup."""
        residual = self._cut(queries - self.coarse[which])
        return sum(_squared(residual[:, s], book)[:, codes[:, s]] for s, book in enumerate(self.books))


def _encoding(index: Index) -> Callable:
    kind = pa.schema([
        ("vec_id", pa.int64()), ("label", pa.string()), ("n", pa.int64()), ("vector", pa.list_(pa.float64())),
        ("lists", pa.list_(pa.int32())), ("codes", pa.binary()), ("error", pa.float64()),
    ])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = [np.asarray(v, np.float64) for v in batch.column("vector").to_pylist()]
            units = [v / np.linalg.norm(v / np.abs(v).max()) / np.abs(v).max() for v in vectors]
            lists, codes, errors = index.encode(np.stack([index.fitted(u) for u in units]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), batch.column("n"), pa.array(units, pa.list_(pa.float64())),
                 pa.array(list(lists.astype(np.int32)), pa.list_(pa.int32())), pa.array([c.tobytes() for c in codes], pa.binary()),
                 pa.array(errors, pa.float64())],
                schema=kind,
            )

    return encode


def _searching(index: Index, min_cosine: float) -> Callable:
    kind = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("links", pa.int64())])

    def search(key: tuple, table: pa.Table) -> pa.Table:
        which = key[1].as_py()
        rows = table.to_pylist()
        held = [r for r in rows if not r["visits"]]
        visitors = [r for r in rows if r["visits"]]
        links: dict[int, int] = {}
        forest: dict[int, int] = {}
        edges = []

        def root(x: int) -> int:
            while forest.get(x, x) != x:
                forest[x] = forest.get(forest[x], forest[x])
                x = forest[x]
            return x

        if held and visitors:
            codes = np.stack([np.frombuffer(r["codes"], np.uint8) for r in held])
            ids = np.array([r["vec_id"] for r in held])
            sizes = np.array([len(r["vector"]) for r in held])
            probed = [set(r["lists"]) for r in held]
            exact = {n: np.stack([r["vector"] for r, s in zip(held, sizes, strict=True) if s == n]) for n in set(sizes.tolist())}
            place = {n: np.flatnonzero(sizes == n) for n in exact}
            errors = np.array([r["error"] for r in held])
            reach = (np.sqrt(max(0.0, 2.0 - 2.0 * min_cosine)) + errors + _ROUNDING) ** 2
            for lo in range(0, len(visitors), 256):
                part = visitors[lo : lo + 256]
                near = index.distances(np.stack([index.fitted(np.array(r["vector"])) for r in part]), which, codes) <= reach
                for i, r in enumerate(part):
                    n = len(r["vector"])
                    if n not in exact:
                        continue
                    at = np.flatnonzero(near[i][place[n]])
                    at = at[exact[n][at] @ np.array(r["vector"]) >= min_cosine]
                    for j in place[n][at].tolist():
                        other = int(ids[j])
                        if other == r["vec_id"] or other < r["vec_id"] and r["home"] in probed[j]:
                            continue  # itself, or a pair that the other side looks at
                        links[r["vec_id"]] = links.get(r["vec_id"], 0) + held[j]["n"]
                        links[other] = links.get(other, 0) + r["n"]
                        x, y = root(r["vec_id"]), root(other)
                        if x != y:
                            forest[max(x, y)] = min(x, y)
                            edges.append((max(x, y), min(x, y)))
        out = [(a, None, n) for a, n in links.items()] + [(a, b, None) for a, b in edges]
        columns = list(zip(*out, strict=True)) or [[]] * 3
        return pa.table([pa.array(c, pa.int64()) for c in columns], schema=kind)

    return search


def _tiled(entries: DataFrame) -> DataFrame:
    """Entries and visitors of every list, each sent to the tiles of the other side."""
    home = F.col("lists")[0]
    shared = ["vec_id", "label", "n", "vector", "lists", "codes", "error", home.alias("home")]
    here = entries.select(*shared, home.alias("list"), F.lit(False).alias("visits"))
    there = entries.select(*shared, F.explode("lists").alias("list"), F.lit(True).alias("visits"))
    tiles = (F.floor((F.col("size") - 1) / F.lit(TILE)) + 1).cast("int")
    sizes = [
        side.groupBy("label", "list").agg(F.count("*").alias("size")).select("label", "list", tiles.alias(name))
        for side, name in ((here, "held_tiles"), (there, "visit_tiles"))
    ]
    grid = sizes[0].join(sizes[1], ["label", "list"])
    mine = F.when(F.col("visits"), F.col("visit_tiles")).otherwise(F.col("held_tiles"))
    others = F.when(F.col("visits"), F.col("held_tiles")).otherwise(F.col("visit_tiles"))
    own = F.pmod(F.xxhash64("vec_id"), mine).cast("int")
    both = here.unionByName(there).join(grid, ["label", "list"])
    sent = both.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), others - 1)))
    return sent.select(
        *shared[:-1], "home", "list", "visits",
        F.when(F.col("visits"), F.col("other")).otherwise(F.col("own")).alias("row"),
        F.when(F.col("visits"), F.col("own")).otherwise(F.col("other")).alias("column"),
    )


def entries_of(vectors: DataFrame) -> DataFrame:
    """vec_id, label, n, vector: one row for equal vectors of a label, by the smallest vec_id."""
    usable = vectors.where(
        "vec_id is not null and label is not null and size(vector) > 0"
        " and forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
        " and exists(vector, x -> x <> 0)"
    )
    return usable.groupBy("label", "vector").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("n")).select(
        "vec_id", "label", "n", "vector"
    )


def fit(entries: DataFrame, sample: int = SAMPLE) -> Index | None:
    """An index fitted on at most ``sample`` entries, taken by hash.

    The hash is cut at a threshold before anything is ordered, so of a table of any size, in any number of
    partitions, about ``sample`` vectors are sent to the driver.
    """
    count = entries.count()
    if not count:
        return None
    hashed, wide = F.pmod(F.xxhash64("vec_id"), F.lit(2**40)), 2**40
    # A tenth more, and some for small samples, so that hardly ever fewer than wanted are left.
    below = int(min(1.0, (1.1 * sample + 100) / count) * wide)
    chosen = entries.where(hashed < below) if below < wide else entries
    rows = chosen.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("vector").collect()
    vectors = [np.asarray(r["vector"], np.float64) for r in rows]
    sizes = [len(v) for v in vectors]
    dim = max(set(sizes), key=lambda n: (sizes.count(n), n))
    scaled = np.stack([v / np.abs(v).max() for v in vectors if len(v) == dim])
    return Index(_unit(scaled), int(min(MAX_LISTS, max(1, count // LIST_SIZE))))


def near_duplicates(
    table: DataFrame, min_cosine: float = MIN_COSINE, sample: int = SAMPLE
) -> DataFrame:
    """vec_id, n_links, component_id and ``kept`` of every row of ``table`` (vec_id, embedding, label)."""
    vectors = pick(table, "vec_id", "embedding", "label").select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )
    entries = written(entries_of(vectors), "entries")
    index = fit(entries, sample)
    if index is None:
        return vectors.select(
            "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")
        )
    coded = written(entries.mapInArrow(
        _encoding(index), "vec_id long, label string, n long, vector array<double>, lists array<int>, codes binary, error double"
    ), "coded")
    found = written(_tiled(coded).groupBy("label", "list", "row", "column").applyInArrow(
        _searching(index, min_cosine), "a long, b long, links long"
    ), "found")
    links = found.where("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    parts = components(found.where("b is not null").select("a", "b")).toDF("rep", "part")
    known = entries.select("label", "vector", F.col("vec_id").alias("rep"), "n").join(links, "rep", "left").join(
        parts, "rep", "left"
    ).select(
        "label", "vector", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"),
        F.coalesce("part", "rep").alias("part"),
    )
    joined = vectors.join(known, ["label", "vector"], "left")
    usable = F.col("part").isNotNull() & F.col("vec_id").isNotNull()
    component = F.when(usable, F.col("part")).otherwise(F.col("vec_id"))
    return joined.select(
        "vec_id", F.when(usable, F.col("links")).otherwise(0).cast("long").alias("n_links"),
        component.alias("component_id"), component.eqNullSafe(F.col("vec_id")).alias("kept"),
    )
