"""Approximate nearest neighbours: exact scores, ties and odd rows, and recall against brute force."""

from __future__ import annotations

import numpy as np
import pytest

from syncflow.llm import nearest, queries

SCHEMA = "label string, embedding array<float>, vec_id long, vector int, `a.b` int, list int, id string"


def frame(spark, rows):
    return spark.createDataFrame([("l", v, i, 1, 2, 3, "x") for i, v in rows], SCHEMA)


def brute(rows, asked, k=20):
    """query -> [(score, vec_id)], nearest first."""
    good = {(i, tuple(v)) for i, v in rows if i is not None and v is not None and None not in v}
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in good if np.isfinite(v).all() and np.any(np.array(v) != 0)]
    out = {}
    for q, a in good:
        if q in asked:
            near = [(-float(a @ b), i) for i, b in good if i != q and len(a) == len(b)]
            out.setdefault(q, []).append([(-s, i) for s, i in sorted(near)[:k]])
    return out


def recall(want, got):
    hits = [len({i for _, i in want[q]} & {i for _, i in got.get(q, [])}) / max(1, len(want[q])) for q in want]
    return float(np.mean(hits))


def answers(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_small_tables_are_exact(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.standard_normal(8).astype(np.float32).tolist()) for i in range(300)]
    rows += [(i, rows[7][1]) for i in range(300, 360)]  # copies: ties go to the smaller vec_id
    rows += [(400, None), (401, [0.0] * 8), (402, [None] + [1.0] * 7), (403, [float("nan")] * 8), (404, [float("inf")] * 8)]
    rows += [(None, [1.0] * 8), (420, [1.0, 2.0]), (440, [2.0, 1.0]), (441, []), (460, [1e-30] * 8), (480, [1e15] * 8)]
    rows += [(20, rows[20][1])]  # repeated
    table = frame(spark, rows)
    want = {q: lists[0] for q, lists in brute(rows, {i for i, _ in rows if i is not None and i % 20 == 0}).items()}
    got = answers(nearest.nearest(table, table.where("vec_id % 20 = 0")))
    assert set(got) == set(want)
    for q, near in want.items():
        assert [i for _, i in got[q]] == [i for _, i in near]
        np.testing.assert_allclose([s for s, _ in got[q]], [s for s, _ in near], rtol=1e-12)


def test_fewer_candidates_than_wanted(spark):
    table = frame(spark, [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.0])])
    got = answers(nearest.nearest(table, table.where("vec_id = 0")))
    assert got == {0: [(0.5, 1), (-1.0, 2)]}
    assert nearest.nearest(frame(spark, []), frame(spark, [])).collect() == []
    assert nearest.nearest(frame(spark, [(0, [1.0])]), frame(spark, [(0, [1.0])])).collect() == []
    other = nearest.nearest(table, frame(spark, [(0, [0.0, 1.0]), (0, [1.0, 0.0])]))
    assert other.count() == 4  # two vectors of one vec_id ask, and find the others


@pytest.mark.parametrize(("kind", "branch"), [("isotropic", 256), ("clustered", 4), ("lengths", 256)])
def test_recall_and_abandoning(spark, kind, branch, monkeypatch):
    monkeypatch.setattr(nearest, "TILE", 150)
    monkeypatch.setattr(nearest, "BUCKET", 700)
    monkeypatch.setattr(nearest, "VISITORS", 50)
    rng = np.random.default_rng(1)
    x = rng.standard_normal((3000, 64))
    if kind == "clustered":
        x = 0.25 * x + rng.standard_normal((20, 64))[rng.integers(0, 20, 3000) * (rng.random(3000) < 0.7)]
    if kind == "lengths":
        x *= rng.lognormal(0, 0.5, (3000, 1))
        x[5] *= 1000
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(x)]
    table = frame(spark, rows)
    got = answers(nearest.nearest(table, table.where("vec_id % 20 = 0"), list_size=100, branch=branch))
    want = {q: lists[0] for q, lists in brute(rows, set(range(0, 3000, 20))).items()}
    assert recall(want, got) >= 0.9
    for q, near in got.items():
        assert len(near) == 20 and near == sorted(near, key=lambda x: (-x[0], x[1])) and q not in [i for _, i in near]


def test_candidates_are_abandoned_early():
    rng = np.random.default_rng(2)
    centre = rng.standard_normal(64)
    vectors = np.concatenate([centre + 0.2 * rng.standard_normal((50, 64)), rng.standard_normal((2000, 64))])
    lists = np.repeat([1, 2], [50, 2000])
    tile = nearest.Tile(vectors, lists, np.arange(len(vectors)))
    q, at, scores = tile.search(np.stack([centre, 1e-200 * centre, 1e6 * centre]), [[1, 2], [1, 2], [2, 1]], 20)
    assert tile.scanned < 0.7 * 3 * vectors.shape[0] * 65
    want = np.argsort(-(vectors @ centre), kind="stable")[:20]
    for nth, scale in enumerate((1.0, 1e-200, 1e6)):
        assert tile.names[at[q == nth]].tolist() == want.tolist()
        np.testing.assert_allclose(scores[q == nth], scale * (vectors @ centre)[want], rtol=1e-12)


def test_the_sample_does_not_grow(spark, monkeypatch):
    rows = [(i, [float(i % 97) + 1, float(i % 89), 1.0]) for i in range(4000)]
    entries = nearest._distinct(nearest.usable(frame(spark, rows)))
    held = []
    monkeypatch.setattr(nearest, "Levels", lambda sample, lists, branch: held.append((len(sample), lists)))
    nearest.fit(entries, sample=500)
    assert 350 < held[0][0] < 650 and held[0][1] == 8


def test_given_table(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"]) for r in queries.table(spark, sf_dir, "embeddings").collect()]
    df = queries.op11_nearest(spark, sf_dir)
    assert df.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    want = {q: lists[0] for q, lists in brute(rows, {i for i, _ in rows if i % 20 == 0}).items()}
    assert recall(want, answers(df)) >= 0.95
