import random

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from syncflow.operators import match


def sets(seed, count, prefix):
    rng = random.Random(seed)
    words = [f"source_table:t{i}" for i in range(8)] + [f"sink_table:s{i}" for i in range(4)] + ["connector:kafka"]
    out = {}
    for i in range(count):
        out[f"{prefix}{i}"] = {w for w in words if rng.random() < 0.35} | {"connector:kafka"}
    return out


def frame(spark, named, column):
    # Repeated features, in any order.
    rows = [(n, f) for n, fs in named.items() for f in fs] * 2
    random.Random(0).shuffle(rows)
    return spark.createDataFrame(rows, f"{column} string, feature string")


def score(a, b):
    both = a & b
    return (len(both) + 0.5 * sum(f.startswith("sink_table:") for f in both)) / len(a | b)


@pytest.mark.parametrize("seed", [1, 2])
def test_match_candidates(spark, seed):
    jobs, candidates = sets(seed, 12, "j"), sets(seed + 50, 5, "c")
    got = match.match_candidates(
        frame(spark, jobs, "job"), frame(spark, candidates, "candidate")
    ).collect()
    for j, features in jobs.items():
        ranked = sorted(candidates, key=lambda c: (-score(features, candidates[c]), c))
        rows = sorted((r for r in got if r.job == j), key=lambda r: r.rank)
        assert [r.candidate for r in rows] == ranked
        for r in rows:
            assert r.score == pytest.approx(score(features, candidates[r.candidate]))
            shown = float(f"{r.score + 1e-9:.2f}")
            best = "excellent" if shown >= 0.8 else "good" if shown >= 0.6 else "fair" if shown >= 0.3 else "poor"
            assert r.tier == best


def test_pairs_without_a_shared_feature_are_absent(spark):
    jobs = spark.createDataFrame([("j", "a")], "job string, feature string")
    candidates = spark.createDataFrame([("x", "b")], "candidate string, feature string")
    assert match.match_candidates(jobs, candidates).isEmpty()
    assert match.match_combined(jobs, candidates).isEmpty()


def test_match_combined(spark):
    jobs = {"j1": {"source_table:a", "sink_table:x"}, "j2": {"connector:kafka", "sink_table:y"}}
    candidates = {
        "full": {"source_table:a", "sink_table:x", "connector:kafka", "sink_table:y"},
        "half": {"source_table:a", "sink_table:x"},
        "no_sink": {"source_table:a", "source_table:b"},
    }
    got = match.match_combined(frame(spark, jobs, "job"), frame(spark, candidates, "candidate"))
    rows = {r.candidate: (round(r.score, 6), r.tier) for r in got.collect()}
    assert rows == {
        "full": (1.0, "high"), "half": (round(0.5 * 0.6 + 0.5 * 0.4, 6), "medium"),
        "no_sink": (round(0.2 * 0.6, 6), "low"),
    }


def test_no_sinks_among_the_jobs(spark):
    jobs = spark.createDataFrame([("j", "a")], "job string, feature string")
    candidates = spark.createDataFrame([("c", "a")], "candidate string, feature string")
    assert rows_of(match.match_combined(jobs, candidates), "sink_coverage", "score") == [(0.0, 0.6)]


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_best_candidates_need_few_pairs(spark, seed):
    rng = random.Random(seed)
    jobs, candidates = sets(seed, 30, "j"), sets(seed + 50, 12, "c")
    for named, rare in ((jobs, 3), (candidates, 2)):  # rare features, and sizes that differ
        for i, features in enumerate(named.values()):
            features |= {f"sink_table:rare{rng.randrange(20)}" for _ in range(rare)}
            features |= {f"source_table:own{i}_{n}" for n in range(rng.randrange(12))}
    a, b = frame(spark, jobs, "job"), frame(spark, candidates, "candidate")
    ranked = match.match_candidates(a, b).where("rank = 1")
    columns = ["job", "candidate", "shared", "shared_sinks", "score"]
    assert rows_of(match.best_candidates(a, b), *columns) == rows_of(ranked, *columns)
    kinds = a.groupBy("job").agg(F.sort_array(F.collect_set("feature")).alias("features")).withColumnRenamed("job", "set")
    looked_at = match.best_pairs(kinds, b.distinct(), "candidate", "feature").count()
    assert looked_at < match.match_candidates(a, b).count() / 2


def test_large_candidates_are_counted_by_feature(spark):
    """No set of a candidate goes with its pairs, and no step deals pairs out again."""
    jobs = {f"j{i}": {"sink_table:s0", f"sink_table:s{i}", f"source_table:t{i}"} for i in range(40)}
    candidates = {f"c{i}": {f"sink_table:s{n}" for n in range(i, 3000, 3)} for i in range(3)}
    a, b = frame(spark, jobs, "job"), frame(spark, candidates, "candidate")
    best, ranked = match.best_candidates(a, b), match.match_candidates(a, b)
    columns = ["job", "candidate", "shared", "shared_sinks", "score"]
    assert rows_of(best, *columns) == rows_of(ranked.where("rank = 1"), *columns)
    want = {(j, c): pytest.approx(score(f, h)) for j, f in jobs.items() for c, h in candidates.items() if f & h}
    assert {(r.job, r.candidate): r.score for r in ranked.collect()} == want
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in (best, ranked)]
    assert all("array_intersect" not in p for p in plans)
    assert plans[1].split("Initial Plan")[0].count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("size", [0, 1 << 30])
def test_index_too_large_for_tasks(spark, monkeypatch, size):
    monkeypatch.setattr(match, "INDEX_BYTES", size)
    monkeypatch.setattr(match, "MET_ROWS", 20)
    jobs, candidates = sets(5, 30, "j"), sets(6, 12, "c")
    a, b = frame(spark, jobs, "job"), frame(spark, candidates, "candidate")
    ranked = match.match_candidates(a, b)
    want = {(j, c): pytest.approx(score(f, h)) for j, f in jobs.items() for c, h in candidates.items()}
    assert {(r.job, r.candidate): r.score for r in ranked.collect()} == want
    columns = ["job", "candidate", "shared", "shared_sinks", "score"]
    assert rows_of(match.best_candidates(a, b), *columns) == rows_of(ranked.where("rank = 1"), *columns)
