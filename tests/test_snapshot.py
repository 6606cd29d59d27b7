import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows_of
from syncflow.operators import changelog
from syncflow.plans.ingest import snapshot_even_chunks
from syncflow.sources import snapshot


def skewed(n=5000):
    """Unique keys, nine tenths of which lie in a thousandth of the range."""
    return sorted({i if i % 10 else i * 1000 for i in range(n)})


def test_even_chunks_of_a_skewed_key(spark):
    keys = skewed()
    df = spark.createDataFrame([(k,) for k in random.Random(1).sample(keys, len(keys))] + [(None,)], "id long")
    want = [keys[i : i + 300] for i in range(0, len(keys), 300)]
    got = snapshot.even_chunks(df, "id", 300)
    assert rows_of(got) == sorted([(c, p[0], p[-1], len(p)) for c, p in enumerate(want)], key=repr)


@pytest.mark.parametrize("most", [2_097_151, 9_000_000])
def test_even_chunks_of_cubes_beyond_64_bits(spark, tmp_path, most):
    keys = [1, 2, *range(most - 1500, most + 1)]
    spark.createDataFrame([(k,) for k in [*keys, None]], "o_orderkey long").write.parquet(f"{tmp_path}/orders.parquet")
    cubes = [k**3 for k in keys]
    want = [(c // 1000, cubes[c], cubes[c : c + 1000][-1], len(cubes[c : c + 1000])) for c in range(0, len(cubes), 1000)]
    got = snapshot_even_chunks(spark, str(tmp_path))
    assert rows_of(got.select("chunk", F.col("first_key").cast("string"), F.col("last_key").cast("string"), "rows")) == sorted(
        [(c, str(a), str(b), n) for c, a, b, n in want], key=repr
    )
    assert got.schema["first_key"].dataType.simpleString() == ("bigint" if most**3 < 2**63 else "decimal(38,0)")


def test_quantile_ranges_are_even_and_whole(spark):
    keys = skewed()
    df = spark.createDataFrame([(k,) for k in keys] + [(None,)], "id long")
    predicates = snapshot.range_predicates("id", snapshot.quantile_bounds(df, "id", 20))
    sizes = [df.where(p).count() for p in predicates]
    assert sum(sizes) == len(keys) + 1 and len(sizes) == 20
    assert max(sizes) <= 2 * len(keys) / 20 and min(sizes) >= len(keys) / 40
    assert snapshot.range_predicates("id", []) == ["1 = 1"]
    assert snapshot.quantile_bounds(df, "id", 1) == [] and snapshot.quantile_bounds(df.limit(0), "id", 4) == []
    with pytest.raises(ValueError):
        snapshot.quantile_bounds(df, "id", 20_000)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 10_000))
def test_snapshot_with_changes_meanwhile(spark, seed):
    """Chunks are read row by row at any place between their marks, while keys come, change and go."""
    rng = random.Random(seed)
    log = [(rng.randrange(40), seq, f"v{seq}", "delete" if rng.random() < 0.3 else "upsert") for seq in range(1, 301)]
    chunks, read = [], []
    for chunk in range(5):
        low = rng.randrange(250)
        high = low + rng.randrange(50)
        chunks.append((chunk, chunk * 8, low, high))
        for key in range(chunk * 8, chunk * 8 + 8):
            seen = [r for r in log if r[0] == key and r[1] <= rng.randint(low, high)]
            if seen and seen[-1][3] == "upsert":
                read.append((key, seen[-1][2], chunk))
    final = {}
    for key, seq, v, kind in log:
        final[key] = (key, v) if kind == "upsert" else None
    merged = snapshot.consistent_snapshot(
        spark.createDataFrame(read, "id int, v string, chunk int"),
        spark.createDataFrame(chunks, "chunk int, first_key int, low int, high int"),
        spark.createDataFrame(log, "id int, seq int, v string, kind string"), "id",
    ).cache()
    live = changelog.live_rows(merged, ["id"], ["phase", "seq"])
    assert rows_of(live, "id", "v") == sorted([r for r in final.values() if r], key=repr)
    # The snapshot alone is each chunk as of its high place.
    then = {}
    for key, seq, v, kind in log:
        if seq <= chunks[key // 8][3]:
            then[key] = (key, v) if kind == "upsert" else None
    assert rows_of(merged.where("phase = 0"), "id", "v") == sorted([r for r in then.values() if r], key=repr)
    merged.unpersist()


def test_every_key_is_in_one_chunk(spark):
    chunks = spark.createDataFrame([(0, 10), (1, 20), (2, 30)], "chunk int, first_key int")
    rows = spark.createDataFrame([(k,) for k in (-5, 9, 10, 19, 20, 29, 30, 99)], "id int")
    assert rows_of(snapshot.located(rows, chunks, "id")) == sorted(
        [(-5, 0), (9, 0), (10, 0), (19, 0), (20, 1), (29, 1), (30, 2), (99, 2)], key=repr
    )
    assert snapshot.located(rows.where(F.lit(False)), chunks, "id").isEmpty()
