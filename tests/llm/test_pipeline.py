"""The pipeline, stage by stage, each on what the one before it kept."""

from __future__ import annotations

from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry_points
import corpus_pipeline
from syncflow.llm import queries
from syncflow.llm.common import written

from .test_operators import brute_links, grams


def sql_over(rows, sql):
    """``sql`` with the given documents in place of the table."""
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows)
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    return [dict(zip(names, r, strict=True)) for r in result.fetchall()]


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """Rows before the first stage and after each; those that are documents as tuples."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, out = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], sf_dir), name))
    assert all(df.columns == columns for df in out[:-1])
    return [sorted(tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()) for df in out[:-1]] + [
        out[-1].collect()
    ]


def test_stages_are_registered():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "ngram_join", "mixing", "packing"]
    assert entry_points.queries()["pipeline"] is corpus_pipeline.run
    assert "pipeline" not in entry_points.oracle_sql()


def test_quality_stage(stages):
    kept = {r["doc_id"] for r in sql_over(stages[0], queries.SQL["op9_quality_rules"]) if r["kept"]}
    assert stages[1] == [r for r in stages[0] if r[0] in kept]


def test_line_stage(stages):
    cut = {r["doc_id"]: r for r in sql_over(stages[1], queries.SQL["op8_line_dedup"])}
    want = []
    for doc_id, text, lang, source, n_chars in stages[1]:
        r = cut[doc_id]
        if r["n_dropped"] == 0:
            want.append((doc_id, text, lang, source, n_chars))
        elif r["n_dropped"] < r["n_lines"]:
            want.append((doc_id, r["text"], lang, source, len(r["text"])))
    assert stages[2] == want


def test_near_duplicate_stage(stages):
    roots = brute_links({r[0]: grams(r[1], 5) for r in stages[2]}, 80)
    assert stages[3] == [r for r in stages[2] if roots[r[0]] == r[0]]


def test_mixing_stage(stages):
    sampled = {r["doc_id"] for r in sql_over(stages[3], queries.SQL["op4_mixing"]) if r["sampled"]}
    assert stages[4] == [r for r in stages[3] if r[0] in sampled]


def test_packing_stage(stages):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    lengths = Counter()
    for r in stages[5]:
        lengths[r["doc_id"]] += r["length"]
    assert lengths == {r[0]: len(library.encode(r[1], add_special_tokens=False).ids) + 1 for r in stages[4]}
    used = Counter()
    for r in stages[5]:
        used[r["sequence_id"]] += r["length"]
        assert 0 <= r["offset"] and r["offset"] + r["length"] <= 2048
    assert max(used.values()) <= 2048 and len(used) <= -(-sum(used.values()) // 2048) + 1
    assert np.all([r["ids_crc32"] >= 0 for r in stages[5]])
