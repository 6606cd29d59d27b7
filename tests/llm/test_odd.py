"""Odd rows, clashing columns and very long texts, for the operators and the pipeline as a whole."""

from __future__ import annotations

import datetime as dt
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from syncflow.llm import line_templates, quality, queries, sharding, token_count, url_filter
from syncflow.llm.common import written

from .helpers import odd_docs, plain_rows, prose
from .test_pipeline import sql_over

WORD = public_tokenizers.path("word_bpe_49k.json")
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, key string, shard int"


@pytest.fixture(scope="module")
def long_text():
    """Some megabytes with white space, short and very long words, and a line of three megabytes."""
    return "\n".join(prose(i, 2000) for i in range(60)) + "\n" + "x" * 200_000 + " " * 500_000 + "\n" + "line " * 600_000


def test_very_long_texts(spark, long_text):
    docs = spark.createDataFrame([(1, long_text, "s"), (2, prose(1, 80), "s")], "doc_id long, text string, source string")
    words = long_text.encode().split()
    judged = {r["doc_id"]: r for r in quality.judge(docs).collect()}
    assert judged[1]["n_words"] == len(words) and judged[1]["word_chars"] == sum(map(len, words))
    counted = {r["doc_id"]: r["n_tokens"] for r in token_count.count_tokens(docs, WORD).collect()}
    assert counted[1] == len(Tokenizer.from_file(WORD).encode(long_text, add_special_tokens=False).ids)
    kept = {r["doc_id"]: r for r in line_templates.drop_recurring(docs).collect()}
    assert kept[1]["text"] == long_text and kept[1]["n_dropped"] == 0
    placed = {r["doc_id"]: r["size"] for r in sharding.shard(docs).collect()}
    assert placed[1] == len(long_text.encode()) + 1


def test_columns_with_clashing_names(spark):
    docs = odd_docs(spark).withColumns({c: F.lit(7) for c in ("part", "sub", "hot", "size", "shard", "n", "ways")})
    rows = sharding.shard(docs).collect()
    assert Counter((r["doc_id"], r["size"]) for r in rows) == Counter((i, len((t or "").encode()) + 1) for i, t in plain_rows())
    lines = odd_docs(spark).withColumns({c: F.lit(7) for c in ("own", "node", "n", "line", "pos", "t1", "first", "dropped", "rep")})
    kept = line_templates.keep_new_lines(lines, min_documents=2)
    assert kept.columns == lines.columns and kept.count() == line_templates.keep_new_lines(odd_docs(spark), min_documents=2).count()


def test_url_filter_with_clashing_columns(spark):
    day = dt.datetime(2024, 1, 5)
    captures = spark.createDataFrame(
        [(1, "http://a.com/x", day, "h"), (2, None, day, "h"), (3, "http://b.com", None, "h"), (4, "no url", day, None)],
        "page_id long, url string, fetched timestamp_ntz, html string",
    )
    listed = spark.createDataFrame([("a.com", dt.date(2024, 1, 1), "add")], "pattern string, day date, action string")
    want = sorted(map(tuple, url_filter.judge(captures, listed).select("page_id", "blocked").collect()), key=repr)
    clashing = captures.withColumns({c: F.lit(1) for c in ("pattern", "day", "host", "valid_from", "since", "key")})
    got = url_filter.judge(clashing, listed).select("page_id", "blocked").collect()
    assert sorted(map(tuple, got), key=repr) == want and want[0] == (1, True)


def test_two_texts_under_one_number(spark):
    """All texts of the number that first has a line keep it; those of others lose it."""
    line = "a line that is in every one of these texts"
    docs = [(1, f"{line}\n{prose(1, 9)}"), (1, f"{line}\n{prose(2, 9)}")] + [(i, f"{line}\n{prose(i, 9)}") for i in range(3, 8)]
    got = line_templates.drop_recurring(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert Counter((r["doc_id"], r["n_dropped"]) for r in got) == Counter({(1, 0): 2, **{(i, 1): 1 for i in range(3, 8)}})


def test_lines_with_digits_and_any_white_space(spark):
    """White space of every kind, with and without digits in the line, and signs that look like a variable."""
    lines = [
        "\torder {i} was  sent to the\x0bhouse of the miller\r", "no\tnumber but\f\ftabs in this  line\r", "<*> stands  here without any digit",
        "<*> stands here with one {i}", "{i} 22 3{i} four", "öre {i}  ñu\t\x0bé ß \U0001f600 end{i}", "only  double   spaces are in it", " \t\x0b\f\r ", "",
        "short\t", "{i}", "a line of number {i} alone \r\t",
    ]
    docs = [(i, "\n".join(t.replace("{i}", str(i)) for t in lines[i % 3 :] + [prose(i, 9)])) for i in range(18)] + [(50, " \t\r"), (51, None)]
    got = line_templates.drop_recurring(spark.createDataFrame(docs, "doc_id long, text string")).drop("key").collect()
    want = sql_over([(*d, None, None, None) for d in docs], queries.SQL["op8_line_dedup"])
    assert sorted(map(tuple, got)) == sorted((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in want)
    assert sum(r["n_dropped"] for r in got) > 100


def test_template_tree_is_joined_once_a_level(spark, monkeypatch):
    """Each level of the tree is a table; lines that have part in no template are not grouped again."""
    plans = {}

    def noted(df, name, *rest):
        plans.setdefault(name, []).append(df._jdf.queryExecution().optimizedPlan().toString())
        return written(df, name, *rest)

    monkeypatch.setattr(line_templates, "written", noted)
    docs = [(i, f"we thank number {i} for the gift\n{prose(i, 9)}") for i in range(8)]
    got = line_templates.drop_recurring(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sum(r["n_dropped"] for r in got) == 7
    assert [p.count("Join ") for p in plans["tree"] + plans["leaves"]] == [1] * line_templates.DEPTH
    assert "coalesce(shape" not in plans["recurring-lines"][0]


def test_pipeline_on_odd_rows(spark, tmp_path, long_text):
    rows = [(i, t, "en", None if i == 3 else "s", 1, "k", 2) for i, t in plain_rows()]
    rows += [(500 + i, prose(500 + i, 120), None, f"s{i % 3}", None, None, None) for i in range(30)]
    rows += [(600, long_text, "de", "s1", 1, "k", 2)]
    spark.createDataFrame(rows, DOCUMENTS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in pieces} <= {r[0] for r in rows}
    used = Counter()
    for r in pieces:
        used[r["sequence_id"]] += r["length"]
    assert used and max(used.values()) <= 2048


def test_pipeline_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], DOCUMENTS).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
