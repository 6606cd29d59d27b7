"""The corpus pipeline: five operators, each working on all that the one before it kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of ``documents``. Stages are written as Parquet in the shared folder and read again by the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from syncflow.llm import line_templates, mixing, ngram_join, packing, quality
from syncflow.llm.common import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that very many texts of a host hold go, and so do documents that fail the rules or are depleted."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of templates that recur go, except in the first document that has them."""
    return line_templates.keep_new_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles link at 0.8 or more stays."""
    return ngram_join.keep_one(docs, n=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are sampled so that sources, languages and topics meet their targets."""
    return mixing.keep_sample(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of the documents left and its place in a sequence of 2048 tokens."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules), ("line_dedup", line_dedup), ("ngram_join", near_dedup),
    ("mixing", mix_sources), ("packing", pack),
]
#: SQL cannot tokenise; the stages are tested one by one instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
SQL: dict[str, str] = {}
