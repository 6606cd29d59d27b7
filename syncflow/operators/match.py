"""Weighted set similarity between jobs and candidates, by feature."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from syncflow import storage
from syncflow.functions.classify import COMBINED_MATCH_TIERS, SINGLE_MATCH_TIERS, tier

# Prefix of the features that count extra, their extra weight, and the
# shares of the two parts of the combined score.
SINK_PREFIX = "sink_table:"
SINK_BONUS = 0.5
COMBINED_WEIGHTS = (0.6, 0.4)

# Rarest features of a set from which its lower bound comes.
PROBES = 3

# Bytes of an index of candidates that every task may hold; rows met by feature that a task works on.
INDEX_BYTES = 64 << 20
MET_ROWS = 4_000_000


def _hits(is_sink: Column) -> list[Column]:
    return [F.count(F.lit(1)).alias("shared"), F.count_if(is_sink).alias("shared_sinks")]


def _index(candidates: DataFrame, candidate: str, feature: str) -> DataFrame:
    """candidate, feature and ``candidate_size``, written once; candidates without a name are left out."""
    held = candidates.select(candidate, feature).where(F.col(candidate).isNotNull()).distinct()
    sizes = held.groupBy(candidate).agg(F.count(F.lit(1)).alias("candidate_size"))
    return storage.written(held.where(F.col(feature).isNotNull()).join(sizes, candidate), "candidates")


def _at_hand(index: DataFrame, feature: str) -> Callable[[DataFrame], DataFrame]:
    """How tasks get the index, or less: whole up to ``INDEX_BYTES``, else as the planner sees fit."""
    size = index.agg(F.sum(F.octet_length(feature) + 64)).first()[0] or 0
    return F.broadcast if size <= INDEX_BYTES else lambda df: df


def _sets(jobs: DataFrame, index: DataFrame, hand: Callable, job: str, feature: str) -> DataFrame:
    """Features of each job; jobs are dealt out once, and what follows stays where its job is.

    A task has as many jobs as meet ``MET_ROWS`` candidates by a feature, so what it sorts and groups
    fits its memory. Jobs without a name are left out.
    """
    rows = jobs.select(job, feature).where(F.col(job).isNotNull() & F.col(feature).isNotNull())
    held = hand(index.groupBy(feature).agg(F.count(F.lit(1)).alias("_n")))
    met = rows.join(held, feature).agg(F.sum("_n")).first()[0] or 0
    parts = max(jobs.sparkSession.sparkContext.defaultParallelism, -(-met // MET_ROWS))
    return rows.repartition(parts, job).groupBy(job).agg(F.collect_set(feature).alias("features"))


def _counted(met: DataFrame, job: str, candidate: str, feature: str) -> DataFrame:
    """What each job shares with each candidate that it met, one row a feature, and the score."""
    pairs = met.groupBy(job, "job_size", candidate, "candidate_size").agg(*_hits(F.col(feature).startswith(SINK_PREFIX)))
    united = F.col("job_size") + F.col("candidate_size") - F.col("shared")
    return pairs.select(
        job, candidate, "shared", "shared_sinks", _score(F.col("shared"), F.col("shared_sinks"), united).alias("score"),
        united.alias("united"),
    )


def match_candidates(
    jobs: DataFrame,
    candidates: DataFrame,
    job: str = "job",
    candidate: str = "candidate",
    feature: str = "feature",
) -> DataFrame:
    """Ranked candidates of every job: (shared + sink bonus) / united features."""
    index = _index(candidates, candidate, feature)
    hand = _at_hand(index, feature)
    sets = _sets(jobs, index, hand, job, feature)
    # An equi-join on the feature: pairs without a shared feature would score 0 and are not reported.
    met = sets.select(job, F.size("features").alias("job_size"), F.explode("features").alias(feature)).join(hand(index), feature)
    scored = _counted(met, job, candidate, feature)
    # Doubled, so that the half bonus stays an integer and rounding is exact.
    doubled = 2 * F.col("shared") + F.col("shared_sinks")
    percent = F.floor((200 * doubled + 2 * F.col("united")) / (4 * F.col("united")))
    best_first = Window.partitionBy(job).orderBy(F.desc("score"), F.asc(candidate))
    # The tier goes by the reported score, which has two decimals.
    return scored.withColumn("tier", tier(percent / 100, SINGLE_MATCH_TIERS, "poor")).select(
        job, candidate, "shared", "shared_sinks", "score", "tier", F.row_number().over(best_first).alias("rank")
    )


def _score(shared: Column, sinks: Column, united: Column) -> Column:
    return (2 * shared + sinks) / (2 * united)


def best_pairs(kinds: DataFrame, candidates: DataFrame, candidate: str, feature: str) -> DataFrame:
    """set, candidate: the pairs that may be the best of a set (set, features); never less than the best.

    Two steps, neither of which counts what all pairs share:

    1. Any candidate of a set gives a lower bound of its best score. The first one of each of the set's
       ``PROBES`` rarest features is scored.
    2. A set's features are taken rarest first. A candidate that shares none of the first p can only share the
       r others, s of them sinks, so it scores (2r + s) / (2 (n + m - r)) at most, n and m being the
       sizes. A feature is looked up only for candidates that are small enough for that bound to reach the
       set's lower bound; for most sets, the frequent features are looked up for none.
    """
    index = _index(candidates, candidate, feature)
    return _best_pairs(kinds, index, _at_hand(index, feature), candidate, feature)


def _best_pairs(kinds: DataFrame, index: DataFrame, hand: Callable, candidate: str, feature: str) -> DataFrame:
    is_sink = F.col(feature).startswith(SINK_PREFIX)
    known = hand(index.groupBy(feature).agg(F.count(F.lit(1)).alias("n"), F.min(candidate).alias("some")))
    of_set = Window.partitionBy("set")
    rarest = of_set.orderBy("n", feature)
    following = rarest.rowsBetween(0, Window.unboundedFollowing)
    looked = (
        kinds.select("set", F.size("features").alias("job_size"), F.explode("features").alias(feature))
        .join(known, feature)
        .withColumn("left", F.count(F.lit(1)).over(following))
        .withColumn("left_sinks", F.count_if(is_sink).over(following))
        .withColumn("nth", F.row_number().over(rarest))
    )
    probes = F.collect_set(F.when(F.col("nth") <= PROBES, F.col("some"))).over(of_set)
    tried = looked.select("set", "job_size", feature, probes.alias("_probes"))
    tried = tried.select("set", "job_size", feature, F.explode("_probes").alias(candidate)).join(hand(index), [feature, candidate])
    least = _counted(tried, "set", candidate, feature).groupBy("set").agg(F.max("score").alias("least"))
    # The largest size for which the bound reaches the lower bound, with room for rounding.
    most = (2 * F.col("left") + F.col("left_sinks")) / (2 * F.col("least") * (1 - 1e-9)) - F.col("job_size") + F.col("left")
    wanted = looked.join(least, "set").withColumn("most", most).where(
        # A candidate that holds all r others has r features at least.
        F.col("most") >= 1
    )
    reach = wanted.select("set", F.col(feature).alias("_feature"), "most", "left")
    met = reach.join(
        hand(index),
        (F.col("_feature") == F.col(feature)) & (F.col("candidate_size") <= F.greatest("most", F.col("left").cast("double"))),
    )
    return met.select("set", candidate).distinct()


def best_candidates(
    jobs: DataFrame,
    candidates: DataFrame,
    job: str = "job",
    candidate: str = "candidate",
    feature: str = "feature",
) -> DataFrame:
    """The first candidate of every job, which is what a recovery takes: the highest score, then the
    first name. Only pairs that can be the best are compared (``best_pairs``)."""
    index = _index(candidates.where(F.col(feature).isNotNull()), candidate, feature)
    hand = _at_hand(index, feature)
    kinds = _sets(jobs, index, hand, job, feature).withColumnRenamed(job, "set")
    pairs = _best_pairs(kinds, index, hand, candidate, feature)
    # What a pair shares is counted feature by feature: a candidate may have any number of them.
    tried = pairs.join(kinds, "set").select("set", candidate, F.size("features").alias("job_size"), F.explode("features").alias(feature))
    scored = _counted(tried.join(hand(index), [feature, candidate]), "set", candidate, feature)
    # By the highest score, then the first name: the smallest of (-score, name).
    best = scored.groupBy("set").agg(
        F.min(F.struct((-F.col("score")).alias("at"), candidate, "shared", "shared_sinks", "score")).alias("best")
    )
    return best.select(
        F.col("set").alias(job), *[F.col(f"best.{c}").alias(c) for c in (candidate, "shared", "shared_sinks", "score")]
    )


def match_combined(
    jobs: DataFrame,
    candidates: DataFrame,
    candidate: str = "candidate",
    feature: str = "feature",
) -> DataFrame:
    """Candidates against the united features of all jobs, with the share of sinks covered."""
    a = jobs.select(feature).where(F.col(feature).isNotNull()).distinct()
    b = candidates.select(candidate, feature).distinct()
    is_sink = F.col(feature).startswith(SINK_PREFIX)
    totals = a.agg(F.struct(F.count(F.lit(1)).alias("n"), F.count_if(is_sink).alias("sinks"))).scalar()
    size_a, sinks_a = totals.getField("n"), totals.getField("sinks")
    size_b = b.groupBy(candidate).agg(F.count(F.lit(1)).alias("candidate_size"))
    hits = a.join(b, feature).groupBy(candidate).agg(*_hits(is_sink))
    base = F.col("shared") / (size_a + F.col("candidate_size") - F.col("shared"))
    coverage = F.when(sinks_a > 0, F.col("shared_sinks") / sinks_a).otherwise(F.lit(0.0))
    weight_base, weight_sinks = COMBINED_WEIGHTS
    return (
        hits.join(size_b, candidate)
        .withColumn("base_score", base)
        .withColumn("sink_coverage", coverage)
        .withColumn("score", F.col("base_score") * weight_base + F.col("sink_coverage") * weight_sinks)
        .withColumn("tier", tier(F.col("score"), COMBINED_MATCH_TIERS, "low"))
        .select(
            candidate, "shared", "shared_sinks", "base_score", "sink_coverage", "score", "tier"
        )
    )
