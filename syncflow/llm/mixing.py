"""Mixing sources to target weights by iterative proportional fitting (raking).

The tokens of the documents are summed by cell: source, language and topic. Each round scales the
cells so that the marginals of one dimension after the other meet their targets. After ``ROUNDS`` rounds
it goes on until no marginal is off by more than ``TOLERANCE`` of all tokens, or rounds no longer bring them
nearer: targets that no weights can meet never get there, and a warning says by how much they are missed.
A cell's fitted share
over its own share, relative to the largest such ratio, is the probability with which its documents
are sampled, so the sample has the target mixture and no document is needed twice. Draws depend on
``doc_id`` and the seed alone.

Targets of a dimension are shares by value, or a number t: shares in proportion to the natural ones
to the power t. Values without a given share divide what is left by their tokens; shares of values that
are absent go to the others in proportion.

DataFrame functions only. Sums are combined ahead of each shuffle, so one cell may hold any part of
the rows; cells stay in tables, and the driver gets sums over a whole dimension.

Results for odd input: NULL is a value like others; a text without tokens (NULL, empty) weighs nothing
and is never sampled; repeated rows are sampled alike; an empty table gives an empty result.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick, plain, written

ROUNDS = 6  # at least
MOST_ROUNDS = 200
TOLERANCE = 1e-4
PATIENCE = 40  # rounds in which the error has to fall; it may stay for some while weights wander far
SEED = 17
DIMENSIONS = ("source", "lang", "topic")
TARGETS: dict[str, Mapping[str, float] | float] = {
    "source": 0.9, "lang": {"en": 0.58, "de": 0.16, "fr": 0.16, "es": 0.1}, "topic": 0.97,
}
_NULL = "\0"  # stands for NULL inside; no value can hold it


def token_count(text: str) -> Column:
    """Words, as runs of anything but ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit("[^ \\t\\n\\x0B\\f\\r]+")), F.lit(0)).cast("long")


def topic_of(text: str) -> Column:
    """A coarse topic by plain signs: ``legal``, ``markup``, ``contact`` or ``prose``."""
    signs = F.length(text) - F.length(F.translate(F.col(text), "#*$%&|<>", ""))
    return (
        F.when(F.regexp_like(text, F.lit("(License|Licence|Copyright)")), "legal")
        .when(signs * 20 > F.length(text), "markup")
        .when(F.regexp_like(text, F.lit("[A-Za-z0-9]@[A-Za-z0-9]")), "contact")
        .otherwise("prose")
    )


def weighed(docs: DataFrame, at: Mapping[str, str]) -> DataFrame:
    """``docs`` with the cell of each document in d_source, d_lang, d_topic, and its tokens.

    ``at`` names the columns that hold source, lang and text, and topic; without one, plain signs in the text
    stand for it.
    """
    given = [c for c in DIMENSIONS if c in at]
    cells = {f"d_{c}": F.coalesce(F.col(at[c]).cast("string"), F.lit(_NULL)) for c in given}
    return docs.withColumns({"d_topic": topic_of(at["text"])} | cells | {"tokens": token_count(at["text"])})


def _target(cells: DataFrame, dim: str, wanted: Mapping[str, float] | float) -> DataFrame:
    """(dim, target): shares that add up to 1 over the values that have tokens."""
    natural = cells.groupBy(dim).agg(F.sum("weight").alias("natural"))
    if isinstance(wanted, Mapping):
        given = F.lit(None).cast("double")
        for value, share in wanted.items():
            given = F.when(F.col(dim) == value, F.lit(float(share))).otherwise(given)
        natural = natural.withColumn("given", given)
        open_part = natural.where("given is null").agg(F.sum("natural")).first()[0] or 1.0
        rest = max(0.0, 1.0 - sum(wanted.values()))
        raw = F.coalesce("given", F.col("natural") * F.lit(rest / open_part))
    else:
        raw = F.pow("natural", F.lit(float(wanted)))
    natural = natural.withColumn("raw", raw)
    total = natural.agg(F.sum("raw")).first()[0] or 1.0
    return natural.select(dim, (F.col("raw") / F.lit(total)).alias("target"))


def _largest_error(fitted: DataFrame, wanted: Mapping[str, DataFrame]) -> float:
    """The largest difference between a marginal and its target: one number to the driver."""
    errors = [
        fitted.groupBy(d).agg(F.sum("weight").alias("now")).join(target, d).select(F.abs(F.col("now") - F.col("target")).alias("error"))
        for d, target in wanted.items()
    ]
    return reduce(DataFrame.union, errors).agg(F.max("error")).first()[0] or 0.0


def rake(
    cells: DataFrame, targets: Mapping[str, Mapping[str, float] | float], rounds: int = ROUNDS,
    most: int = MOST_ROUNDS, tolerance: float = TOLERANCE, patience: int = PATIENCE,
) -> DataFrame:
    """``cells`` (one column per dimension, ``tokens`` above 0) with the fitted ``weight``."""
    dims = list(targets)
    total = cells.agg(F.sum("tokens")).first()[0] or 1
    fitted = written(cells.withColumn("weight", F.col("tokens") / F.lit(float(total))), "cells")
    wanted = {d: written(_target(fitted, d, targets[d]), f"target-{d}") for d in dims}
    error = least = float("inf")
    fell = 0
    for done in range(1, max(rounds, most) + 1):
        for d in dims:
            now = fitted.groupBy(d).agg(F.sum("weight").alias("now"))
            # A value whose cells have all been scaled to nothing cannot meet its target.
            ratio = F.when(F.col("now") > 0, F.try_divide("target", "now")).otherwise(0.0)
            scale = now.join(wanted[d], d).select(d, ratio.alias("scale"))
            fitted = fitted.join(scale, d).select(
                *dims, "tokens", (F.col("weight") * F.col("scale")).alias("weight")
            )
        fitted = written(fitted, "cells")
        if done >= rounds:
            error = _largest_error(fitted, wanted)
            if error < 0.999 * least:
                least, fell = error, done
            if error <= tolerance or done - fell >= patience:
                break
    if error > tolerance:
        warnings.warn(f"raking is off by {error:.2g} of all tokens after {done} rounds", stacklevel=2)
    return fitted


def chances(
    rows: DataFrame, targets: Mapping[str, Mapping[str, float] | float] = TARGETS, rounds: int = ROUNDS
) -> DataFrame:
    """(d_source, d_lang, d_topic, chance): the probability of the documents of each cell."""
    dims = {f"d_{d}": wanted for d, wanted in targets.items()}
    sums = rows.groupBy(*dims).agg(F.sum("tokens").alias("tokens")).where("tokens > 0")
    fitted = rake(written(sums, "token-sums"), dims, rounds)
    ratio = F.col("weight") / F.col("tokens")
    most = fitted.agg(F.max(ratio)).first()[0] or 1.0
    return fitted.select(*dims, (ratio / F.lit(most)).alias("chance"))


def draw(doc_id: str, seed: int = SEED) -> Column:
    """A number in [0, 1) from the document's number and the seed."""
    name = F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, 12), 16, 10).cast("long") / F.lit(float(1 << 48))


def sample(
    docs: DataFrame, targets: Mapping[str, Mapping[str, float] | float] = TARGETS, rounds: int = ROUNDS,
    seed: int = SEED, topic: str | None = None,
) -> DataFrame:
    """doc_id, source, lang, topic, tokens, chance and ``sampled`` for every document.

    ``topic`` names the column that holds it, if there is one.
    """
    names = ("doc_id", "text", "source", "lang")
    if topic:
        docs = docs.withColumnRenamed(topic, "topic")
        names = (*names, "topic")
    held = written(weighed(pick(docs, *names), dict(zip(names, names, strict=True))).drop("text"), "weighed")
    joined = held.join(chances(held, targets, rounds), [f"d_{d}" for d in targets], "left")
    chance = F.coalesce("chance", F.lit(0.0))
    return joined.select(
        "doc_id", "source", "lang", F.col("d_topic").alias("topic"), "tokens", chance.alias("chance"),
        ((F.col("tokens") > 0) & (draw("doc_id", seed) < chance)).alias("sampled"),
    )


def keep_sample(docs: DataFrame, seed: int = SEED, topic: str | None = None, **options) -> DataFrame:
    """The sampled documents, with the columns they have; ``topic`` names the one that holds their topic."""
    rows, at = plain(docs, "doc_id", "text", "source", "lang", *[topic] * bool(topic))
    if topic:
        at["topic"] = at[topic]
    cells = weighed(rows, at)
    fitted = chances(cells.select("d_source", "d_lang", "d_topic", "tokens"), **options)
    drawn = cells.join(fitted, ["d_source", "d_lang", "d_topic"]).where(
        (F.col("tokens") > 0) & (draw(at["doc_id"], seed) < F.col("chance"))
    )
    return drawn.select(*rows.columns).toDF(*docs.columns)
