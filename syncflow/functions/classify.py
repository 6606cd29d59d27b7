"""Ordered keyword classification and score tiers as plain CASE expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from syncflow.functions.times import as_col

# The first rule with a matching keyword names the job type.
JOB_TYPE_RULES = (
    (("kafka",), "kafka"),
    (("mysql", "cdc"), "mysql_cdc"),
    (("doris",), "doris"),
)

# Lower bounds of the match tiers, best first.
SINGLE_MATCH_TIERS = ((0.8, "excellent"), (0.6, "good"), (0.3, "fair"))
COMBINED_MATCH_TIERS = ((0.8, "high"), (0.6, "good"), (0.4, "medium"))


def classify(col, rules: Sequence = JOB_TYPE_RULES, default: str = "unknown") -> Column:
    """First rule of which a keyword occurs in the text, case-insensitively."""
    text = F.lower(as_col(col))
    out = F.lit(default)
    for keywords, label in reversed(rules):
        hit = F.lit(False)
        for word in keywords:
            hit = hit | text.contains(word.lower())
        out = F.when(hit, F.lit(label)).otherwise(out)
    return out


def tier(score: Column, bounds: Sequence, lowest: str) -> Column:
    """Name of the first tier whose lower bound the score reaches."""
    out = F.lit(lowest)
    for bound, label in sorted(bounds):
        out = F.when(score >= F.lit(bound), F.lit(label)).otherwise(out)
    return out
