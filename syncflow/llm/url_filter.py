"""URL filters by temporal list join.

A list is a log of dated entries: a pattern was added or removed on a day. Entries become validity
intervals, and every capture is judged by the entries that were active on the day it was fetched: an
as-of join. A pattern is a domain (``example.org``, which covers its subdomains) or a host with path
segments (``www.example.org/a/b``, which covers what lies below).

The as-of join works on distinct (pattern, day) pairs, in which a pattern has one row a day however
many captures a host has; only the equality join back meets the captures themselves.

Results for odd input: a capture without a URL, without a host or without a time is not blocked; an
entry without pattern or day is void; of several entries for one pattern and day an addition wins;
hosts compare without case, and a trailing dot, a port and user names play no part; repeated rows are
judged alike; with an empty list nothing is blocked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import pick, row_key, written


def host_of(url: str) -> Column:
    found = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.regexp_replace(F.lower(found), r"\.$", "")


def path_of(url: str) -> Column:
    """Path segments, without those that are empty."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    return F.filter(F.split(path, "/"), lambda s: s != "")


def _keys(host: str, segments: str, depth: Column) -> Column:
    """The patterns that would cover a URL: its domains, and its host with leading segments."""
    labels = F.split(F.col(host), r"\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    longest = F.least(F.size(segments), depth)
    paths = F.transform(
        F.sequence(F.lit(1), F.greatest(longest, F.lit(1))),
        lambda i: F.concat_ws("/", F.col(host), F.array_join(F.slice(segments, 1, i), "/")),
    )
    return F.when(longest > 0, F.concat(domains, paths)).otherwise(domains)


def daily(entries: DataFrame) -> DataFrame:
    """(pattern, day, is_added): one entry for each pattern and day."""
    rows = pick(entries, "pattern", "day", "action").where("pattern is not null and day is not null")
    added = F.max(F.coalesce(F.col("action") == "add", F.lit(False)))
    return rows.groupBy(F.lower("pattern").alias("pattern"), F.to_date("day").alias("day")).agg(
        added.alias("is_added")
    )


def intervals(entries: DataFrame) -> DataFrame:
    """(pattern, valid_from, valid_to): days on which a pattern is listed; valid_to is exclusive."""
    later = F.lead("day").over(Window.partitionBy("pattern").orderBy("day"))
    held = daily(entries).withColumn("valid_to", later)
    return held.where("is_added").select("pattern", F.col("day").alias("valid_from"), "valid_to")


def active(probes: DataFrame, entries: DataFrame) -> DataFrame:
    """(pattern, day, since): the probes (pattern, day) at which the pattern is listed.

    As-of join: the last interval that began by the day counts, if it has not ended.
    """
    begun = intervals(entries).select(
        "pattern", F.col("valid_from").alias("day"), F.struct("valid_from", "valid_to").alias("interval"),
    )
    both = begun.unionByName(probes.select("pattern", "day"), allowMissingColumns=True)
    order = Window.partitionBy("pattern").orderBy("day", F.col("interval").isNull())
    last = F.last("interval", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return (
        both.withColumn("last", last).where("interval is null and last is not null")
        .where("last.valid_to is null or day < last.valid_to")
        .select("pattern", "day", F.col("last.valid_from").alias("since"))
    )


def judge(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """page_id, url, day, blocked, pattern (the longest that covers it) and since, for each capture.

    ``captures`` has page_id, url and fetched; ``entries`` has pattern, day and action (add, remove).
    """
    rows = pick(captures, "page_id", "url", "fetched").withColumn("day", F.to_date("fetched"))
    rows = written(rows.withColumn("key", row_key("page_id", "url", "day")).drop("fetched"), "captures")
    listed = written(entries.select("pattern", "day", "action"), "entries")
    parts = F.size(F.split("pattern", "/")) - 1
    depth = listed.agg(F.max(parts)).first()[0] or 0  # what the longest pattern needs
    parsed = rows.select("key", "day", host_of("url").alias("host"), path_of("url").alias("path"))
    covered = parsed.where("host <> '' and day is not null").select(
        "key", "day", F.explode(_keys("host", "path", F.lit(depth))).alias("pattern")
    ).distinct()
    known = listed.select(F.lower("pattern").alias("pattern")).distinct()
    covered = written(covered.join(known, "pattern"), "covered")
    hits = covered.join(active(covered.select("pattern", "day").distinct(), listed), ["pattern", "day"])
    best = hits.groupBy("key").agg(
        F.max(F.struct(F.length("pattern").alias("n"), "pattern", "since")).alias("hit")
    )
    return rows.join(best, "key", "left").select(
        "page_id", "url", "day", F.col("hit").isNotNull().alias("blocked"),
        F.col("hit.pattern").alias("pattern"), F.col("hit.since").alias("since"),
    )
