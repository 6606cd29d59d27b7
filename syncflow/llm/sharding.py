"""Sharding by sampled splitters: near equal bytes per shard, equal texts kept together.

Records are ordered by a key, the hash of their text, so that equal texts are neighbours. A
size-weighted sample of keys gives quantile boundaries, the records are range-partitioned by them,
and an overfull range is subdivided: by key, and by document for a key that overfills it alone. Bytes are
then summed per part, exactly, and a record's place in that running sum gives its shard: a text whose
copies are at most ``WHOLE_GROUP`` of a shard goes whole to the shard in which their middle lies, larger
groups are cut where the shard is full. So shards differ by at most about one such group.

The law that holds is ``bytes``. DataFrame functions only. There are at most ``MAX_RANGES`` ranges, and as
many hot keys and subdivisions; what is broadcast is a row for each of them, 200,000 rows of some 50 bytes at
most. Tables too large for that many ranges have larger ranges.

Results for odd input: a NULL text counts as empty (size 1) and a NULL document number sorts first;
repeated rows take a slot each; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import pick, written

ROWS_PER_RANGE = 10_000
MAX_RANGES = 1 << 16  # so that the ranges can be broadcast: 131,072 rows of 20 bytes at most
SAMPLES_PER_RANGE = 20
WHOLE_GROUP = 0.01  # of a shard: groups up to this size are never cut
_CELLS = 1 << 16


def _cell(key: Column) -> Column:
    return F.shiftright(key, 48).cast("int")


def splitters(records: DataFrame, ranges: int) -> list[int]:
    """Boundaries that part the bytes of ``records`` (key, doc_id, size) about evenly.

    A record is drawn with a probability that grows with its size, so every draw stands for the same
    bytes. A key drawn for several boundaries is hot: it gets a range to itself.
    """
    total, count = records.agg(F.sum("size"), F.count("*")).first()
    if not count or ranges < 2:
        return []
    per_draw = max(total / (ranges * SAMPLES_PER_RANGE), 1.0)
    chance = F.pmod(F.xxhash64("key", "doc_id", "size"), F.lit(1 << 53)) / F.lit(float(1 << 53))
    draws = F.floor(F.col("size") / F.lit(per_draw) + chance).cast("int")
    drawn = records.select("key", draws.alias("n")).where("n > 0").groupBy("key").agg(F.sum("n").alias("n"))
    at = F.sum("n").over(Window.orderBy("key").rowsBetween(Window.unboundedPreceding, 0))
    upto = drawn.select("key", "n", at.alias("upto"))  # a few draws a range: small beside the records
    edge = F.floor(F.col("upto") / F.lit(SAMPLES_PER_RANGE)) - F.floor((F.col("upto") - F.col("n")) / F.lit(SAMPLES_PER_RANGE))
    bounds = set()
    for row in upto.select("key", edge.alias("edges")).where("edges > 0").collect():
        bounds.add(row["key"])
        if row["edges"] > 1 and row["key"] < 2**63 - 1:
            bounds.add(row["key"] + 1)
    return sorted(bounds)


def _ranged(records: DataFrame, bounds: list[int]) -> DataFrame:
    """``records`` with the number of their range: a join on the leading bits of the key."""
    spark = records.sparkSession
    rows = list(enumerate(zip([-(2**63), *bounds], [*(b - 1 for b in bounds), 2**63 - 1], strict=True)))
    ranges = spark.createDataFrame([(i, lo, hi) for i, (lo, hi) in rows], "part int, lo long, hi long")
    cells = ranges.withColumn("cell", F.explode(F.sequence(_cell(F.col("lo")), _cell(F.col("hi")))))
    inside = (F.col("cell") == _cell(F.col("key"))) & F.col("key").between(F.col("lo"), F.col("hi"))
    return records.join(F.broadcast(cells), inside).drop("cell", "lo", "hi")


def shard(
    docs: DataFrame, shards: int = 8, rows_per_range: int = ROWS_PER_RANGE, whole_group: float = WHOLE_GROUP
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard and slot (gapless from 0 in its shard) of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    records = written(
        pick(docs, "doc_id", "text").select(
            F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("key"),
        ), "records",
    )
    total, count = records.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    ranged = _ranged(records, splitters(records, min(count // rows_per_range + 1, MAX_RANGES)))

    # A range above twice its rows is dealt out to several tasks by key, so that equal texts stay together;
    # a key that fills a range alone has tasks of its own, by document. Either kind has MAX_RANGES at most.
    wide = max(rows_per_range, -(-count // MAX_RANGES))
    hot = ranged.groupBy("part", "key").agg(F.count("*").alias("key_rows"), F.sum("size").alias("key_bytes"))
    hot = written(hot.where(F.col("key_rows") > wide).withColumn("hot", F.col("key")), "hot")
    fill = ranged.groupBy("part").agg(F.count("*").alias("n"))
    deal = fill.select("part", F.ceil(F.col("n") / F.lit(2.0 * wide)).alias("ways"))
    document = F.coalesce("doc_id", F.monotonically_increasing_id())  # where there is none, any will do
    dealt = ranged.join(F.broadcast(deal), "part").join(F.broadcast(hot), ["part", "key"], "left").withColumn(
        "sub", F.pmod(F.xxhash64(F.when(F.col("hot").isNull(), F.col("key")).otherwise(document)), F.col("ways"))
    )
    dealt = written(dealt, "ranges")

    by = ["part", "hot", "sub"]
    sums = dealt.groupBy(*by).agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    so_far = Window.orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    first = sums.select(  # one row for each task: three for each range at most
        *by, F.coalesce(F.sum("bytes").over(so_far), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("n").over(so_far), F.lit(0)).alias("rows_before"),
    ).withColumn("hot_before", F.min("bytes_before").over(Window.partitionBy("part", "hot")))
    first = first.toDF("in_part", "in_hot", "in_sub", "bytes_before", "rows_before", "hot_before")
    here = (F.col("part") == F.col("in_part")) & F.col("hot").eqNullSafe(F.col("in_hot")) & (F.col("sub") == F.col("in_sub"))
    inner = Window.partitionBy(*by)
    order = inner.orderBy("key", "doc_id", "text_crc32", "size")
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    group = Window.partitionBy(*by, "key")
    share = total / shards
    placed = (
        dealt.withColumn("before", F.coalesce(F.sum("size").over(upto), F.lit(0)))
        .withColumn("nth", F.row_number().over(order) - 1)
        .withColumn("group_start", F.min("before").over(group))
        .withColumn("group_bytes", F.sum("size").over(group))
        .join(F.broadcast(first), here)
    )
    is_hot = F.col("hot").isNotNull()
    group_bytes = F.when(is_hot, F.col("key_bytes")).otherwise(F.col("group_bytes"))
    group_start = F.when(is_hot, F.col("hot_before")).otherwise(F.col("bytes_before") + F.col("group_start"))
    middle = F.when(group_bytes <= F.lit(share * whole_group), group_start + group_bytes / 2).otherwise(
        F.col("bytes_before") + F.col("before") + F.col("size") / 2
    )
    numbered = placed.select(
        "doc_id", "size", "text_crc32",
        F.least(F.floor(middle * F.lit(shards) / F.lit(total)), F.lit(shards - 1)).cast("int").alias("shard"),
        (F.col("rows_before") + F.col("nth")).alias("nth"),
    )
    numbered = written(numbered, "placed")
    starts = numbered.groupBy("shard").agg(F.min("nth").alias("start"))
    return numbered.join(F.broadcast(starts), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("nth") - F.col("start")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
