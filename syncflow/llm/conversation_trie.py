"""Prefix trie of conversations, rolled up by bands of depth.

A node is a sequence of first turns that some conversation begins with. It is named by its depth and two
sums, over its turns, of 64-bit hashes of (place, role, text): sums of different sequences differ but
with a chance of some 2^-100, they are running totals, so no task has to walk a conversation, and a
conversation knows the names of all its nodes.

Totals over subtrees go by bands of ``BAND`` depths. The root of a band's tree is a node whose depth is a
multiple of ``BAND``.

1. Each band root gets the sum over its tree within the band: one aggregation by band root.
2. Band roots are the nodes of a smaller trie, ``BAND`` times less deep, whose totals are found in the
   same way; so a trie of depth d takes log(d) / log(BAND) rounds, one for d < BAND.
3. The total of a band root is added to the node above it, and then every node sends its sum to its
   ancestors within its band, ``BAND`` rows at most, which are added up ahead of the shuffle.

Turns of a conversation are ordered by ranges, running totals are taken in pieces of ``PIECE`` turns and
over the pieces in the same way, so one conversation may hold any share of the rows. A node may have any
number of members and children: they are counted ahead of the shuffle, and parents with very many
children, of which there can only be ``HOT`` at most, are broadcast to them.

Results for odd input: rows without a conv_id belong to no conversation and are left out; turns without a
number come first; a role or text that is NULL counts as empty; turns of one number are ordered by role and
text, repeated rows count as turns of their own; a conversation without turns ends at the root. An empty
table gives no nodes, not even the root.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from syncflow.operators import ordered

from .common import pick, written

BAND = 8
PIECE = 1024  # turns of a conversation whose running totals are taken in one window
HOT = 1000  # parents, at most, that are broadcast to their children
NAME = ["depth", "k1", "k2"]


def ordered_turns(table: DataFrame) -> DataFrame:
    """conv_id, index (from 0), role, text-free columns of every turn: hashes ``r``, ``t`` and ``points``."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = pick(table, "conv_id", "turn", "role", "text").where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
        F.substring(text, 1, 64).alias("head"), F.xxhash64(F.lit(1), role, text).alias("h1"),
        F.xxhash64(F.lit(2), text, role, F.length(text)).alias("h2"), F.length(text).cast("long").alias("points"),
    )
    placed = ordered.in_order(rows, "conv_id", "turn", "role", "head", "h1").drop("turn", "role", "head")
    return ordered.numbered(placed, "conv_id", name="index").select("conv_id", "index", "h1", "h2", "points")


def rebased(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """conv_id, depth (from 1), h1, h2, points: the first turns of each conversation's base, then its own.

    ``conversations`` has conv_id, base (a conv_id) and heads (how many turns come from the base; as many
    of its own first turns are left out). A base gives no more turns than it has.
    """
    most = conversations.agg(F.max("heads")).first()[0] or 0
    first = turns.where(F.col("index") < most)
    heads = first.join(
        conversations.select(F.col("conv_id").alias("for"), F.col("base").alias("conv_id"), "heads"), "conv_id"
    ).where("index < heads").select(F.col("for").alias("conv_id"), (F.col("index") + 1).alias("depth"), "h1", "h2", "points")
    size = first.groupBy("conv_id").agg(F.count("*").alias("size")).toDF("base", "size")
    given = conversations.join(size, "base", "left").select(
        "conv_id", "heads", F.least("heads", F.coalesce("size", F.lit(0))).alias("given")
    )
    # By pieces, so that the turns of one long conversation meet its row in many tasks.
    piece = F.call_function("div", F.col("index"), F.lit(PIECE)).alias("piece")
    pieces = turns.groupBy("conv_id", piece).agg(F.count("*").alias("n")).join(given, "conv_id").drop("n")
    own = turns.withColumn("piece", piece).join(pieces, ["conv_id", "piece"]).where("index >= heads").select(
        "conv_id", (F.col("index") - F.col("heads") + F.col("given") + 1).alias("depth"), "h1", "h2", "points"
    )
    return heads.unionByName(own)


def running(rows: DataFrame, key: str, order: str, columns: Sequence[str]) -> DataFrame:
    """``rows`` with each column as its total up to the row, along ``order`` (whole, from 0, no gaps matter).

    Windows hold ``PIECE`` places; totals of pieces are summed up in the same way.
    """
    window = Window.partitionBy(key, "_piece").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    piece = F.call_function("div", F.col(order), F.lit(PIECE))
    cut = rows.withColumn("_piece", piece)
    within = cut.select(
        *[c for c in cut.columns if c not in columns], *[F.sum(c).over(window).alias(c) for c in columns]
    )
    if (rows.agg(F.max(order)).first()[0] or 0) < PIECE:
        return within.drop("_piece").select(*rows.columns)
    totals = cut.groupBy(key, F.col("_piece").alias("_nth")).agg(*[F.sum(c).alias(c) for c in columns])
    until = running(totals, key, "_nth", columns).select(
        key, (F.col("_nth") + 1).alias("_piece"), *[F.col(c).alias(f"_{c}") for c in columns]
    )
    return within.join(until, [key, "_piece"], "left").select(
        *[
            (F.col(c) + F.coalesce(F.col(f"_{c}"), F.lit(0))).alias(c) if c in columns else F.col(c)
            for c in rows.columns
        ]
    )


def paths(turns: DataFrame) -> DataFrame:
    """conv_id, depth, k1, k2, p1, p2 (the parent's sums), points of every turn: the nodes it goes through."""
    hashed = turns.select(
        "conv_id", "depth", "points",
        *[F.xxhash64("depth", h).cast("decimal(20,0)").alias(e) for h, e in (("h1", "e1"), ("h2", "e2"))],
    ).select("*", F.col("e1").cast("decimal(38,0)").alias("s1"), F.col("e2").cast("decimal(38,0)").alias("s2"))
    summed = running(hashed, "conv_id", "depth", ["s1", "s2"])

    def name(column: Column) -> Column:
        return F.pmod(column, F.lit(2**62).cast("decimal(38,0)")).cast("long")

    return summed.select(
        "conv_id", "depth", name(F.col("s1")).alias("k1"), name(F.col("s2")).alias("k2"),
        name(F.col("s1") - F.col("e1")).alias("p1"), name(F.col("s2") - F.col("e2")).alias("p2"), "points",
    )


def _bands(steps: DataFrame, nodes: DataFrame) -> DataFrame:
    """depth, k1, k2 of every node and ``up``: its ancestors within the band from the band root down, and itself.

    The smallest conversation of a node goes through all its ancestors.
    """
    band = F.call_function("div", F.col("depth"), F.lit(BAND)).alias("band")
    held = steps.select("conv_id", band, F.struct(*NAME).alias("step")).groupBy("conv_id", "band").agg(
        F.sort_array(F.collect_list("step")).alias("steps")
    )
    return nodes.withColumn("band", band).join(held, ["conv_id", "band"]).select(
        *NAME, F.slice("steps", F.lit(1), (F.pmod("depth", F.lit(BAND)) + 1).cast("int")).alias("up")
    )


def totals(steps: DataFrame, nodes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """depth, k1, k2 of every node with the sums of ``columns`` over its subtree.

    ``steps`` has conv_id, depth, k1, k2 of the nodes that each conversation goes through, the root (depth
    0) included; ``nodes`` has each node once, with its smallest conv_id, its parent's sums p1, p2 and the
    columns to add up.
    """
    ups = written(_bands(steps, nodes), "bands")
    joined = nodes.join(ups, NAME)
    if nodes.where(F.col("depth") >= BAND).isEmpty():
        weighted = joined.select("up", *columns)
    else:
        root = F.col("up")[0]
        tops = joined.select(*[root[n].alias(n) for n in NAME], *columns).groupBy(*NAME).agg(
            *[F.sum(c).alias(c) for c in columns]
        )
        # The band root above a band root is the first of its parent's band.
        above = joined.select(*NAME, root["k1"].alias("b1"), root["k2"].alias("b2"))
        is_top = F.pmod("depth", F.lit(BAND)) == 0
        roots = nodes.where(is_top).select("conv_id", *NAME, "p1", "p2").join(tops, NAME)
        parents = above.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), "b1", "b2")
        smaller = _with_parents(roots, parents, ["b1", "b2"]).select(
            "conv_id", F.call_function("div", F.col("depth"), F.lit(BAND)).alias("depth"), "k1", "k2",
            F.col("b1").alias("p1"), F.col("b2").alias("p2"), *columns,
        )
        fewer = steps.where(is_top).withColumn("depth", F.call_function("div", F.col("depth"), F.lit(BAND)))
        whole = totals(fewer, written(smaller, "roots"), columns).withColumn("depth", F.col("depth") * BAND)
        below = nodes.where(is_top & (F.col("depth") > 0)).select(*NAME, "p1", "p2").join(whole, NAME).groupBy(
            (F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")
        ).agg(*[F.sum(c).alias(f"_{c}") for c in columns])
        weighted = joined.join(below, NAME, "left").select(
            "up", *[(F.col(c) + F.coalesce(F.col(f"_{c}"), F.lit(0))).alias(c) for c in columns]
        )
    sent = weighted.select(F.explode("up").alias("to"), *columns)
    return sent.groupBy(*[F.col("to")[n].alias(n) for n in NAME]).agg(*[F.sum(c).alias(c) for c in columns])


def _with_parents(nodes: DataFrame, parents: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``nodes`` with ``columns`` of their parents, by depth, p1 and p2; the root has none.

    Fewer than ``HOT`` parents can have more than one in ``HOT`` of all children; these are broadcast.
    """
    by = ["depth", "p1", "p2"]
    total = nodes.count()
    hot = nodes.groupBy(*by).count().where((F.col("count") * HOT > total) & (F.col("count") > HOT)).drop("count")
    few = written(parents.join(F.broadcast(hot), by), "hot")
    marked = nodes.join(F.broadcast(few.withColumn("_hot", F.lit(True))), by, "left")
    plain = marked.where("_hot is null").drop(*columns, "_hot").join(parents, by, "left")
    done = marked.where("_hot").drop("_hot")
    return plain.unionByName(done.select(*plain.columns))


def trie(turns: DataFrame, conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes and ends of the trie of ``turns`` (conv_id, depth from 1, h1, h2, points).

    ``conversations`` has every conv_id once, also of those without turns. Nodes: depth, k1, k2, conv_id
    (smallest member), parent_conv_id, n_convs, n_children, n_leaves and saved_tokens (over the subtree, each
    node's members but one times the code points of its last text). Ends: conv_id and the depth, k1, k2 of
    the node it ends at.
    """
    zero = F.lit(0).cast("long")
    start = conversations.select(
        "conv_id", zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), zero.alias("p1"), zero.alias("p2"),
        zero.alias("points"),
    )
    steps = written(start.unionByName(paths(turns)), "paths")
    counted = written(steps.groupBy(*NAME).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("points").alias("points"),
        F.max("p1").alias("p1"), F.max("p2").alias("p2"),
    ), "nodes")
    children = counted.where("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")
    ).agg(F.count("*").alias("n_children"))
    nodes = written(counted.join(children, NAME, "left").select(
        *NAME, "conv_id", "p1", "p2", "n_convs", F.coalesce("n_children", zero).alias("n_children"),
        F.col("n_children").isNull().cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("points")).alias("saved_tokens"),
    ), "weights")
    summed = totals(steps.select("conv_id", *NAME), nodes, ["n_leaves", "saved_tokens"])
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    found = _with_parents(nodes.drop("n_leaves", "saved_tokens"), parents, ["parent_conv_id"]).join(summed, NAME)
    last = steps.groupBy("conv_id").agg(F.max(F.struct(*NAME)).alias("last"))
    ends = last.select("conv_id", *[F.col("last")[n].alias(n) for n in NAME])
    return found.drop("p1", "p2"), ends
