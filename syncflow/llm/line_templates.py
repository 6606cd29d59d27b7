"""Line dedup by a log-template tree of fixed depth.

Tokens that hold a digit stand as ``<*>`` (unless most tokens do: a row of numbers stands for itself). A
line's path in the tree is its number of tokens and then, for each of its ``DEPTH`` leading tokens, the branch
of that token, if ``MIN_DOCUMENTS`` documents take it, or else the wildcard branch. At most ``WILDCARDS``
of the leading tokens may be wildcards, and ``1 - SIMILAR`` of all; lines that have more are templates of
their own.

A leaf has any number of templates. At each position, a token that ``MIN_DOCUMENTS`` documents of the leaf hold
there is constant, others are variables; a line with ``SIMILAR`` of its positions constant gives a template,
and templates found in ``MIN_DOCUMENTS`` documents recur. A line whose own template does not recur goes
to the most similar one that does: its rarest constants are taken for variables, one after the other, until
a recurring template comes out. Lines of recurring templates are dropped, but for those of the first document
(by doc_id), so that every text survives once.

DataFrame functions only. Lines are reduced to distinct ones with counts before the tree is built, so a
line that a third of all documents hold is one row there; each level of the tree is one aggregation by
(node, token) ahead of the shuffle. What a line's occurrences are joined with is sent to ``SPREAD`` places.

Results for odd input: a NULL text stays NULL with no lines; lines without tokens are kept and not
counted; a NULL doc_id comes last; repeated rows count as one document and are treated alike; of several texts
under one doc_id each counts, and all keep what their doc_id was first to have; an empty table gives an
empty result.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import pick, plain, row_key, written

DEPTH = 5
WILDCARDS = 2  # among the leading tokens
SIMILAR = 0.7
MIN_DOCUMENTS = 5
VARIABLE = "<*>"
SPREAD = 8
SLOTS = 1 << 20  # of hashes; as many numbers are broadcast at most


def _has_token(line: Column | str) -> Column:
    return F.ltrim(line, F.lit(" \t\x0b\f\r")) != ""


def _lines(rows: DataFrame) -> DataFrame:
    """key, doc_id, pos, n, line (masked), its hash ``own``, and hashes t1, t2, ... of its leading tokens."""
    lines = rows.select("key", "doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "raw")).where(_has_token("raw"))
    # Most lines have no digits and no white space but single spaces. One run over a line tells both but for double
    # spaces; looking for these goes by bytes, and only the other lines need expressions that replace.
    lines = lines.withColumn("is_odd", ~F.rlike("raw", F.lit(r"\A[^0-9\t\x0B\f\r]*\z")))
    blanks = reduce(or_, [F.contains("raw", F.lit(c)) for c in "\t\x0b\f\r"])
    squeezed = F.when(
        F.contains("raw", F.lit("  ")) | (F.col("is_odd") & blanks), F.regexp_replace("raw", r"[ \t\x0B\f\r]{2,}|[\t\x0B\f\r]", " ")
    ).otherwise(F.col("raw"))
    lines = lines.withColumn("plain", F.trim(squeezed)).drop("raw")
    masked = F.when(F.col("is_odd"), F.regexp_replace("plain", "(?<![^ ])[^ 0-9]*+[0-9][^ ]*+", VARIABLE))
    # What is taken out is ASCII, so bytes tell how much as well as letters do.
    lines = lines.withColumn("masked", masked).withColumn(
        "n", 1 + F.octet_length("plain") - F.octet_length(F.replace("plain", F.lit(" "), F.lit("")))
    )
    variables = F.octet_length("masked") - F.octet_length(F.replace("masked", F.lit(VARIABLE), F.lit("")))
    is_mostly = 2 * variables > len(VARIABLE) * F.col("n")
    line = F.when(F.col("masked").isNull() | is_mostly, F.col("plain")).otherwise(F.col("masked"))
    heads = F.split(F.substring_index("line", " ", DEPTH), " ")
    lines = lines.withColumn("line", line).drop("plain", "masked", "is_odd").withColumn("heads", heads)
    tokens = [F.when(F.col("n") >= d, F.xxhash64(F.try_element_at("heads", F.lit(d)))).alias(f"t{d}") for d in range(1, DEPTH + 1)]
    return lines.select("key", "doc_id", "pos", "n", "line", F.xxhash64("line").alias("own"), *tokens)


def _allowed(similar: float) -> Column:
    """Variables that a line may have at most."""
    return F.col("n") - _wanted(similar)


def _wanted(similar: float) -> Column:
    return F.ceil(F.round(F.col("n") * F.lit(similar), 6))


def _leaves(distinct: DataFrame, similar: float, min_documents: int) -> DataFrame:
    """own, n, documents, rep and node (the leaf) of the lines that the tree has a leaf for."""
    at = distinct.select(
        "own", "n", "documents", "rep", F.xxhash64("n").alias("node"), F.lit(0).alias("wild"), *[f"t{d}" for d in range(1, DEPTH + 1)]
    )
    for d in range(1, DEPTH + 1):
        # A line too short for this level has no token and no branch, and NULLs join with nothing.
        is_short = F.col(f"t{d}").isNull()
        at = at.withColumn("child", F.when(~is_short, F.xxhash64("node", f"t{d}")))
        branches = at.where("child is not null").groupBy("child").agg(F.sum("documents").alias("held")).where(
            F.col("held") >= min_documents
        ).select("child", F.lit(True).alias("is_branch"))
        node = F.when(is_short, F.col("node")).when(F.col("is_branch"), F.col("child")).otherwise(F.xxhash64("node", F.lit(VARIABLE)))
        wild = F.col("wild") + F.when(is_short | F.col("is_branch"), 0).otherwise(1)
        at = at.join(branches, "child", "left").withColumn("node", node).withColumn("wild", wild).where(
            F.col("wild") <= F.least(F.lit(WILDCARDS), _allowed(similar))
        ).drop("child", "is_branch", f"t{d}")
        if d < DEPTH:  # each level is joined once
            at = written(at, "tree")
    return at.drop("wild")


def _templates(lines: DataFrame, distinct: DataFrame, similar: float, min_documents: int) -> DataFrame:
    """own, and its template's node, shape and constants, for lines that have part in a recurring template."""
    leaves = written(_leaves(distinct, similar, min_documents), "leaves")
    crowded = leaves.groupBy("node").agg(F.sum("documents").alias("total"), F.count("*").alias("kinds")).where(
        (F.col("kinds") > 1) & (F.col("total") >= min_documents)
    ).select("node")
    held = leaves.join(crowded, "node")
    # Each line's text from one document that has it: no line is fetched more than once.
    rep = held.select("own", F.col("rep").alias("key"))
    # Most lines have no part in the tree. They are told by a bounded broadcast, so that they are not shuffled.
    slot = F.pmod("own", F.lit(SLOTS)).cast("int").alias("slot")
    near = lines.select("own", "key", "line", slot).join(F.broadcast(rep.select(slot).distinct()), "slot", "left_semi")
    texts = near.join(rep, ["own", "key"], "left_semi").dropDuplicates(["own"]).select("own", "line")
    tokens = held.join(texts, "own").select(
        "own", "node", "n", "documents", F.posexplode(F.split("line", " ")).alias("pos", "token")
    ).select("own", "node", "n", "documents", "pos", F.xxhash64("token").alias("token"))
    tokens = written(tokens, "tokens")
    counts = tokens.groupBy("node", "pos", "token").agg(F.sum("documents").alias("held")).where(F.col("held") >= min_documents)
    # A template's shape is a hash over its constants; taking one out is one step.
    constants = written(
        tokens.join(counts, ["node", "pos", "token"]).select(
            "own", "node", "n", "documents", "pos", "held", F.xxhash64("pos", "token").alias("mark")
        ), "constants",
    )
    wanted = _wanted(similar)
    by = ["node", "shape", "constants"]
    own = constants.groupBy("own", "node", "n", "documents").agg(
        F.bit_xor("mark").alias("shape"), F.count("*").alias("constants")
    ).where(F.col("constants") >= wanted)
    own = written(own, "shapes")
    frequent = own.groupBy(*by).agg(F.sum("documents").alias("held")).where(F.col("held") >= min_documents).select(*by)
    frequent = written(frequent, "templates")
    alone = own.join(frequent, by, "left_anti")
    rarest = Window.partitionBy("own").orderBy("held", "pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    wider = constants.select("own", "held", "pos", "mark").join(
        alone.select("own", "node", "n", "shape", "constants"), "own"
    ).select(
        "own", "node", "n", F.col("shape").bitwiseXOR(F.bit_xor("mark").over(rarest)).alias("shape"),
        (F.col("constants") - F.count("*").over(rarest)).alias("constants"),
    ).where(F.col("constants") >= wanted)
    most = wider.join(frequent, by).groupBy("own").agg(F.max(F.struct("constants", "node", "shape")).alias("best"))
    return own.join(frequent, by).select("own", *by).unionByName(most.select("own", "best.node", "best.shape", "best.constants"))


def recurring(
    lines: DataFrame, similar: float = SIMILAR, min_documents: int = MIN_DOCUMENTS
) -> DataFrame:
    """(own, first): the distinct lines whose template recurs, and the document that keeps it."""
    heads = [f"t{d}" for d in range(1, DEPTH + 1)]
    distinct = written(
        lines.select("own", "n", *heads, "key", "doc_id").distinct().groupBy("own", "n", *heads).agg(
            F.count("*").alias("documents"), F.min("doc_id").alias("first"), F.min("key").alias("rep")
        ), "line-kinds",
    )
    found = written(_templates(lines, distinct, similar, min_documents), "found")
    by = ["shape", "node", "constants"]
    kinds = distinct.select("own", "documents", "first").join(found, "own")
    templates = kinds.groupBy(*by).agg(
        F.sum("documents").alias("held"), F.min("first").alias("earliest")
    ).where(F.col("held") >= min_documents)
    # Any other line is a template of its own: its documents are counted already.
    alone = distinct.where(F.col("documents") >= min_documents).join(found, "own", "left_anti")
    return kinds.join(templates, by).select("own", F.col("earliest").alias("first")).unionByName(alone.select("own", "first"))


def drop_recurring(
    docs: DataFrame, similar: float = SIMILAR, min_documents: int = MIN_DOCUMENTS
) -> DataFrame:
    """doc_id, key, text without the dropped lines, n_lines, n_dropped; one row for each of ``docs``."""
    rows = pick(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).withColumn("key", row_key("doc_id", "text"))
    lines = written(_lines(rows), "lines")
    repeats = written(recurring(lines, similar, min_documents), "recurring-lines")
    place = F.pmod("key", F.lit(SPREAD)).cast("int").alias("place")
    everywhere = repeats.withColumn("place", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    dropped = (
        lines.select("own", "key", "doc_id", "pos", place).join(everywhere, ["own", "place"])
        .where(~F.col("doc_id").eqNullSafe(F.col("first")))
        .groupBy("key").agg(F.collect_set("pos").alias("dropped"))  # of one document
    )
    none = F.array().cast("array<int>")
    joined = rows.join(dropped, "key", "left").withColumn("dropped", F.coalesce("dropped", none))
    parts = F.split("text", "\n")
    kept = F.filter(parts, lambda _, i: ~F.array_contains(F.col("dropped"), i))
    text = F.when(F.size("dropped") > 0, F.array_join(kept, "\n")).otherwise(F.col("text"))
    held = F.size(F.filter(parts, _has_token))
    return joined.select(
        "doc_id", "key", text.alias("text"), F.coalesce(held, F.lit(0)).cast("long").alias("n_lines"),
        F.size("dropped").cast("long").alias("n_dropped"),
    )


def keep_new_lines(docs: DataFrame, **limits) -> DataFrame:
    """``docs`` without recurring lines, with all columns.

    Documents that lose their last line go; ``n_chars`` follows the text.
    """
    rows, at = plain(docs, "doc_id", "text", "n_chars")
    keyed = rows.withColumn("key", row_key(at["doc_id"], at["text"]))
    cut = drop_recurring(docs, **limits).where("n_dropped > 0").dropDuplicates(["key"]).select(
        "key", F.col("text").alias("new_text"), (F.col("n_dropped") == F.col("n_lines")).alias("is_empty")
    )
    held = keyed.join(cut, "key", "left").where("is_empty is null or not is_empty")
    values = {
        at["text"]: F.when(F.col("is_empty").isNotNull(), F.col("new_text")).otherwise(F.col(at["text"])),
        at["n_chars"]: F.when(F.col("is_empty").isNotNull(), F.length("new_text")).otherwise(F.col(at["n_chars"])).cast("long"),
    }
    return held.select(*[values.get(c, F.col(c)).alias(c) for c in rows.columns]).toDF(*docs.columns)
