"""The operators applied to the given tables, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    conversation_repair, conversation_trie, embedding_dedup, line_templates, mixing, nearest, ngram_join, packing, quality,
    sharding, suffix_dedup, token_count, url_filter,
)
from .common import digests, written


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return cut.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"), n=4, percent=85)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.sample(table(spark, sf_dir, "documents"))
    return mixed.withColumn("chance", F.floor(F.col("chance") * 1e6)).withColumnRenamed("chance", "chance_ppm")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def _junk_list(captures: DataFrame) -> DataFrame:
    """A dated list from the captures themselves: hosts, and their first path segments, are added
    the day after most of their titles were junk, and removed the day after most were not."""
    title = F.regexp_extract("html", "<title>([^<]*)", 1)
    junk = (F.length(title) - F.length(F.translate(title, "#*$%|", "")) >= 3).cast("int")
    host, path = url_filter.host_of("url"), url_filter.path_of("url")
    patterns = F.array_distinct(F.array(host, F.concat_ws("/", host, F.try_element_at(path, F.lit(1)))))
    seen = captures.select(F.explode(patterns).alias("pattern"), F.to_date("fetched").alias("seen"), junk.alias("junk"))
    action = F.when(F.avg("junk") > 0.5, "add").otherwise("remove")
    return seen.where("pattern <> ''").groupBy("pattern", "seen").agg(action.alias("action")).select(
        "pattern", F.date_add("seen", 1).alias("day"), "action"
    )


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The crawl fetched the pages in order, one an hour.
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    fetched = start + F.make_dt_interval(hours=F.col("page_id").cast("int"))
    captures = table(spark, sf_dir, "pages").withColumn("fetched", fetched)
    return url_filter.judge(captures, _junk_list(captures))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_templates.drop_recurring(table(spark, sf_dir, "documents")).drop("key")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents")).drop("row_key")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(table(spark, sf_dir, "documents"), _vocabulary("word_bpe_49k.json"))


def op11_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return nearest.nearest(rows, rows.where("vec_id % 20 = 0"))


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role and text after faults that a hash of each row's number decides on."""
    space = F.lit(" ")
    name = [F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")]
    fate = (F.crc32(F.concat(name[0], F.lit(":"), name[1])) % 20).cast("int")
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    return conversations.withColumn("fate", fate).where("fate <> 0").select(
        "conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(role).alias("role"),
        F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.array_repeat(F.lit(1), F.when(F.col("fate") == 3, 2).otherwise(1))).alias("one"),
    ).drop("one")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations")
    summary, repaired = conversation_repair.repair(damaged(given))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    pieces = repaired.where(F.size("turns") > 0).select(
        "conv_id", "part", "piece", F.array_join(lines, "\n").cast("binary").alias("body")
    )
    hashed = digests(pieces, ["conv_id"], ["part", "piece"], b"\n")
    every, zero = given.select(F.col("conv_id").alias("of")).distinct(), F.lit(0).cast("long")
    found = every.join(summary, F.col("of").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
    found = found.join(hashed, F.col("of").eqNullSafe(F.col("conv_id")), "left")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return found.select(
        F.col("of").alias("conv_id"), *[F.coalesce(n, zero).alias(n) for n in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("digest", F.sha2(F.lit(b""), 256)).alias("repaired_sha256"),
    )


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = written(conversation_trie.ordered_turns(table(spark, sf_dir, "conversations")), "turns")
    conversations = turns.select("conv_id").distinct().select(
        "conv_id", (F.col("conv_id") - F.pmod("conv_id", F.lit(100))).alias("base"),
        (F.crc32(F.col("conv_id").cast("string")) % 6).cast("int").alias("heads"),
    )
    rebuilt = written(conversation_trie.rebased(turns, conversations), "rebuilt")
    nodes, ends = conversation_trie.trie(rebuilt, conversations)
    # The numbers that end at a node go by ranges of numbers, so that no list of them is large.
    name = conversation_trie.NAME
    listed = F.sort_array(F.collect_list("conv_id"))
    pieces = ends.groupBy(*name, F.floor(F.col("conv_id") / 4096).alias("piece")).agg(listed.alias("ids")).select(
        *name, "piece", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").cast("binary").alias("body")
    )
    return nodes.join(digests(pieces, name, ["piece"], b","), name, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("digest", F.sha2(F.lit(b""), 256)).alias("ends_sha256"),
    )


_URL_SQL = r"""
WITH c AS (SELECT page_id, url, html, (TIMESTAMP '2024-01-01' + to_hours(page_id))::DATE AS day,
  regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '\.$', '') AS host,
  list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)', 1), '/'), lambda s: s <> '') AS segs
  FROM pages),
j AS (SELECT *, length(t) - length(translate(t, '#*$%|', '')) >= 3 AS junk
      FROM (SELECT *, regexp_extract(html, '<title>([^<]*)', 1) AS t FROM c)),
seen AS (SELECT host AS pattern, day, junk FROM j WHERE host <> ''
         UNION ALL SELECT host || '/' || segs[1], day, junk FROM j WHERE len(segs) > 0),
ent AS (SELECT pattern, day + 1 AS day, avg(junk::INT) > 0.5 AS is_added FROM seen GROUP BY pattern, day),
iv AS (SELECT * FROM (SELECT pattern, day AS valid_from, lead(day) OVER (PARTITION BY pattern ORDER BY day) AS valid_to, is_added FROM ent)
       WHERE is_added),
cov AS (SELECT page_id, url, day, unnest(list_concat(
          list_transform(range(1, len(labels) + 1), lambda i: array_to_string(labels[i:], '.')),
          CASE WHEN len(segs) > 0 THEN [host || '/' || segs[1]] ELSE [] END)) AS pattern
        FROM (SELECT *, string_split(host, '.') AS labels FROM c WHERE host <> '')),
hit AS (SELECT page_id, url, day, pattern, valid_from, row_number() OVER (PARTITION BY page_id, url ORDER BY length(pattern) DESC, pattern DESC) AS nth
        FROM cov JOIN iv USING (pattern) WHERE day >= valid_from AND (valid_to IS NULL OR day < valid_to))
SELECT c.page_id, c.url, c.day, hit.pattern IS NOT NULL AS blocked, hit.pattern, hit.valid_from AS since
FROM c LEFT JOIN hit ON c.page_id = hit.page_id AND c.url = hit.url AND nth = 1
"""


def _mixing_sql() -> str:
    """The raking rounds, one after the other."""
    steps = [r"""
d AS (SELECT doc_id, source, lang, coalesce(source, chr(0)) AS d_source, coalesce(lang, chr(0)) AS d_lang,
  CASE WHEN regexp_matches(text, '(License|Licence|Copyright)') THEN 'legal'
       WHEN (length(text) - length(translate(text, '#*$%&|<>', ''))) * 20 > length(text) THEN 'markup'
       WHEN regexp_matches(text, '[A-Za-z0-9]@[A-Za-z0-9]') THEN 'contact' ELSE 'prose' END AS d_topic,
  coalesce(len(regexp_extract_all(text, '[^ \t\n\x0B\f\r]+')), 0)::BIGINT AS tokens FROM documents),
s AS (SELECT d_source, d_lang, d_topic, sum(tokens)::DOUBLE AS tokens FROM d GROUP BY ALL HAVING sum(tokens) > 0),
c0 AS (SELECT *, tokens / (SELECT sum(tokens) FROM s) AS weight FROM s)"""]
    for dim, wanted in mixing.TARGETS.items():
        if isinstance(wanted, float):
            raw = f"pow(held, {wanted})"
        else:
            cases = " ".join(f"WHEN '{v}' THEN {share}" for v, share in wanted.items())
            rest = max(0.0, 1.0 - sum(wanted.values()))
            raw = (f"coalesce(CASE d_{dim} {cases} END, {rest!r} * held"
                   f" / sum(held) FILTER (WHERE d_{dim} NOT IN ({', '.join(map(repr, wanted))})) OVER ())")
        steps.append(f"r_{dim} AS (SELECT d_{dim}, {raw} AS raw FROM (SELECT d_{dim}, sum(weight) AS held FROM c0 GROUP BY 1))")
        steps.append(f"t_{dim} AS (SELECT d_{dim}, raw / sum(raw) OVER () AS target FROM r_{dim})")
    at = 0
    for _ in range(mixing.ROUNDS):
        for dim in mixing.DIMENSIONS:
            steps.append(
                f"c{at + 1} AS MATERIALIZED (SELECT d_source, d_lang, d_topic, tokens, CASE WHEN now > 0 THEN weight * (target / now) ELSE 0 END AS weight"
                f" FROM (SELECT *, sum(weight) OVER (PARTITION BY d_{dim}) AS now FROM c{at}) JOIN t_{dim} USING (d_{dim}))"
            )
            at += 1
    return "WITH " + ",\n".join(steps) + f"""
SELECT doc_id, source, lang, d_topic AS topic, d.tokens, floor(coalesce(chance, 0) * 1e6)::BIGINT AS chance_ppm,
  d.tokens > 0 AND ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':{mixing.SEED}'), 1, 12))::BIGINT / 281474976710656.0
    < coalesce(chance, 0) AS sampled
FROM d LEFT JOIN (SELECT d_source, d_lang, d_topic, (weight / tokens) / max(weight / tokens) OVER () AS chance FROM c{at})
  USING (d_source, d_lang, d_topic)"""


_LEVEL_SQL = """l{d} AS (SELECT own, documents, ts, n, CASE WHEN n < {d} THEN node WHEN held >= 5 THEN node || chr(10) || ts[{d}] ELSE node || chr(10) END AS node,
    wild + CASE WHEN n < {d} OR held >= 5 THEN 0 ELSE 1 END AS wild
  FROM (SELECT *, sum(documents) OVER (PARTITION BY node, ts[{d}]) AS held FROM l{before})
  WHERE wild + CASE WHEN n < {d} OR held >= 5 THEN 0 ELSE 1 END <= least(2, n - ceil(n * 0.7))),"""
_TEMPLATE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
p AS (SELECT r, doc_id, text, generate_subscripts(ls, 1) AS pos, unnest(ls) AS line
      FROM (SELECT r, doc_id, text, string_split(text, chr(10)) AS ls FROM d)),
w AS (SELECT *, regexp_extract_all(line, '[^ \t\x0B\f\r]+') AS ws FROM p),
m AS (SELECT *, list_transform(ws, lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END) AS ms,
        array_to_string(ms, ' ') AS mline FROM w),
l AS (SELECT *, CASE WHEN 2 * (length(mline) - length(replace(mline, '<*>', ''))) > 3 * len(ws) THEN ws ELSE ms END AS ts
      FROM m),
k AS (SELECT r, doc_id, text, pos, ts, array_to_string(ts, ' ') AS own FROM l WHERE len(ts) > 0),
kinds AS (SELECT own, count(DISTINCT (doc_id, text)) AS documents, min(doc_id) AS first, any_value(ts) AS ts, len(any_value(ts)) AS n
          FROM k GROUP BY own),
l0 AS (SELECT own, documents, ts, n, n::VARCHAR AS node, 0 AS wild FROM kinds),
{levels}
leaf AS (SELECT * FROM (SELECT *, sum(documents) OVER (PARTITION BY node) AS total, count(*) OVER (PARTITION BY node) AS kinds FROM l5)
         WHERE kinds > 1 AND total >= 5),
tok AS (SELECT own, documents, n, node, generate_subscripts(ts, 1) AS pos, unnest(ts) AS token FROM leaf),
con AS (SELECT * FROM (SELECT *, sum(documents) OVER (PARTITION BY node, pos, token) AS held FROM tok) WHERE held >= 5),
ranked AS (SELECT *, row_number() OVER (PARTITION BY own ORDER BY held, pos) AS nth, count(*) OVER (PARTITION BY own) AS constants FROM con),
shape AS (SELECT own, documents, node, n, constants, string_agg(pos || ' ' || token, ' ' ORDER BY pos) AS shape
          FROM ranked WHERE constants >= ceil(n * 0.7) GROUP BY ALL),
freq AS (SELECT node, shape FROM shape GROUP BY ALL HAVING sum(documents) >= 5),
alone AS (SELECT own FROM shape LEFT JOIN freq USING (node, shape) WHERE freq.node IS NULL),
drops AS (SELECT own, n, constants, unnest(range(1, constants - ceil(n * 0.7)::BIGINT + 1)) AS j
          FROM (SELECT DISTINCT own, n, constants FROM ranked) JOIN alone USING (own)),
wider AS (SELECT own, node, j, string_agg(pos || ' ' || token, ' ' ORDER BY pos) AS shape
          FROM drops JOIN ranked USING (own) WHERE nth > j GROUP BY ALL),
most AS (SELECT own, node, shape FROM (SELECT *, row_number() OVER (PARTITION BY own ORDER BY j) AS best FROM wider JOIN freq USING (node, shape))
         WHERE best = 1),
mem AS (SELECT own, node, shape FROM shape JOIN freq USING (node, shape) UNION ALL SELECT own, node, shape FROM most),
tpl AS (SELECT kinds.own, documents, first, mem.own IS NOT NULL AS is_shared, coalesce(mem.node || '|' || mem.shape, kinds.own) AS template
        FROM kinds LEFT JOIN mem ON kinds.own = mem.own),
rec AS (SELECT template, is_shared, min(first) AS first FROM tpl GROUP BY template, is_shared HAVING sum(documents) >= 5),
gone AS (SELECT r, pos FROM k JOIN tpl USING (own) JOIN rec USING (template, is_shared)
         WHERE k.doc_id IS DISTINCT FROM rec.first)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(x.text, '') END AS text,
       coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dropped, 0)::BIGINT AS n_dropped
FROM d LEFT JOIN (
  SELECT l.r, string_agg(line, chr(10) ORDER BY l.pos) FILTER (WHERE gone.r IS NULL) AS text,
         count(*) FILTER (WHERE len(ts) > 0) AS n_lines, count(gone.r) AS n_dropped
  FROM l LEFT JOIN gone ON l.r = gone.r AND l.pos = gone.pos GROUP BY l.r) x USING (r)
""".replace("{levels}", "\n".join(_LEVEL_SQL.format(d=d, before=d - 1) for d in range(1, 6)))

_QUALITY_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(source, chr(0)) AS host, coalesce(text, '') AS text
  FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
l AS (SELECT r, host, text, generate_subscripts(ls, 1) AS pos, unnest(ls) AS line
      FROM (SELECT r, host, text, string_split(text, chr(10)) AS ls FROM d)),
lw AS (SELECT *, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS ws,
         count(*) OVER (PARTITION BY r, line) AS same FROM l),
ln AS (SELECT r, host, text, len(ws) AS n,
         regexp_replace(translate(array_to_string(ws, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9]', '0', 'g') AS k,
         row_number() OVER (PARTITION BY r, line ORDER BY pos) AS nth
       FROM lw WHERE len(ws) > 0),
dup AS (SELECT r, count(*) FILTER (WHERE nth > 1) AS n_dup_lines FROM ln GROUP BY r),
sizes AS (SELECT host, count(DISTINCT text) AS texts FROM d GROUP BY host),
often AS (SELECT host, k FROM (SELECT host, k, count(DISTINCT text) AS documents FROM ln GROUP BY host, k) JOIN sizes USING (host)
          WHERE documents > 10 AND documents > texts * 0.05::DOUBLE),
lost AS (SELECT r, sum(n) AS words_removed FROM ln JOIN often USING (host, k) GROUP BY r),
t AS (SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS tri
      FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) > 2)),
tc AS (SELECT r, i, count(*) OVER (PARTITION BY r, tri) AS n FROM t),
rep AS (SELECT r, count(DISTINCT p) AS n_repeat_words
        FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM tc WHERE n > 1) GROUP BY r),
m AS (
  SELECT r, doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         coalesce(words_removed, 0)::BIGINT AS words_removed
  FROM w LEFT JOIN dup USING (r) LEFT JOIN rep USING (r) LEFT JOIN lost USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, words_removed,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
         AND n_words - words_removed >= n_words * 0.3 AS kept
FROM m
"""

QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_best_fit_packing": op2_best_fit_packing, "op3_ngram_join": op3_ngram_join,
    "op4_mixing": op4_mixing, "op5_sharding": op5_sharding,
    "op6_url_filters": op6_url_filters, "op7_embedding_dedup": op7_embedding_dedup,
    "op8_line_dedup": op8_line_dedup, "op9_quality_rules": op9_quality_rules,
    "op10_token_counts": op10_token_counts, "op11_nearest": op11_nearest,
    "op12_conversation_repair": op12_conversation_repair, "op13_conversation_trie": op13_conversation_trie,
}
SQL = {
    "op4_mixing": _mixing_sql(), "op6_url_filters": _URL_SQL, "op8_line_dedup": _TEMPLATE_SQL, "op9_quality_rules": _QUALITY_SQL,
}
