"""Quality rules: plain rules on each text, and how often its lines recur within its host.

Lines are normalised (lower case, white space joined, digits as 0) and hashed. For every host and
line the distinct texts that hold it are counted, so exact copies of one document count once. Lines held
by more than ``max_share`` of their host's texts, and by more than ``max_documents``, are removed: a share, so
that a host of any size is judged alike, and a number, as a share of a few texts says nothing. A document
that keeps less than ``min_kept`` of its words is depleted: rejected. ``judge`` counts and decides; ``keep_good`` gives
the documents that pass, their text without those lines.

Results for odd input: a NULL text counts as empty and fails the word rule; a NULL host is a host of
its own; repeated rows get the same result each; an empty table gives an empty result. Columns other
than the three that are used play no part, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick, plain, row_key, written

MIN_WORDS = 50
MAX_REPEATED = 50  # percent of the words
MAX_SHARE = 0.05  # of the texts of a host
MAX_DOCUMENTS = 10  # that may hold a line, whatever the share
MIN_KEPT = 0.3

_SYMBOLS = b"#*$%&|<>"
_DIGITS = bytes.maketrans(b"123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"000000000abcdefghijklmnopqrstuvwxyz")
_SPACES = b" \t\n\v\f\r"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SCHEMA = (
    "doc_id long, row_key long, host string, n_words long, word_chars long, n_symbols long, "
    "n_dup_lines long, n_repeat_words long, lines array<struct<line: long, words: long>>"
)
_LINES = pa.list_(pa.struct([("line", pa.int64()), ("words", pa.int64())]))


def _repeated_words(words: list[bytes]) -> int:
    windows = list(zip(words, words[1:], words[2:], strict=False))
    times = Counter(windows)
    if len(times) == len(windows):
        return 0
    covered, end = 0, 0
    for at, window in enumerate(windows):
        if times[window] > 1:
            covered += at + 3 - max(at, end)
            end = at + 3
    return covered


def _line_key(words: list[bytes]) -> int:
    return xxhash.xxh3_64_intdigest(b" ".join(words).translate(_DIGITS)) - (1 << 63)


def _measured(text: bytes) -> tuple[int, int, int, int, int, list[dict]]:
    words = text.split()  # of bytes: at ASCII white space
    points = sum(map(len, words)) - len(b"".join(words).translate(None, bytes(range(0x80)) + bytes(range(0xC0, 256))))
    repeated, seen, lines = 0, set(), Counter()
    for line in text.split(b"\n"):
        parts = line.split()
        if parts:
            repeated += line in seen
            seen.add(line)
            lines[_line_key(parts)] += len(parts)
    symbols = len(text) - len(text.translate(None, _SYMBOLS))
    held = [{"line": line, "words": n} for line, n in lines.items()]
    return len(words), points, symbols, repeated, _repeated_words(words), held


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [_measured((t or "").encode()) for t in batch.column("text").to_pylist()]
        columns = list(zip(*rows, strict=True)) or [[]] * 6
        arrays = [batch.column(c) for c in ("doc_id", "row_key", "host")]
        arrays += [pa.array(c, pa.int64()) for c in columns[:5]] + [pa.array(columns[5], _LINES)]
        yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "row_key", "host", *MEASURES, "lines"])


def measure(docs: DataFrame, host: str = "source") -> DataFrame:
    """The measures of every document and its distinct normalised lines, one row each."""
    rows = pick(docs, "doc_id", "text", host).toDF("doc_id", "text", "host").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.coalesce(F.col("host").cast("string"), F.lit("\0")).alias("host"),
    )
    return rows.withColumn("row_key", row_key("host", "text")).mapInArrow(_measure, _SCHEMA)


def frequent_lines(
    measured: DataFrame, max_documents: int = MAX_DOCUMENTS, max_share: float = MAX_SHARE
) -> DataFrame:
    """(host, line, documents) of the lines that more than so many texts of a host hold, and such a share.

    Texts are made distinct first, and by text: a line that every document holds is counted by
    many tasks.
    """
    lines = measured.select("host", "row_key", F.explode("lines.line").alias("line"))
    counts = lines.distinct().groupBy("host", "line").agg(F.count("*").alias("documents"))
    texts = measured.select("host", "row_key").distinct().groupBy("host").agg(F.count("*").alias("texts"))
    # Few lines are above the number, so few meet the row of their host.
    return counts.where(F.col("documents") > max_documents).join(texts, "host").where(
        F.col("documents") > F.col("texts") * F.lit(max_share)
    ).drop("texts")


def _judged(docs: DataFrame, host: str, max_documents: int, max_share: float, min_kept: float) -> DataFrame:
    """What ``judge`` gives, and ``cut``: the frequent lines of the document, or NULL."""
    held = written(measure(docs, host), "measured")
    lines = held.select("host", "row_key", F.explode("lines").alias("l")).select(
        "host", "row_key", "l.line", "l.words"
    ).distinct()
    lost = (
        lines.join(frequent_lines(held, max_documents, max_share).drop("documents"), ["host", "line"])
        .groupBy("row_key").agg(F.sum("words").alias("words_removed"), F.collect_list("line").alias("cut"))
    )
    removed = F.coalesce("words_removed", F.lit(0))
    failed = (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED
    )
    depleted = F.col("n_words") - removed < F.col("n_words") * F.lit(min_kept)
    return held.drop("lines").join(lost, "row_key", "left").select(
        "doc_id", "row_key", *MEASURES, removed.alias("words_removed"), failed.alias("base_failed"),
        (~failed & ~depleted).alias("kept"), "cut",
    )


def judge(
    docs: DataFrame, host: str = "source", max_documents: int = MAX_DOCUMENTS, max_share: float = MAX_SHARE,
    min_kept: float = MIN_KEPT,
) -> DataFrame:
    """doc_id, row_key, the measures, ``words_removed``, ``base_failed`` and ``kept``."""
    return _judged(docs, host, max_documents, max_share, min_kept).drop("cut")


def _without(text: str, cut: list[int]) -> str:
    lines, gone = text.encode().split(b"\n"), set(cut)
    return b"\n".join(line for line in lines if not (words := line.split()) or _line_key(words) not in gone).decode()


def _cut_text(text: str, cut: str) -> Column:
    @F.arrow_udf("string")
    def rewritten(texts: pa.Array, cuts: pa.Array) -> pa.Array:
        pairs = zip(texts.to_pylist(), cuts.to_pylist(), strict=True)
        return pa.array([None if t is None else _without(t, c) for t, c in pairs], pa.string())

    # Only texts that lose lines are sent to Python.
    return F.when(F.col(cut).isNotNull(), rewritten(F.when(F.col(cut).isNotNull(), F.col(text)), F.col(cut))).otherwise(F.col(text))


def keep_good(
    docs: DataFrame, host: str = "source", max_documents: int = MAX_DOCUMENTS, max_share: float = MAX_SHARE,
    min_kept: float = MIN_KEPT,
) -> DataFrame:
    """The documents that pass, with all their columns, without the frequent lines of their host.

    ``n_chars``, where there is one, follows the text.
    """
    verdicts = _judged(docs, host, max_documents, max_share, min_kept).groupBy("row_key").agg(
        F.bool_and("kept").alias("kept"), F.any_value("cut").alias("cut")
    )
    rows, at = plain(docs, host, "text", *["n_chars"] * ("n_chars" in docs.columns))
    good = rows.withColumn("row_key", row_key(at[host], at["text"])).join(
        verdicts.where("kept").select("row_key", "cut"), "row_key"
    ).withColumn("new_text", _cut_text(at["text"], "cut"))
    values = {at["text"]: F.col("new_text")}
    if "n_chars" in at:
        changed = F.when(F.col("cut").isNotNull(), F.length("new_text"))
        values[at["n_chars"]] = changed.otherwise(F.col(at["n_chars"])).cast(docs.schema["n_chars"].dataType)
    return good.select(*[values.get(c, F.col(c)).alias(c) for c in rows.columns]).toDF(*docs.columns)
