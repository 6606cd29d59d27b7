"""Token counts by byte-pair merging: heap and linked list, no identifiers emitted.

A word starts as one symbol a byte. The adjacent pair of the lowest rank (the leftmost of equals) is
popped from a heap and merged in a linked list until no ranked pair is left; the word's count is its
symbols less its merges. Texts are normalised and split into words as the vocabulary file demands,
and the counts of words are remembered within a worker, up to ``REMEMBERED`` of them.

Results for odd input: a NULL or empty text has no bytes and no tokens; special tokens that stand in
a text count as one each; repeated rows get a result each; an empty table gives an empty result.
Words of any length are merged whole in n log n steps.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from unicodedata import normalize

from .common import pick

LIMIT = 2048
REMEMBERED = 400_000  # words a worker remembers; afterwards it starts anew

# Blocks with letters that the two versions of Unicode know differently; the tests try every code point.
_UNSURE = regex.compile("[\uA640-\uABFF\U00010000-\U0010FFFF]")
_SPACES = regex.compile(r"\p{White_Space}+")
# The word pattern of the vocabulary file, white space spelt as the Unicode property it stands for.
_WORDS = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+"
)


def _byte_symbols() -> list[str]:
    """The printable sign by which byte-level vocabularies write each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    signs = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}
    return [signs[b] for b in range(256)]


def merges_of(ranks: dict[tuple[str, str], int], symbols: list[str]) -> int:
    """How many merges the symbols undergo."""
    n = len(symbols)
    before, after = list(range(-1, n - 1)), [*range(1, n), -1]
    held: list[str | None] = list(symbols)
    heap = [
        (rank, i, pair) for i, pair in enumerate(zip(symbols, symbols[1:], strict=False))
        if (rank := ranks.get(pair)) is not None
    ]
    heapq.heapify(heap)
    done = 0
    while heap:
        _, at, pair = heapq.heappop(heap)
        right = after[at]
        if right < 0 or held[at] != pair[0] or held[right] != pair[1]:
            continue  # one of the two has been merged since
        held[at], held[right] = pair[0] + pair[1], None
        after[at] = after[right]
        if after[at] >= 0:
            before[after[at]] = at
        done += 1
        for left in (before[at], at):
            if left >= 0 and after[left] >= 0:
                new = (held[left], held[after[left]])
                if (rank := ranks.get(new)) is not None:
                    heapq.heappush(heap, (rank, left, new))
    return done


class WordCounter:
    """Counts the tokens of texts under a lower-casing BPE vocabulary with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.ranks = {tuple(pair): rank for rank, pair in enumerate(model["merges"])}
        self.signs = _byte_symbols()
        self.special = [token["content"] for token in spec["added_tokens"]]
        self.split = regex.compile("|".join(map(regex.escape, self.special)) or r"(?!)")
        self.known: dict[str, int] = {}
        self.library = Tokenizer.from_file(path)
        self.normalise = self.library.normalizer.normalize_str

    def of_word(self, word: str) -> int:
        return self.of_symbols([self.signs[b] for b in word.encode()])

    def of_symbols(self, symbols: list[str]) -> int:
        symbols[-1] += self.end
        return len(symbols) - merges_of(self.ranks, symbols)

    def _of_plain(self, text: str) -> int:
        if _UNSURE.search(text):
            # Here the library's tables of letters and lower case are of another version than Python's.
            pieces = self.library.pre_tokenizer.pre_tokenize_str(self.normalise(text))
            return sum(self.of_symbols(list(piece)) for piece, _ in pieces)
        text = text if text.isascii() else normalize("NFC", text)
        # Lower case goes letter by letter: a sigma does not depend on its place.
        words = _WORDS.findall(_SPACES.sub(" ", text).replace("Σ", "σ").lower())
        known, total = self.known, 0
        for word in words:
            n = known.get(word)
            if n is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                n = known[word] = self.of_word(word)
            total += n
        return total

    def of_text(self, text: str) -> int:
        if not any(token in text for token in self.special):
            return self._of_plain(text)
        return len(self.split.findall(text)) + sum(map(self._of_plain, self.split.split(text)))


_COUNTERS: dict[str, WordCounter] = {}


def _counting(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _COUNTERS:
            _COUNTERS[path] = WordCounter(path)
        counter = _COUNTERS[path]
        for batch in batches:
            tokens = [counter.of_text(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(tokens, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    return count


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and ``over_limit``; ``path`` names the vocabulary on every worker."""
    rows = pick(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    rows = rows.withColumn("n_bytes", F.octet_length("text").cast("long"))
    counted = rows.mapInArrow(_counting(path), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
