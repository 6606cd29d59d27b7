"""Repair of conversations: the cheapest edits that give turns in a legal order.

A legal conversation is empty, or has an optional system turn and then user and assistant turns in pairs:
``(s?(ua)+)?`` of role initials. Edits of a row: keep (0), set the role to user or assistant (1), delete
(2); inserts of an empty user or assistant turn anywhere (5 each). Blank rows and duplicates have to be
deleted, truncated rows that stay add 5. Among the cheapest, the edits whose initials (D, I, K, R) come
first in ASCII order are taken.

**Weighted interval parsing.** The grammar in Chomsky normal form has a symbol X(p, r) for each pair of
states of the order above (nothing yet, after s, after u, after a): what leads from p to r. Its rules are
X(p, r) -> X(p, q) X(q, r), and X(p, r) -> row for the edits of one row. A span's cell has, for each symbol,
the least (cost, audit), the audit being the initials. Inserts derive from no row at all: the closure of
the inserts is taken once and stands at both ends of every row's cell. Spans are combined bottom-up by
length, from one row to a whole conversation.

Because every rule has all q, any derivation of a span can be bracketed at any place. A cell is therefore
the same for every split, and one split a span is enough: spans of two, four, eight rows, ... The tests hold
this against the chart with all splits. Least audits of parts make up least audits of the whole, as no
audit of a span with the same cost begins with another one: after the last row only inserts are left,
and they cost.

Rows are ordered by ranges, and spans are combined in pieces of ``PIECE`` rows, then along the pieces of a
range, then along the ranges of a conversation: one conversation may hold any share of the rows. What
arrives at the last step is its audit, a letter a row.

Results for odd input: a NULL role or text is one space, so a NULL text is blank; a NULL conv_id is a
conversation like others; rows without a turn come first; rows of one turn are ordered by role and text;
the initial of a role is its first character, whatever the role is, and an empty role has a space. An
empty table gives empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from syncflow.operators import ordered

from .common import pick, written

PIECE = 256  # rows whose spans are combined in one step
RETYPE, DELETE, INSERT, CUT_OFF = 1, 2, 5, 5  # fixed costs

START, SYSTEM, USER, ASSISTANT = range(4)
STEP = {
    (START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER,
}
#: Symbols X(p, r) that derive something; START and SYSTEM are never come back to.
SYMBOLS = [(p, r) for p in range(4) for r in range(4) if p == r or r > p or (p, r) == (ASSISTANT, USER)]
RULES = [(p, q, r) for p, q in SYMBOLS for q2, r in SYMBOLS if q == q2 and (p, r) in SYMBOLS]

Cell = dict[tuple[int, int], tuple[int, str]]


def combined(left: Cell, right: Cell) -> Cell:
    """The cell of two adjacent spans: the least (cost, audit) over all rules."""
    cell: Cell = {}
    for p, q, r in RULES:
        a, b = left.get((p, q)), right.get((q, r))
        if a is None or b is None:
            continue
        cost, best = a[0] + b[0], cell.get((p, r))
        if best is None or cost < best[0] or cost == best[0] and a[1] + b[1] < best[1]:
            cell[p, r] = (cost, a[1] + b[1])
    return cell


def _closure() -> Cell:
    """What no row at all derives: nothing, or inserts."""
    cell: Cell = {(p, p): (0, "") for p in range(4)}
    for (p, role), r in STEP.items():
        if role != "s":
            cell[p, r] = (INSERT, "I")
    while (more := combined(cell, cell)) != cell:
        cell = more
    return cell


INSERTS = _closure()


@lru_cache
def row_cell(initial: str, fault: str) -> Cell:
    """The cell of one row, inserts around it included. Faults: '.' none, b(lank), d(uplicate), t(runcated)."""
    cell: Cell = {(p, p): (DELETE, "D") for p in range(4)}
    if fault in ".t":
        extra = CUT_OFF if fault == "t" else 0
        for (p, role), r in STEP.items():
            choices = [(extra, "K")] if role == initial else []
            choices += [(extra + RETYPE, "R")] if role != "s" else []
            if choices:
                cell[p, r] = min(choices)
    return combined(combined(INSERTS, cell), INSERTS)


def spans_combined(cells: list[Cell]) -> Cell:
    """The cell of a span from those of its parts, by span length."""
    while len(cells) > 1:
        cells = [combined(*cells[i : i + 2]) if i + 1 < len(cells) else cells[i] for i in range(0, len(cells), 2)]
    return cells[0]


def _illegal(before: str, after: str) -> int:
    return before + after not in ("su", "ua", "au")


_CELL = pa.struct([("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string()))])
_CELL_SQL = "struct<costs: array<bigint>, audits: array<string>>"


def _packed(cell: Cell) -> dict:
    held = [cell.get(symbol) for symbol in SYMBOLS]
    return {"costs": [c and c[0] for c in held], "audits": [c and c[1] for c in held]}


def _unpacked(cell: dict) -> Cell:
    return {
        s: (c, a) for s, c, a in zip(SYMBOLS, cell["costs"], cell["audits"], strict=True) if c is not None
    }


def _mapped(batches: Iterator[pa.RecordBatch], step, kind: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [dict(zip(kind.names, step(row), strict=True)) for row in batch.to_pylist()]
        yield pa.RecordBatch.from_pylist(rows, kind)


def _parsing(conv: pa.DataType):
    """Rows of a piece to its cell."""
    kind = pa.schema([
        ("conv_id", conv), ("_part", pa.int32()), ("piece", pa.int64()), ("size", pa.int64()), ("cell", _CELL),
        ("illegal", pa.int64()), ("ends", pa.string()),
    ])

    def step(row: dict) -> tuple:
        roles = row["roles"]
        cell = spans_combined([row_cell(r, f) for r, f in zip(roles, row["faults"], strict=True)])
        illegal = sum(map(_illegal, roles, roles[1:]))
        return row["conv_id"], row["_part"], row["piece"], len(roles), _packed(cell), illegal, roles[0] + roles[-1]

    return lambda batches: _mapped(batches, step, kind)


def _joined(parts: list[dict]) -> tuple[Cell, int, str]:
    """Cell, illegal pairs and outer initials of adjacent spans."""
    cell = spans_combined([_unpacked(p["cell"]) for p in parts])
    between = sum(_illegal(a["ends"][1], b["ends"][0]) for a, b in zip(parts, parts[1:], strict=False))
    return cell, between + sum(p["illegal"] for p in parts), parts[0]["ends"][0] + parts[-1]["ends"][1]


def _merging(conv: pa.DataType):
    """Pieces of a range to one span."""
    size = pa.list_(pa.struct([("piece", pa.int64()), ("size", pa.int64())]))
    kind = pa.schema([
        ("conv_id", conv), ("_part", pa.int32()), ("sizes", size), ("cell", _CELL), ("illegal", pa.int64()), ("ends", pa.string()),
    ])

    def step(row: dict) -> tuple:
        cell, illegal, ends = _joined(row["pieces"])
        sizes = [{"piece": p["piece"], "size": p["size"]} for p in row["pieces"]]
        return row["conv_id"], row["_part"], sizes, _packed(cell), illegal, ends

    return lambda batches: _mapped(batches, step, kind)


def cut_audit(audit: str, sizes: list[int]) -> list[str]:
    """The audit of each of adjacent spans; inserts go with the row after them, the last ones with the last."""
    out, at = [], 0
    for size in sizes:
        begin = at
        while size:
            size -= audit[at] != "I"
            at += 1
        out.append(audit[begin:at])
    out[-1] += audit[at:]
    return out


def _deciding(conv: pa.DataType):
    """Ranges of a conversation to its cost and audit, and the audit of every piece."""
    edits = pa.list_(pa.struct([
        ("part", pa.int32()), ("piece", pa.int64()), ("audit", pa.string()), ("before", pa.int64()),
    ]))
    kind = pa.schema([
        ("conv_id", conv), ("cost", pa.int64()), ("audit", pa.string()), ("illegal", pa.int64()), ("n_turns", pa.int64()), ("edits", edits),
    ])

    def step(row: dict) -> tuple:
        cell, illegal, _ = _joined(row["parts"])
        cost, audit = min(cell[s] for s in ((START, START), (START, ASSISTANT)) if s in cell)
        places = [(p["_part"], q["piece"], q["size"]) for p in row["parts"] for q in p["sizes"]]
        turns, edits = 0, []
        for (part, piece, _), own in zip(places, cut_audit(audit, [size for *_, size in places]), strict=True):
            edits.append({"part": part, "piece": piece, "audit": own, "before": turns})
            turns += len(own) - own.count("D")
        return row["conv_id"], cost, audit, illegal, turns, edits

    return lambda batches: _mapped(batches, step, kind)


def repaired_turns(rows: list[dict], audit: str, before: int, n_turns: int) -> list[dict]:
    """Rows of a piece after its edits. Roles follow from the place: those set or inserted alternate."""
    out, left = [], iter(rows)
    for edit in audit:
        row = next(left) if edit != "I" else None
        if edit == "D":
            continue
        at = before + len(out) - n_turns % 2
        role, text = ("user", "assistant")[at % 2], ""
        if row:
            role, text = row["role"] if edit == "K" else role, row["text"]
        out.append({"edit": edit, "role": role, "text": text})
    return out


def _writing(conv: pa.DataType):
    turn = pa.struct([("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
    kind = pa.schema([("conv_id", conv), ("part", pa.int32()), ("piece", pa.int64()), ("turns", pa.list_(turn))])

    def step(row: dict) -> tuple:
        turns = repaired_turns(row["rows"], row["audit"], row["before"], row["n_turns"])
        return row["conv_id"], row["_part"], row["piece"], turns

    return lambda batches: _mapped(batches, step, kind)


def repair(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Summary and repaired turns of ``conversations`` (conv_id, turn, role, text).

    Summary: conv_id, gaps (turns missing between the first and the last), blank, duplicate, truncated,
    illegal (adjacent roles that may not be), cost, audit; one row a conversation. Repaired turns: conv_id,
    part, piece and ``turns``, an array of (edit, role, text); arrays along (part, piece) are the conversation.
    """
    space = F.lit(" ")
    rows = pick(conversations, "conv_id", "turn", "role", "text").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"),
    )
    hashed = F.xxhash64("role", "text")
    placed = ordered.in_order(rows, "conv_id", "turn", "role", F.substring("text", 1, 64), hashed)
    # The last character that is no white space, and what a row is a duplicate of.
    last = F.right(F.rtrim("text", F.lit(" \t\n\x0b\x0c\r")), F.lit(1))
    light = placed.select(
        "conv_id", "turn", "_part", "_at", hashed.alias("h1"), F.xxhash64(F.lit(1), "text", "role").alias("h2"),
        F.when(F.col("role") == "", space).otherwise(F.substring("role", 1, 1)).alias("initial"),
        F.when(last == "", "b").when(last.isin(".", "!", "?"), ".").otherwise("t").alias("fault"),
    )
    light = written(light, "light")
    first = light.groupBy("conv_id", "h1", "h2").agg(F.min("_at").alias("_at")).select("_at", F.lit(True).alias("is_first"))
    fault = F.when((F.col("fault") != "b") & F.col("is_first").isNull(), "d").otherwise(F.col("fault"))
    within = ordered.within_part("conv_id")
    piece = F.call_function("div", F.row_number().over(within) - 1, F.lit(PIECE)).cast("long")
    marked = written(
        light.join(first, "_at", "left").withColumn("fault", fault).withColumn("piece", piece)
        .select("conv_id", "turn", "_part", "_at", "piece", "initial", "fault"), "marked",
    )
    conv = pa.int64()
    rows_of = F.array_sort(F.collect_list(F.struct("_at", "initial", "fault")))
    pieces = marked.groupBy("conv_id", "_part", "piece").agg(rows_of.alias("r")).select(
        "conv_id", "_part", "piece", F.array_join("r.initial", "").alias("roles"), F.array_join("r.fault", "").alias("faults")
    ).mapInArrow(
        _parsing(conv), f"conv_id long, _part int, piece long, size long, cell {_CELL_SQL}, illegal long, ends string"
    )
    ranges = pieces.groupBy("conv_id", "_part").agg(
        F.array_sort(F.collect_list(F.struct("piece", "size", "cell", "illegal", "ends"))).alias("pieces")
    ).mapInArrow(
        _merging(conv),
        f"conv_id long, _part int, sizes array<struct<piece: bigint, size: bigint>>, cell {_CELL_SQL}, illegal long, ends string",
    )
    decided = written(ranges.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("_part", "sizes", "cell", "illegal", "ends"))).alias("parts")
    ).mapInArrow(
        _deciding(conv),
        "conv_id long, cost long, audit string, illegal long, n_turns long,"
        " edits array<struct<part: int, piece: bigint, audit: string, before: bigint>>",
    ), "decided")
    turns = marked.where("turn is not null").groupBy("conv_id", "turn").agg(F.lit(1).alias("one")).groupBy("conv_id").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count("*")).alias("gaps")
    )
    counts = marked.groupBy("conv_id").agg(
        *[F.count_if(F.col("fault") == name[0]).alias(name) for name in ("blank", "duplicate", "truncated")]
    )
    same = [F.col("c.conv_id").eqNullSafe(F.col(f"{x}.conv_id")) for x in ("t", "d")]
    summary = counts.alias("c").join(turns.alias("t"), same[0], "left").join(decided.alias("d"), same[1]).select(
        "c.conv_id", F.coalesce("t.gaps", F.lit(0)).cast("long").alias("gaps"), "c.blank", "c.duplicate", "c.truncated",
        "d.illegal", "d.cost", "d.audit",
    )
    return summary, _repaired(placed, piece, decided, conv)


def _repaired(placed: DataFrame, piece, decided: DataFrame, conv: pa.DataType) -> DataFrame:
    """Rows of every piece meet its audit; what does not fit a piece is never together."""
    held = placed.select("conv_id", "_part", "_at", "role", "text").withColumn("piece", piece)
    held = held.groupBy("conv_id", "_part", "piece").agg(
        F.array_sort(F.collect_list(F.struct("_at", "role", "text"))).alias("r")
    ).select("conv_id", "_part", "piece", F.transform("r", lambda x: F.struct(x["role"], x["text"])).alias("rows"))
    edits = decided.select("conv_id", "n_turns", F.explode("edits").alias("e")).select(
        F.col("conv_id").alias("of"), F.col("e.part").alias("part"), F.col("e.piece").alias("nth"), "e.audit", "e.before", "n_turns"
    )
    met = held.join(
        edits, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("_part") == F.col("part")) & (F.col("piece") == F.col("nth"))
    )
    return met.select("conv_id", "_part", "piece", "rows", "audit", "before", "n_turns").mapInArrow(
        _writing(conv), "conv_id long, part int, piece long, turns array<struct<edit: string, role: string, text: string>>"
    )
