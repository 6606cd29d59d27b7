"""Conversation repair and the conversation trie against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from syncflow.llm import conversation_repair as repair
from syncflow.llm import conversation_trie, queries

ODD = "role string, conv_id long, TURN_ string, turn long, text string, piece int, `a.b` int, _at long, cell string"


def odd_conversations(seed=1, n=60):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(n), 150, 207, 250, None]:
        for turn in range(rng.choice([0, 1, 2, 3, 5, 7, 9])):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "", "unknown"])
            text = rng.choice(["Hello there.", "So it is!", "cut off", "", None, " \n", "é日本?", "a" * 5000, "x. \t", "Hello there."])
            at = rng.choice([turn, turn, turn, turn + 3, None])
            rows.append((conv, at, role, text))
    # One long conversation, equal beginnings, repeated rows.
    rows += [(500, i, ("user", "assistant")[i % 2], f"turn {i % 40}.") for i in range(700)]
    for conv in (300, 301, 302, 303):
        rows += [(conv, i, ("user", "assistant")[i % 2], f"same {i}.") for i in range(6)]
    return rows + rows[-3:]


def frame(spark, rows):
    return spark.createDataFrame([(r, c, "z", t, x, 1, 2, 3, "c") for c, t, r, x in rows], ODD)


def in_turn(rows, conv):
    """Rows of one conversation as the operators order them."""
    held = [r for r in rows if r[0] == conv]
    return sorted(held, key=lambda r: (r[1] is not None, r[1] or 0, (r[2] or "").encode(), (r[3] or "").encode()))


# Repair


def damage(rows):
    out = []
    for c, t, role, text in rows:
        fate = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fate == 0:
            continue
        role = "user" if fate == 4 else role
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        out += [(c, t, role, text)] * (2 if fate == 3 else 1)
    return out


def first_faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        visible = re.findall(r"[^\x20\x09-\x0D]", text)
        if not visible:
            out.append("b")
        elif (role, text) in seen:
            out.append("d")
        else:
            out.append("." if visible[-1] in ".!?" else "t")
        seen.add((role, text))
    return out


def cheapest(initials, faults):
    """Least (cost, audit) by search over (row, state), from the back; inserts of one or two turns in a row."""
    n = len(initials)

    @lru_cache(None)
    def best(i, state, inserted):
        found = []
        if i == n and state in (repair.START, repair.ASSISTANT):
            found.append((0, ""))
        if inserted < 3:
            for role in "ua":
                if (state, role) in repair.STEP:
                    cost, audit = best(i, repair.STEP[state, role], inserted + 1)
                    found.append((cost + 5, "I" + audit))
        if i < n:
            cost, audit = best(i + 1, state, 0)
            found.append((cost + 2, "D" + audit))
            if faults[i] not in "bd":
                extra = 5 if faults[i] == "t" else 0
                for role in "sua":
                    if (state, role) in repair.STEP:
                        cost, audit = best(i + 1, repair.STEP[state, role], 0)
                        if role == initials[i]:
                            found.append((cost + extra, "K" + audit))
                        if role != "s":
                            found.append((cost + extra + 1, "R" + audit))
        return min(found, default=(10**9, ""))

    for i in range(n, 0, -1):  # from the back, so that nothing recurses far
        for state in range(4):
            best(i, state, 0)
    return best(0, repair.START, 0)


def replayed(rows, audit):
    out, left = [], iter(rows)
    total = len(audit) - audit.count("D")
    for edit in audit:
        row = next(left) if edit != "I" else None
        if edit == "D":
            continue
        place = len(out) - total % 2
        if edit == "K":
            out.append(f"{row[2]}:{row[3]}")
        else:
            out.append(f"{('user', 'assistant')[place % 2]}:{row[3] if row else ''}")
    return out


def brute_repair(given):
    rows, out = damage(given), []
    for conv in {r[0] for r in given}:
        held = in_turn(rows, conv)
        faults = first_faults(held)
        initials = [r[2][:1] or " " for r in held]
        turns = [r[1] for r in held if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        cost, audit = cheapest(initials, faults)
        lines = replayed(held, audit)
        assert re.fullmatch("(s?(ua)+)?", "".join(line[:1] for line in lines))
        body = "\n".join(lines)
        out.append((
            conv, gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit,
            hashlib.sha256(body.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


@pytest.fixture
def tables(spark, tmp_path):
    def write(rows):
        frame(spark, rows).repartition(5).write.mode("overwrite").parquet(f"{tmp_path}/conversations.parquet")
        return str(tmp_path)

    return write


def test_repair_equals_brute_force(spark, tables):
    rows = odd_conversations()
    got = queries.op12_conversation_repair(spark, tables(rows))
    assert sorted(map(tuple, got.collect()), key=repr) == brute_repair(rows)
    assert [t for _, t in got.dtypes] == ["bigint"] * 7 + ["string"] * 2


def test_repair_in_small_pieces(spark, tables, monkeypatch):
    monkeypatch.setattr(repair, "PIECE", 3)
    rows = odd_conversations(seed=2, n=30)
    got = queries.op12_conversation_repair(spark, tables(rows))
    assert sorted(map(tuple, got.collect()), key=repr) == brute_repair(rows)


def test_repair_of_given_table(spark, sf_dir):
    rows = [tuple(r) for r in queries.table(spark, sf_dir, "conversations").collect()]
    got = queries.op12_conversation_repair(spark, sf_dir)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_repair(rows)


def test_every_split_gives_the_same_cell():
    rng = random.Random(5)
    for _ in range(30):
        cells = [repair.row_cell(rng.choice("suat "), rng.choice("..bdt")) for _ in range(rng.randint(1, 9))]
        n = len(cells)
        chart = {(i, i + 1): c for i, c in enumerate(cells)}
        for length in range(2, n + 1):
            for i in range(n - length + 1):
                splits = [repair.combined(chart[i, k], chart[k, i + length]) for k in range(i + 1, i + length)]
                assert all(s == splits[0] for s in splits)
                chart[i, i + length] = splits[0]
        assert repair.spans_combined(cells) == chart[0, n]


def test_empty_and_dropped_conversations(spark, tables):
    assert queries.op12_conversation_repair(spark, tables([])).collect() == []
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = queries.op12_conversation_repair(spark, tables([(gone, 0, "user", "a.")])).collect()
    assert [tuple(r) for r in got] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_very_long_text_is_repaired_whole(spark, tables):
    rows = [(1, 1, "user", "word " * 2_000_000 + "."), (1, 2, "assistant", "y" * 3_000_000 + "!" + " " * 1_000_000)]
    got = queries.op12_conversation_repair(spark, tables(rows))
    assert sorted(map(tuple, got.collect()), key=repr) == brute_repair(rows)


# Trie


def brute_trie(given):
    ids = sorted({r[0] for r in given if r[0] is not None})
    turns = {c: [(r[2] or "", r[3] or "") for r in in_turn(given, c)] for c in ids}
    rebuilt = {}
    for c in ids:
        heads = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = tuple(turns.get(c - c % 100, [])[:heads] + turns[c][heads:])
    members = {}
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
    children, leaves, saved = {}, {}, {}
    for node in members:
        if node:
            children[node[:-1]] = children.get(node[:-1], 0) + 1
    for node, held in members.items():
        worth = (len(held) - 1) * (len(node[-1][1]) if node else 0)
        for d in range(len(node) + 1):
            saved[node[:d]] = saved.get(node[:d], 0) + worth
            leaves[node[:d]] = leaves.get(node[:d], 0) + (node not in children)
    return sorted((
        (
            min(held), len(node), min(members[node[:-1]]) if node else None, len(held), children.get(node, 0), leaves[node],
            saved[node], hashlib.sha256(",".join(str(c) for c in sorted(held) if len(rebuilt[c]) == len(node)).encode()).hexdigest(),
        ) for node, held in members.items()
    ), key=repr)


@pytest.mark.parametrize(("band", "piece", "hot"), [(8, 1024, 1000), (2, 4, 3)])
def test_trie_equals_brute_force(spark, tables, monkeypatch, band, piece, hot):
    monkeypatch.setattr(conversation_trie, "HOT", hot)
    monkeypatch.setattr(conversation_trie, "BAND", band)
    monkeypatch.setattr(conversation_trie, "PIECE", piece)
    rows = odd_conversations(seed=band, n=40 if band > 2 else 12)
    rows = rows if piece == 1024 else [r for r in rows if r[0] != 500 or r[1] < 90]
    got = queries.op13_conversation_trie(spark, tables(rows))
    assert sorted(map(tuple, got.collect()), key=repr) == brute_trie(rows)
    assert [t for _, t in got.dtypes] == ["bigint"] * 7 + ["string"]


def test_trie_of_given_and_empty_table(spark, sf_dir, tables):
    rows = [tuple(r) for r in queries.table(spark, sf_dir, "conversations").collect()]
    got = queries.op13_conversation_trie(spark, sf_dir)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_trie(rows)
    assert queries.op13_conversation_trie(spark, tables([])).collect() == []
