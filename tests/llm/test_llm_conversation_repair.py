"""Conversation repair against dynamic programming, and whole conversations against a plain version."""
from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from clickflow.llm import conversation_repair as cr

SCHEMA = "conv_id long, turn long, role string, text string"
SPACES = " \t\n\x0b\x0c\r"


def cheapest(symbols, begin, ends):
    """Best (cost, letters) by dynamic programming over rows and states."""
    def with_inserts(reached):
        for _ in range(3):
            for state, (cost, audit) in list(reached.items()):
                to, way = cr._needed(state), (cost + 2, audit + "I")
                reached[to] = min(way, reached.get(to, way))
        return reached
    reached = with_inserts({begin: (0, "")})
    for symbol in symbols:
        new = {}
        for state, (cost, audit) in reached.items():
            cut = int(symbol.isupper())
            ways = [(state, (cost + 3, audit + "D"))]
            if symbol not in "1234":
                ways.append((cr._needed(state), (cost + 2 + cut, audit + "R")))
                if (symbol.lower(), state) in cr._KEPT:
                    ways.append((cr._KEPT[symbol.lower(), state], (cost + cut, audit + "K")))
            for to, way in ways:
                new[to] = min(way, new.get(to, way))
        reached = with_inserts(new)
    return min((reached[e] for e in ends if e in reached), default=None)


def test_branch_and_bound_is_optimal():
    rng = random.Random(5)
    for letters in ("suaxSUAX1234uuaaua", "sS", "uU", "uaUA", "s1u"):
        for _ in range(150):
            symbols = "".join(rng.choices(letters, k=rng.randint(0, 14)))
            assert cr.branch_and_bound(symbols) == cheapest(symbols, cr.EMPTY, cr.ACCEPTED)
            for begin in range(4):
                for end in range(4):
                    assert cr.branch_and_bound(symbols, begin, (end,)) == cheapest(symbols, begin, (end,))
            bounds = cr.suffix_bounds(symbols)
            for i in range(len(symbols) + 1):
                assert all(bounds[i] <= cheapest(symbols[i:], b, cr.ACCEPTED)[0] for b in range(4))


def test_pieces_join_to_the_optimum():
    rng = random.Random(6)
    for _ in range(200):
        symbols, size = "".join(rng.choices("suaxSUAX12uuaaua", k=rng.randint(1, 50))), rng.randint(1, 9)
        whole = cr.Joined()
        for i in range(0, len(symbols), size):
            whole.add(symbols[i:i + size], cr.solve_piece(symbols[i:i + size], i == 0))
        cost, chosen = whole.result()
        assert (cost, "".join(a for _, a, _ in chosen)) == cheapest(symbols, cr.EMPTY, cr.ACCEPTED)


def plain(rows):
    """One conversation's result, row by row (role and text already without nulls)."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
    seen, symbols, n = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in rows:
        body = text.rstrip(SPACES)
        fault = ("blank" if not body else "duplicate" if (role, text) in seen else
                 "truncated" if body[-1] not in ".!?" else None)
        seen.add((role, text))
        kind = "suax".find(role[:1] or "x")
        kind = 3 if kind < 0 else kind
        symbols += ("SUAX" if fault == "truncated" else "1234" if fault else "suax")[kind]
        if fault:
            n[fault] += 1
    cost, audit = cheapest(symbols, cr.EMPTY, cr.ACCEPTED)
    out, at, last = [], 0, ""
    for edit in audit:
        row = rows[at] if edit != "I" else (None, "", "")
        at += edit != "I"
        if edit == "D":
            continue
        role = row[1] if edit == "K" else "assistant" if last[:1] == "u" else "user"
        out.append(f"{role}:{row[2]}")
        last = role
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit,
            hashlib.sha256("\n".join(out).encode()).hexdigest())


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        dice = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if dice == 1 else text.translate(dict.fromkeys(map(ord, ".!?"))) if dice == 2 else text
        if dice:
            out += [(conv, turn, "user" if dice == 4 else role, text)] * (2 if dice == 3 else 1)
    return out


NUMBERS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]


def _random_rows(rng, n_convs, most):
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "User"]
    texts = ["Hello.", "Hello.", "Yes!", "no end", "", "  \t", None, "What?", "é. \n", " ", "x\x0b."]
    return [(conv if conv else None, rng.choice([turn, turn, turn, None, 3]), rng.choice(roles), rng.choice(texts))
            for conv in range(n_convs) for turn in range(rng.randint(0, most))]


def test_whole_conversations(spark):
    rng = random.Random(8)
    rows = _random_rows(rng, 60, 12)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = {r.conv_id: tuple(r[c] for c in [*NUMBERS, "repaired_sha256"]) for r in cr.repair_damaged(df).collect()}
    damaged = {}
    for conv, *row in plain_damage(rows):
        damaged.setdefault(conv, []).append(row)
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got == {conv: plain(damaged[conv]) if conv in damaged else nothing for conv in {r[0] for r in rows}}


def test_a_long_conversation_in_small_pieces(spark):
    rng = random.Random(9)
    rows = [(7, t, rng.choice(["user", "assistant", "user", "assistant", "system"]),
             rng.choice(["A.", "b", f"{t}.", f"{t}!", f"{t}?", ""])) for t in range(400)]
    rows += [(8, 0, "user", "Q?"), (8, 1, "assistant", "A.")]
    found = cr.repair(spark.createDataFrame(rows, SCHEMA).repartition(5), piece_rows=16)
    got = {r.conv_id: r for r in found.conversations.collect()}
    want = plain([r[1:] for r in rows if r[0] == 7])
    assert tuple(got[7][c] for c in NUMBERS) == want[:-1]
    assert got[8].audit == "KK" and got[8].cost == 0
    sha = {r.conv_id: r.repaired_sha256 for r in cr.digests(found.turns).collect()}
    assert sha[7] == want[-1]
    shape = "".join(r.role[0] for r in found.turns.where("conv_id = 7").orderBy("step").collect())
    assert shape.removeprefix("s") == "ua" * (len(shape) // 2)


def test_repeats_of_one_row_are_duplicates(spark):
    rows = [(1, 0, "user", "Q?")] * 150 + [(1, 1, "assistant", "A.")]
    found = cr.repair(spark.createDataFrame(rows, SCHEMA).repartition(3), piece_rows=8)
    row = found.conversations.first()
    assert (row.duplicate, row.cost, row.gaps) == (149, 447, 0)
    assert row.audit == "K" + "D" * 149 + "K"


def test_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert cr.repair_damaged(empty).count() == 0
    clash = spark.createDataFrame([(1, 0, "user", "Q" * 200_000 + "?"), (1, 1, "assistant", "A.")], SCHEMA).withColumns(
        {c: F.lit(9) for c in ("pos", "conv", "piece", "symbol", "sha", "dice", "copy", "step", "edit")})
    found = cr.repair(clash)
    assert found.conversations.first().audit == "KK"
    assert [len(r.text) for r in found.turns.orderBy("step").collect()] == [200_001, 2]
    nulls = spark.createDataFrame([(None, None, None, None)] * 2, SCHEMA)
    row = cr.repair(nulls).conversations.first()
    assert (row.conv_id, row.blank, row.duplicate, row.audit, row.illegal, row.gaps) == (None, 2, 0, "DD", 1, 0)


@pytest.mark.parametrize("dice", range(5))
def test_damage(spark, dice):
    rows = [(c, t, "assistant", "One. Two! Three?") for c in range(20) for t in range(10)]
    got = sorted(tuple(r) for r in cr.damage(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == sorted(plain_damage(rows))
