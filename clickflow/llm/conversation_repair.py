"""Conversation structure repair by depth-first branch-and-bound.

A conversation is in shape if the first letters of its roles read
``(s?(ua)+)?``: an optional system turn, then users and assistants by turns.
Each row has at most one fault, the first that counts: blank, duplicate (role
and text seen earlier), truncated (no end of sentence).  Edits and costs:

    K keep 0    R change the role to user or assistant 2    D delete 3
    I insert an empty turn of a user or assistant 2

Blank and duplicate rows must be deleted; a truncated row that stays costs 1
more.  The cheapest edits win, among equals those whose letters come first.

The search keeps an explicit stack.  A node is (rows read, state of the
grammar, cost, letters so far).  It is dropped if its cost and a lower bound
for the rows that follow exceed the incumbent's cost, if at equal cost its
letters come after the incumbent's, or if the table of its (rows read, state)
holds a cheaper or earlier way there.  When the stack is empty the incumbent
is proved best.

Long conversations.  For the search a row is one letter.  A conversation is
cut into pieces of ``PIECE_ROWS`` rows; each piece is solved on its own, from
every state it can begin in to every state it can end in, and the pieces'
answers are put together in order.  That is exact: two ways through the same
rows, from state to state, at equal cost, have letters of which neither is the
beginning of the other (a longer one has more inserts, which cost), so the
better of them is better whatever follows.  Rows with their texts are joined by
position and are never gathered by conversation.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickflow.llm.common import materialize
from clickflow.operators.sequence import keyed_row_number

PIECE_ROWS = 64
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1  # costs
BLANKS = " \t\n\x0b\x0c\r"

# States: nothing yet, after a system turn, after a user, after an assistant.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTED = (EMPTY, ASSISTANT)
_KEPT = {("s", EMPTY): SYSTEM, ("u", EMPTY): USER, ("u", SYSTEM): USER, ("u", ASSISTANT): USER, ("a", USER): ASSISTANT}
_LEGAL = {"su", "ua", "au"}
# A row's letter: its role's first letter (x: any other), upper case if truncated, a digit if it must be deleted.
_SOUND, _CUT, _GONE = "suax", "SUAX", "1234"


def _initial(symbol: str) -> str:
    return _SOUND[int(symbol) - 1] if symbol in _GONE else symbol.lower()


def _needed(state: int) -> int:
    """The state after the turn that may come next (a user's, or an assistant's after a user)."""
    return ASSISTANT if state == USER else USER


def suffix_bounds(symbols: str) -> list[int]:
    """For each position, a cost that the rows from there on need at least, whatever came before.

    Deletions that must be, truncated rows, roles that no shape has, system
    turns but for one; and in a run of m equal letters, of which no two may
    stay neighbours, 2 * (m // 2): a change of role parts two pairs, an insert
    one.
    """
    bounds, run, last = [0], 0, ""
    systems = 0
    for symbol in reversed(symbols):
        cost = bounds[-1]
        if symbol in _GONE:
            cost += DELETE
        else:
            letter = symbol.lower()
            cost += TRUNCATED * symbol.isupper()
            run = run + 1 if letter == last and letter in "ua" else 1
            last = letter
            cost += REROLE * (letter == "x" or run % 2 == 0)
            if letter == "s":
                systems += 1
                cost += REROLE * (systems > 1)
        bounds.append(cost)
    bounds.reverse()
    return bounds


def branch_and_bound(symbols: str, begin: int = EMPTY, ends: tuple[int, ...] = ACCEPTED) -> tuple[int, str] | None:
    """(cost, letters) of the best edits that lead from state ``begin`` to one of ``ends``, or None if none do."""
    bounds, n = suffix_bounds(symbols), len(symbols)
    best: tuple[int, str] | None = None
    tables: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, begin, 0, "")]
    while stack:
        at, state, cost, audit = stack.pop()
        if state > SYSTEM and ends[-1] <= SYSTEM or state == SYSTEM and ends == (EMPTY,):
            continue  # no way back to a state before the first turn
        if best is not None:
            reach = cost + bounds[at]
            if reach > best[0] or reach == best[0] and audit > best[1][:len(audit)]:
                continue
        known = tables.get((at, state))
        if known is not None and known <= (cost, audit):
            continue
        tables[at, state] = cost, audit
        if at == n and state in ends:
            if best is None or (cost, audit) < best:
                best = cost, audit
            continue
        needed = _needed(state)
        children = [(at, needed, cost + INSERT, audit + "I")]
        if at < n:
            symbol = symbols[at]
            children.append((at + 1, state, cost + DELETE, audit + "D"))
            if symbol not in _GONE:
                stays = cost + TRUNCATED * symbol.isupper()
                children.append((at + 1, needed, stays + REROLE, audit + "R"))
                kept = _KEPT.get((symbol.lower(), state))
                if kept is not None:
                    children.append((at + 1, kept, stays + KEEP, audit + "K"))
        # The last one pushed is looked at first: cheapest, then earliest letter.
        children.sort(key=lambda c: (c[2] + bounds[c[0]], c[3]), reverse=True)
        stack += children
    return best


def solve_piece(symbols: str, first: bool) -> list[tuple[int, int, int, str]]:
    """(begin, end, cost, letters) for every pair of states that a piece can lead from and to."""
    found = []
    for begin in (EMPTY,) if first else range(4):
        for end in range(begin if begin <= SYSTEM else USER, 4):
            best = branch_and_bound(symbols, begin, (end,))
            if best is not None:
                found.append((begin, end, *best))
    return found


class Joined:
    """A conversation's pieces put together in order; keeps what is not yet decided, and one letter a row."""

    def __init__(self):
        self.decided: list[tuple[int, str, str]] = []  # (begin, letters, symbols) of each piece
        self.open: dict[int, tuple[int, str, list]] = {EMPTY: (0, "", [])}
        self.illegal, self.last = 0, ""

    def add(self, symbols: str, solutions: list[tuple[int, int, int, str]]) -> None:
        for symbol in symbols:
            letter = _initial(symbol)
            self.illegal += bool(self.last) and self.last + letter not in _LEGAL
            self.last = letter
        reached: dict[int, tuple[int, str, list]] = {}
        for begin, end, cost, audit in solutions:
            if begin in self.open:
                spent, tail, chosen = self.open[begin]
                way = spent + cost, tail + audit, [*chosen, (begin, audit, symbols)]
                if end not in reached or way[:2] < reached[end][:2]:
                    reached[end] = way
        # Pieces on which all ways agree are decided.
        ways = list(reached.values())
        same = 0
        while same < len(ways[0][2]) and all(w[2][same] == ways[0][2][same] for w in ways):
            same += 1
        self.decided += ways[0][2][:same]
        shared = sum(len(a) for _, a, _ in ways[0][2][:same])
        self.open = {end: (cost, tail[shared:], chosen[same:]) for end, (cost, tail, chosen) in reached.items()}

    def result(self) -> tuple[int, list[tuple[int, str, str]]]:
        cost, _, chosen = min((w for end, w in self.open.items() if end in ACCEPTED), key=lambda w: w[:2])
        return cost, self.decided + chosen


def edits_of(begin: int, audit: str, symbols: str) -> Iterator[tuple[int | None, str, str | None]]:
    """(row in the piece or None for an insert, letter, new role or None) of each edit."""
    state, row = begin, 0
    for edit in audit:
        role = None
        if edit in "RI":
            state = _needed(state)
            role = "user" if state == USER else "assistant"
        elif edit == "K":
            state = _KEPT[symbols[row].lower(), state]
        yield (None if edit == "I" else row), edit, role
        row += edit != "I"


class Repaired(NamedTuple):
    conversations: DataFrame
    turns: DataFrame


def _same(a: DataFrame, b: DataFrame, *cols: str) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & a[c].eqNullSafe(b[c])
    return cond


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           piece_rows: int = PIECE_ROWS) -> Repaired:
    """Repair every conversation of ``rows``.

    ``conversations``: ``conv``, gaps, blank, duplicate, truncated, illegal,
    cost (longs), audit; a row per conversation.  ``turns``: ``conv``, step
    (place of the edit in the audit, from 1), edit, role, text; the rows that
    the repaired conversations consist of (edits K, R and I).

    Rows are taken by turn, nulls first, ties by role and SHA-256 of the text
    (rows equal in all three are repeats of one another).  A null role or text
    is one space: an unknown role, a blank text.  A null ``conv`` is a
    conversation.  ``gaps`` is max - min + 1 - distinct turns, nulls ignored
    (0 if all are null).  An empty table gives empty results.  Other columns
    are ignored, whatever their names.

    Positions in a conversation come from pieces, duplicates from the smallest
    position of each (conversation, role, text), so no conversation is one
    task; the letters of its rows, one each, come together as the audit does.
    """
    space = F.lit(" ")
    slim = rows.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role), space).alias("role"),
                       F.coalesce(F.col(text), space).alias("text"))
    base = materialize(keyed_row_number(slim.withColumn("sha", F.sha2("text", 256)), ["conv"], ["turn", "role", "sha"],
                                        "pos"), "conversations")
    end = F.rtrim(F.col("text"), F.lit(BLANKS))
    judged = base.select("conv", "turn", "pos", F.substring("role", 1, 1).alias("letter"), (end == "").alias("blank"),
                         (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("cut"))
    firsts = base.groupBy("conv", "role", "sha").agg(F.min("pos").alias("pos")).select("conv", "pos", F.lit(True).alias("is_first"))
    marked = judged.join(firsts, _same(judged, firsts, "conv", "pos"), "left").select(
        judged["conv"], judged["pos"], "turn", "letter", "blank", (~F.col("blank") & F.col("is_first").isNull()).alias("twice"),
        "cut")
    kind = F.when(F.col("blank") | F.col("twice"), F.lit(_GONE)).when(F.col("cut"), F.lit(_CUT)).otherwise(F.lit(_SOUND))
    known = F.when(F.col("letter").isin(*"sua"), F.instr(F.lit(_SOUND), F.col("letter"))).otherwise(4)
    symbols = materialize(marked.select(
        "conv", "turn", "pos", "blank", "twice", (F.col("cut") & ~F.col("blank") & ~F.col("twice")).alias("cut"),
        F.substring(kind, known, F.lit(1)).alias("symbol")), "symbols")

    def total(c: str) -> Column:
        return F.sum(F.col(c).cast("long")).alias(c)
    by_turn = symbols.groupBy("conv", "turn").agg(total("blank"), total("twice"), total("cut"))
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long")
    counts = by_turn.groupBy("conv").agg(gaps.alias("gaps"), total("blank"), F.sum("twice").alias("duplicate"),
                                         F.sum("cut").alias("truncated"))

    piece = F.floor((F.col("pos") - 1) / piece_rows).cast("long").alias("piece")
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("pos", "symbol"))), lambda s: s["symbol"])
    pieces = symbols.groupBy("conv", piece).agg(F.array_join(ordered, "").alias("symbols"))
    kind_of_conv = dict(slim.dtypes)["conv"]
    solutions = "array<struct<a: int, b: int, cost: bigint, audit: string>>"
    solved = pieces.mapInArrow(_solve, f"conv {kind_of_conv}, piece bigint, symbols string, found {solutions}")
    joined = materialize(
        solved.repartition("conv").sortWithinPartitions("conv", "piece").mapInArrow(
            _join, f"conv {kind_of_conv}, piece bigint, begin int, start bigint, symbols string, audit string, "
                   "cost bigint, illegal bigint"), "audits")
    audits = joined.where("piece is null").select("conv", "illegal", "cost", "audit")
    conversations = counts.join(audits, _same(counts, audits, "conv")).select(
        counts["conv"].alias(conv), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")

    edits = joined.where("piece is not null").mapInArrow(
        _edits(piece_rows), f"conv {kind_of_conv}, step bigint, pos bigint, edit string, new_role string").where("edit <> 'D'")
    texts = base.select("conv", "pos", "role", "text")
    turns = edits.join(texts, _same(edits, texts, "conv") & (edits["pos"] == texts["pos"]), "left").select(
        edits["conv"].alias(conv), "step", "edit", F.coalesce("new_role", "role").alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
    return Repaired(conversations, turns)


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
    for batch in batches:
        found = [[dict(zip(("a", "b", "cost", "audit"), s)) for s in solve_piece(symbols, piece == 0)]
                 for piece, symbols in zip(batch.column("piece").to_pylist(), batch.column("symbols").to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("piece"), batch.column("symbols"),
                                          pa.array(found, kind)], names=["conv", "piece", "symbols", "found"])


_JOINED = ["conv", "piece", "begin", "start", "symbols", "audit", "cost", "illegal"]


def _join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a conversation (null piece) and one a piece, from pieces sorted by conversation and number."""
    now, whole, out = None, None, []

    def rows(conv, done: Joined) -> Iterator[dict]:
        cost, chosen = done.result()
        yield {"conv": conv, "audit": "".join(a for _, a, _ in chosen), "cost": cost, "illegal": done.illegal}
        start = 0
        for number, (begin, audit, symbols) in enumerate(chosen):
            yield {"conv": conv, "piece": number, "begin": begin, "start": start, "symbols": symbols, "audit": audit}
            start += len(audit)

    def batch_of(found: list[dict]) -> pa.RecordBatch:
        kinds = [kind, pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array([f.get(c) for f in found], k) for c, k in zip(_JOINED, kinds)],
                                          names=_JOINED)
    for batch in batches:
        kind = batch.column("conv").type
        for row in batch.to_pylist():
            if whole is None or row["piece"] == 0:  # a new conversation
                if whole is not None:
                    out += rows(now, whole)
                now, whole = row["conv"], Joined()
            whole.add(row["symbols"], [(s["a"], s["b"], s["cost"], s["audit"]) for s in row["found"]])
            if len(out) >= 5_000:
                yield batch_of(out)
                out = []
    if whole is not None:
        yield batch_of(out + list(rows(now, whole)))


def _edits(piece_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                steps = list(edits_of(row["begin"], row["audit"], row["symbols"]))
                at = [None if r is None else row["piece"] * piece_rows + r + 1 for r, _, _ in steps]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["conv"]] * len(steps), batch.column("conv").type),
                     pa.array(range(row["start"] + 1, row["start"] + 1 + len(steps)), pa.int64()), pa.array(at, pa.int64()),
                     pa.array([e for _, e, _ in steps], pa.string()), pa.array([r for _, _, r in steps], pa.string())],
                    names=["conv", "step", "pos", "edit", "new_role"])
    return run


def digests(turns: DataFrame, conv: str = "conv_id") -> DataFrame:
    """``conv`` and repaired_sha256: of the ``role:text`` of its rows by step, joined by line ends.

    A digest is made from first to last, so a conversation's rows stream
    through one task, in order; no more than a batch of them is in memory.
    """
    line = F.concat("role", F.lit(":"), "text")
    ordered = turns.select(F.col(conv).alias("conv"), "step", line.alias("line")).repartition("conv").sortWithinPartitions(
        "conv", "step")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = sha = None
        for batch in batches:
            kind, done = batch.column("conv").type, []
            for key, turn_line in zip(batch.column("conv").to_pylist(), batch.column("line").to_pylist()):
                if sha is None or key != now:
                    if sha is not None:
                        done.append((now, sha.hexdigest()))
                    now, sha = key, hashlib.sha256(turn_line.encode())
                else:
                    sha.update(b"\n" + turn_line.encode())
            yield _digest_batch(done, kind)
        if sha is not None:
            yield _digest_batch([(now, sha.hexdigest())], kind)
    kind_of_conv = dict(ordered.dtypes)["conv"]
    return ordered.mapInArrow(run, f"conv {kind_of_conv}, repaired_sha256 string").withColumnRenamed("conv", conv)


def _digest_batch(done: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], kind), pa.array([d[1] for d in done], pa.string())],
                                      names=["conv", "repaired_sha256"])


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``rows`` with faults, chosen by crc32(``conv:turn``) mod 20 (a null there is one space, as are null roles and texts).

    0 drops a row, 1 empties its text, 2 removes its ends of sentences, 3
    repeats it, 4 makes it a user's.  Columns: conv, turn, role, text.
    """
    space = F.lit(" ")
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in (conv, turn)])
    dice = (F.crc32(name.cast("binary")) % 20).alias("dice")
    rolled = rows.select(F.col(conv), F.col(turn), F.coalesce(F.col(role), space).alias(role),
                         F.coalesce(F.col(text), space).alias(text), dice).where("dice <> 0")
    words = F.when(F.col("dice") == 1, "").when(F.col("dice") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(F.col(text))
    copies = F.explode(F.when(F.col("dice") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rolled.select(conv, turn, F.when(F.col("dice") == 4, "user").otherwise(F.col(role)).alias(role),
                         words.alias(text), copies.alias("copy")).drop("copy")


def repair_damaged(rows: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Every conversation of ``rows``, damaged and repaired, with the digest of what it became (see ``repair``)."""
    found = repair(damage(rows, conv), conv)
    hashes, told = digests(found.turns, conv), found.conversations
    every = rows.select(conv).distinct()
    both = every.join(told, _same(every, told, conv), "left").drop(told[conv])
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    nothing = hashlib.sha256(b"").hexdigest()
    return both.join(hashes, _same(both, hashes, conv), "left").select(
        both[conv], *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))
