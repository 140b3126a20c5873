"""Exact n-gram Jaccard self-join by token-combination prefixes.

A document is the set of its word n-grams, the tokens.  Tokens have one global
order, rare ones before frequent ones, by hash within each class.  Two sets
with Jaccard similarity t lose at most e = floor((1 - t) n) tokens of n, so

* the first e + 1 tokens of each share a token, and
* if those prefixes are extended to e + 1 + g tokens, they share g + 1.

Rare tokens in a prefix are indexed one by one.  A frequent token alone would
bring all its documents together; so where a prefix reaches into the frequent
ones it is extended by g, these are dealt into g classes by hash, and the
pairs of tokens inside each class are indexed: of g + 1 shared tokens two are
in one class.  g grows with the set's size and is the same for two sets that
can link.

Which tokens are frequent is read off a table of 2^20 counters that every
token of every document adds to; a counter never falls short of a token's
true count, so a rare token's group is bounded by the threshold.

Documents with equal sets are one node.  Index entries with the same members
are one group, dealt into blocks of about ``BLOCK`` members by hash.  Within a
block pairs are compared by length and by parity bitmaps: where the bitmaps
differ in more places than linked sets of these sizes can, the pair cannot
link.  Of the pairs that may, a block names a spanning forest, the nearest
first, so fewer than it has members; these are verified on the full sets and
contracted to components.  That joins nearly all of a group of near copies.

What may still link goes on to a last step: the blocks that left pairs out and
the pairs of blocks of larger groups, both only where they are not one
component by then.  It ships the sets of members that may still link into the
blocks: there all partners that are left are verified, and only links that
join two components of the block are written, fewer than it has members.  No
link between components is missed, and no group of copies, or of texts that
nearly link, is ever written out in pairs.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from clickflow.llm.common import materialize

WORDS = 4
PERCENT = 85                 # links: 100 * intersection >= PERCENT * union
COUNTERS = 1 << 20
CHUNK = 1 << 12              # counters that travel together
BLOCK = 1_000                # members compared with each other at once
PARTNERS = 3                 # blocks in which a node has no more partners name all pairs, larger ones a spanning forest
BLOCK_BYTES = 16 << 20       # sets that are compared with each other at once
MEMBERS = 256                # sets verified against one set at once
PRIME = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(text: str | None, k: int = WORDS) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct k-word sequences; fewer words make one, none make none.

    A-Z are lower-cased; words are parted by blanks, tabs and line ends.
    """
    digest = xxhash.xxh3_64_intdigest
    words = np.array([digest(w) for w in text.encode("utf-8", "surrogatepass").lower().split()] if text else [],
                     dtype=np.uint64)
    if not len(words):
        return words
    size = min(k, len(words))
    h = np.full(len(words) - size + 1, size, dtype=np.uint64)
    for i in range(size):
        h = _mix(h * PRIME + words[i:len(words) - size + 1 + i])
    return np.unique(h)


def bitmap_bits(n: int, percent: int) -> int:
    """Bits of a set's parity bitmap: eight times the differences that a link allows, as a power of two.

    The wider, the fewer differences share a bit: pairs with a fifth more than allowed are told apart.
    """
    allowed = 2 * n * (100 - percent) / (100 + percent)
    return 1 << max(6, int(np.ceil(np.log2(max(8 * allowed, 1)))))


def parity_bitmap(tokens: np.ndarray, bits: int) -> bytes:
    """Bit i is the parity of the number of tokens with hash i; two sets' bitmaps differ in at most |x delta y| bits."""
    counts = np.bincount((tokens & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(counts.astype(np.uint8)).tobytes()


def may_link(n: np.ndarray | int, m: np.ndarray | int, different: np.ndarray | int, percent: int):
    """Whether sets of n and m tokens that differ in at least ``different`` can link."""
    return (100 - percent) * (n + m) >= (100 + percent) * different


def classes(n: int, percent: int) -> tuple[int, ...]:
    """Numbers of classes under which a set of n tokens is indexed: its own, and that of sets up to 1/t larger."""
    t = percent / 100
    level = int(np.floor(np.log(n) / -np.log(t) + 1e-9)) if t < 1 else 0

    def at(lev: int) -> int:
        return 1 << max(0, int(np.floor(np.log2(max((1 - t) * t ** -lev / 2, 1)))))
    return tuple(dict.fromkeys((at(level), at(level + 1))))


def signatures(tokens: np.ndarray, frequent: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(single rare tokens, combinations of two frequent tokens) under which a set is indexed."""
    n = len(tokens)
    none = np.zeros(0, dtype=np.uint64)
    lost = n * (100 - percent) // 100
    if not lost and not may_link(n, n + 1, 1, percent):
        return none, none  # links to equal sets only
    rare, often = tokens[~frequent], tokens[frequent]
    if len(rare) > lost:
        return rare[:lost + 1], none
    pairs = []
    for g in classes(n, percent):
        prefix = often[:lost - len(rare) + 1 + g]
        kind = _mix(prefix + np.uint64(g)) % np.uint64(g)
        for c in range(g):
            own = prefix[kind == c]
            if len(own) > 1:
                i, j = np.triu_indices(len(own), 1)
                pairs.append(_mix(_mix(own[i] * PRIME + np.uint64(g)) * PRIME + own[j]))
    return rare, np.concatenate(pairs) if pairs else none


def _node(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    d = xxhash.xxh3_128_digest(tokens.tobytes())
    return tuple(np.frombuffer(d, dtype=np.int64).tolist())


def _scan(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Rows (doc, n, node, check, bits) for each document, and (chunk, counts) for each task's token counters."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(COUNTERS, dtype=np.int64)
        waiting, held = [], 0
        for b in batches:
            out: list[list] = [[], [], [], []]
            for t in b.column("text").to_pylist():
                s = shingles(t, k)
                node, check = _node(s) if len(s) else (None, None)
                for column, value in zip(out, (len(s), node, check,
                                               parity_bitmap(s, bitmap_bits(len(s), percent)) if len(s) else None)):
                    column.append(value)
                waiting.append((s & np.uint64(COUNTERS - 1)).astype(np.int64))
                held += len(s)
                if held > 2_000_000:
                    counters += np.bincount(np.concatenate(waiting), minlength=COUNTERS)
                    waiting, held = [], 0
            size = b.num_rows
            yield _scanned(b.column("doc"), b.column("text_hash"), *out, [None] * size, [None] * size)
        if waiting:
            counters += np.bincount(np.concatenate(waiting), minlength=COUNTERS)
        if counters.any():
            kind = np.uint16 if counters.max() < 1 << 16 else np.int64
            parts = [counters[a:a + CHUNK].astype(kind).tobytes() for a in range(0, COUNTERS, CHUNK)]
            size = len(parts)
            yield _scanned(pa.nulls(size, doc_type), pa.nulls(size, pa.int64()), *[[None] * size] * 4,
                           list(range(size)), parts)

    slim = docs.select("doc", F.xxhash64("text").alias("text_hash"), "text")
    doc_type = to_arrow_type(slim.schema["doc"].dataType)
    return slim.mapInArrow(run, f"doc {dict(slim.dtypes)['doc']}, text_hash bigint, n bigint, node bigint, "
                                "check bigint, bits binary, chunk int, counts binary")


def _scanned(doc, text_hash, n, node, check, bits, chunk, counts) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([doc, text_hash, *(pa.array(c, t) for c, t in zip((n, node, check, bits, chunk, counts), kinds))],
                                      names=["doc", "text_hash", "n", "node", "check", "bits", "chunk", "counts"])


def frequent_table(scanned: DataFrame) -> np.ndarray:
    """Which counters stand out: a packed bit for each of them (a table of fixed size)."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:  # streamed; a task holds its chunks' sums only
            for c, raw in zip(b.column("chunk").to_pylist(), b.column("counts").to_pylist()):
                part = np.frombuffer(raw, dtype=np.uint16 if len(raw) == 2 * CHUNK else np.int64).astype(np.int64)
                sums[c] = sums[c] + part if c in sums else part
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()),
                                          pa.array([s.tobytes() for s in sums.values()], pa.binary())],
                                         names=["chunk", "counts"])

    parts = scanned.where("chunk is not null").select("chunk", "counts").repartition("chunk")
    table = np.zeros(COUNTERS, dtype=np.int64)
    for r in parts.mapInArrow(add, "chunk int, counts binary").collect():  # COUNTERS numbers in all
        table[r["chunk"] * CHUNK:(r["chunk"] + 1) * CHUNK] = np.frombuffer(r["counts"], dtype=np.int64)
    mean = table.mean()
    return np.packbits(table > mean + 6 * np.sqrt(mean) + 32)


def _postings(docs: DataFrame, frequent: np.ndarray, k: int, percent: int) -> DataFrame:
    """(sig, combined, node): index entries of every document, once for each different set in a task."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.unpackbits(shared.value).astype(bool)
        seen: set[int] = set()
        for b in batches:
            parts: list[tuple[np.ndarray, bool, int]] = []
            for t in b.column("text").to_pylist():
                s = shingles(t, k)
                if not len(s):
                    continue
                node = _node(s)[0]
                if node in seen:
                    continue
                if len(seen) < 1_000_000:  # beyond, repeats go to the exact step that follows
                    seen.add(node)
                single, both = signatures(s, table[(s & np.uint64(COUNTERS - 1)).astype(np.int64)], percent)
                parts += [(single, False, node), (both, True, node)]
            sizes = [len(p[0]) for p in parts]
            sig = np.concatenate([np.zeros(0, np.uint64), *(p[0] for p in parts)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(sig.view(np.int64)), pa.array(np.repeat(np.array([p[1] for p in parts], bool), sizes)),
                 pa.array(np.repeat(np.array([p[2] for p in parts], np.int64), sizes))],
                names=["sig", "combined", "node"])

    return docs.select("text").mapInArrow(run, "sig bigint, combined boolean, node bigint")


def _groups(postings: DataFrame) -> DataFrame:
    """(group, node, size): members of index entries with two nodes or more, entries with equal members once.

    Rare tokens' entries are bounded, so one window a token does; entries of
    combinations may hold any share of the rows and are counted with a partial
    aggregation and joined, which lets the engine split them.
    """
    salt = F.when(F.col("combined"), F.pmod(F.hash("node"), F.lit(64))).otherwise(0)
    keyed = postings.withColumn("salt", salt)
    ordered = Window.partitionBy("sig", "salt").orderBy("node")
    whole = Window.partitionBy("sig", "salt")
    once = keyed.withColumn("again", F.lag("node").over(ordered).eqNullSafe(F.col("node"))).where("not again")
    h = F.xxhash64("node")
    marked = once.withColumns({"lo": F.min("node").over(whole), "hi": F.max("node").over(whole),
                               "size": F.count(F.lit(1)).over(whole), "mark": F.bit_xor(h).over(whole)})
    kept = materialize(marked.where("combined or lo <> hi").select("sig", "combined", "node", "lo", "hi", "size", "mark"),
                       "entries")
    single = kept.where("not combined")
    both = kept.where("combined").select("sig", "node")
    stats = (both.groupBy("sig").agg(F.min("node").alias("lo"), F.max("node").alias("hi"),
                                     F.count(F.lit(1)).alias("size"), F.bit_xor(h).alias("mark")).where("lo <> hi"))
    both = both.join(stats, "sig")
    group = F.xxhash64("lo", "hi", "size", "mark").alias("group")
    cols = [group, "node", "size"]
    return single.select(*cols).union(both.select(*cols)).dropDuplicates(["group", "node"])


def _dealt(groups: DataFrame) -> DataFrame:
    """(group, node, part, parts): groups over BLOCK members dealt into blocks by hash."""
    parts = F.ceil(F.col("size") / BLOCK).cast("int")
    return groups.select("group", "node", F.pmod(F.xxhash64("node"), parts).cast("int").alias("part"), parts.alias("parts"))


def _fold(bits: np.ndarray, size: int) -> np.ndarray:
    """Bitmaps (rows of bytes) folded to ``size`` bytes; parities of halves add up."""
    while bits.shape[1] > size:
        half = bits.shape[1] // 2
        bits = bits[:, :half] ^ bits[:, half:]
    return bits


def _differences(x: bytes, y: bytes) -> int:
    """Places in which two parity bitmaps differ, the wider one folded."""
    if len(x) != len(y):
        size = min(len(x), len(y))
        x, y = (_fold(np.frombuffer(m, np.uint8)[None, :], size).tobytes() for m in (x, y))
    return (int.from_bytes(x) ^ int.from_bytes(y)).bit_count()


def _comparer(raw: list[bytes]):
    """A function (i, js): places in which the bitmap of i differs from those of the members js, the wider ones folded."""
    widths = np.array([len(r) for r in raw])
    maps = {w: np.frombuffer(b"".join(r for r, v in zip(raw, widths) if v == w), np.uint8).reshape(-1, w)
            for w in np.unique(widths)}
    place = np.zeros(len(raw), np.int64)
    for w in maps:
        place[widths == w] = np.arange((widths == w).sum())

    def differ(i: int, js: np.ndarray) -> np.ndarray:
        mine, out = maps[widths[i]][place[i]][None, :], np.zeros(len(js), np.int64)
        for w in np.unique(widths[js]):
            some = widths[js] == w
            size = min(w, widths[i])
            out[some] = np.bitwise_count(_fold(maps[w][place[js[some]]], size) ^ _fold(mine, size)).sum(axis=1, dtype=np.int64)
        return out
    return differ


def _nearest_forest(node, n, raw: list[bytes], percent: int) -> tuple[list[tuple[int, int]], bool]:
    """Pairs of one block that may link, a spanning forest of the nearest ones, and whether other pairs may link too.

    Each tree grows by the member nearest to any of its own, so every member
    that has a partner at all is named.
    """
    order = np.lexsort((node, n))
    node, n, differ = node[order], n[order], _comparer([raw[i] for i in order])
    # Sizes that can link with a member's are one stretch of the members in order of size.
    ends = np.searchsorted(n, n * 100 // percent, "right")
    begins = np.searchsorted(n, -(-n * percent // 100), "left")
    outside, score, to = np.ones(len(n), bool), np.full(len(n), np.inf), np.zeros(len(n), np.int64)
    out, near = [], 0
    for _ in range(len(n)):
        i = int(score.argmin())
        if np.isfinite(score[i]):
            out.append((int(node[i]), int(node[to[i]])))
        else:
            i = int(outside.argmax())  # a new tree
        outside[i], score[i] = False, np.inf
        js = np.arange(begins[i], ends[i])
        js = js[outside[js]]
        if not len(js):
            continue
        different = differ(i, js)
        ok = may_link(n[i], n[js], different, percent)
        js, distance = js[ok], different[ok] / (n[i] + n[js[ok]])
        near += len(js)
        closer = distance < score[js]
        score[js[closer]], to[js[closer]] = distance[closer], i
    return out, near > len(out)


def _candidates(members: DataFrame, percent: int) -> DataFrame:
    """(x, y): in each block a spanning forest of the pairs that may link; and, with null x and y, the (group, part)
    in which other pairs may link too.

    Blocks stand one after the other in a partition and are taken from the
    stream one by one.
    """
    names, keys = ["group", "part", "node", "n", "bits"], ["group", "part"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def done(table: pa.Table) -> pa.RecordBatch:
            group, part, node, n = (table.column(c).to_numpy() for c in names[:4])
            raw = table.column("bits").to_pylist()
            cuts = [0, *(np.flatnonzero((group[1:] != group[:-1]) | (part[1:] != part[:-1])) + 1).tolist(), len(node)]
            back: list[int] = []
            pairs: list[tuple[int, int]] = []
            for i, j in zip(cuts, cuts[1:]):
                if j - i > PARTNERS + 1:
                    some, left = _nearest_forest(node[i:j], n[i:j], raw[i:j], percent)
                    pairs += some
                    back += [i] * left
                    continue
                for p in range(i, j):
                    for q in range(p + 1, j):
                        u, v = int(n[p]), int(n[q])
                        if may_link(u, v, abs(u - v), percent) and may_link(u, v, _differences(raw[p], raw[q]), percent):
                            pairs.append((node[p], node[q]))
            two = np.array(pairs, dtype=np.int64).reshape(-1, 2)
            x, y = np.unique(np.stack([two.min(axis=1), two.max(axis=1)]), axis=1)
            none, nothing = pa.nulls(len(back)), pa.nulls(len(x))
            columns = [pa.concat_arrays([pa.array(c), none.cast(pa.int64())]) for c in (x, y)]
            columns += [pa.concat_arrays([nothing.cast(k), pa.array(c[back], k)])
                        for c, k in ((group, pa.int64()), (part, pa.int32()))]
            return pa.RecordBatch.from_arrays(columns, names=["x", "y", *keys])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            last = [held.column(c)[-1].as_py() for c in keys]
            same = np.logical_and.reduce([held.column(c).to_numpy() == x for c, x in zip(keys, last)])
            whole = len(same) - int(same[::-1].argmin()) if not same.all() else 0  # the last block may go on
            if whole:
                yield done(held.slice(0, whole))
                held = held.slice(whole)
        if held is not None and held.num_rows:
            yield done(held)

    rows = members.select(*names).repartition(*keys).sortWithinPartitions(*keys)
    return rows.mapInArrow(run, "x bigint, y bigint, group bigint, part int").distinct()


def _sets(docs: DataFrame, named: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """(node, tokens): full sets of ``nodes``, made again from the text of one document each."""
    chosen = named.join(nodes, "node").groupBy("node").agg(F.min(F.struct("doc", "text_hash")).alias("d"))
    chosen = chosen.select("node", F.col("d.doc").alias("d"), F.col("d.text_hash").alias("h"))
    hashed = docs.withColumn("text_hash", F.xxhash64("text"))
    same = F.col("doc").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h"))
    # Equal rows are dropped where the join has put them side by side.
    texts = hashed.join(chosen, same).dropDuplicates(["doc", "text_hash"]).select("node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: tuple[list, list] = [], []
            for node, t in zip(b.column("node").to_pylist(), b.column("text").to_pylist()):
                s = shingles(t, k)
                out[0].append(node)
                out[1].append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary())],
                                             names=["node", "tokens"])

    return texts.mapInArrow(run, "node bigint, tokens binary")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(x, y): the pairs that link.  A set meets up to MEMBERS others in a task."""
    place = F.row_number().over(Window.partitionBy("x", "salt").orderBy("y"))
    dealt = (pairs.select("x", "y").withColumn("salt", F.pmod(F.hash("y"), F.lit(16)))
             .withColumn("turn", F.floor((place - 1) / MEMBERS).cast("int")))
    dealt = materialize(dealt, "dealt")
    ones = (dealt.select("x", "salt", "turn").distinct().join(sets, F.col("x") == F.col("node"))
            .select(F.col("x").alias("cx"), F.col("salt").alias("csalt"), F.col("turn").alias("cturn"),
                    F.col("tokens").alias("ctokens")))
    others = dealt.join(sets, F.col("y") == F.col("node")).drop("node")

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        if not a.num_rows:
            return pa.table([pa.array([], pa.int64())] * 2, names=["x", "y"])
        own = np.frombuffer(a.column("ctokens")[0].as_py(), np.uint64)
        ok = []
        for raw in b.column("tokens"):
            s = np.frombuffer(raw.as_buffer(), np.uint64)
            at = np.searchsorted(own, s)
            at[at == len(own)] = 0
            common = int((own[at] == s).sum())
            ok.append(100 * common >= percent * (len(own) + len(s) - common))
        return b.select(["x", "y"]).filter(pa.array(ok, pa.bool_()))

    keys = ["x", "salt", "turn"]
    return ones.groupBy("cx", "csalt", "cturn").cogroup(others.groupBy(*keys)).applyInArrow(run, "x bigint, y bigint")


class _Forest:
    """Union-find over the components of a block's members."""

    def __init__(self, comp: np.ndarray):
        _, self.of = np.unique(comp, return_inverse=True)
        self.up = list(range(int(self.of.max()) + 1))

    def find(self, member: int) -> int:
        at = int(self.of[member])
        while self.up[at] != at:
            self.up[at] = self.up[self.up[at]]
            at = self.up[at]
        return at

    def join(self, one: int, other: int) -> bool:
        a, b = self.find(one), self.find(other)
        self.up[max(a, b)] = min(a, b)
        return a != b


def _near(n, part, comp, raw: list[bytes], percent: int) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """For members in order of size: (member, [(differing bits, larger member)]) that may link, in other components."""
    two, differ = part.min() != part.max(), _comparer(raw)
    ends = np.searchsorted(n, n * 100 // percent, "right")
    for i in range(len(n)):
        js = np.arange(i + 1, ends[i])
        js = js[comp[js] != comp[i]]
        if two:
            js = js[part[js] != part[i]]
        if not len(js):
            continue
        different = differ(i, js)
        ok = may_link(n[i], n[js], different, percent)
        if ok.any():
            yield i, list(zip(different[ok].tolist(), js[ok].tolist()))


def _forest_links(node, n, part, comp, raw: list[bytes], tokens: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links between members of different components, each of which joins two components of the block."""
    order = np.lexsort((node, n))
    node, n, part, comp = node[order], n[order], part[order], comp[order]
    raw, tokens = [raw[i] for i in order], [tokens[i] for i in order]
    forest, out = _Forest(comp), []
    for i, near in _near(n, part, comp, raw, percent):
        for _, j in sorted(near):
            if forest.find(i) == forest.find(j):
                continue
            common = len(np.intersect1d(tokens[i], tokens[j], assume_unique=True))
            if 100 * common >= percent * (int(n[i]) + int(n[j]) - common) and forest.join(i, j):
                out.append((int(node[i]), int(node[j])))
    return out


def _undecided(members: DataFrame, percent: int) -> DataFrame:
    """(group, a, b, node): the members that may link with one of another component, by the bitmaps alone."""
    keys = ["group", "a", "b"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches, keys):
            order = np.lexsort((table.column("node").to_numpy(), table.column("n").to_numpy()))
            n, part, comp = (table.column(c).to_numpy()[order] for c in ("n", "part", "comp"))
            bits = table.column("bits").to_pylist()
            open_ = np.zeros(len(order), bool)
            for i, near in _near(n, part, comp, [bits[k] for k in order], percent):
                open_[i] = True
                open_[[j for _, j in near]] = True
            if open_.any():
                yield table.select([*keys, "node"]).take(pa.array(order[open_])).combine_chunks().to_batches()[0]

    rows = members.select(*keys, "node", "n", "part", "comp", "bits").repartition(*keys).sortWithinPartitions(*keys)
    return rows.mapInArrow(run, "group bigint, a int, b int, node bigint")


def _whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of one group at a time, from rows sorted by ``keys``."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        values = [held.column(c).to_numpy() for c in keys]
        borders = np.flatnonzero(np.logical_or.reduce([v[1:] != v[:-1] for v in values])) + 1
        at = 0
        for border in borders.tolist():
            yield held.slice(at, border - at)
            at = border
        held = held.slice(at)
    if held is not None and held.num_rows:
        yield held


def _block_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(x, y): links between components, found with the sets of a block side by side.

    Blocks whose sets take more than ``BLOCK_BYTES`` are cut once more into
    all pairs of smaller ones, so what a task holds at once stays bounded.
    """
    block, cut = ["group", "a", "b"], ["group", "a", "b", "s", "t"]
    held = members.join(sets, "node")
    parts = F.ceil(F.sum(F.col("n") * 8) / BLOCK_BYTES).cast("int").alias("parts")
    sized = held.join(held.groupBy(*block).agg(parts), block)
    sub = F.pmod(F.xxhash64("node", F.lit(1)), "parts").cast("int")
    rows = sized.withColumns({"sub": sub, "other": F.explode(F.sequence(F.lit(0), F.col("parts") - 1))})
    first = F.when(F.col("a") == F.col("b"), F.least("sub", "other")).when(F.col("part") == F.col("a"), F.col("sub")).otherwise(
        F.col("other"))
    second = F.when(F.col("a") == F.col("b"), F.greatest("sub", "other")).when(
        F.col("part") == F.col("a"), F.col("other")).otherwise(F.col("sub"))
    side = F.when(F.col("a") == F.col("b"), F.col("sub")).otherwise(F.col("part"))
    dealt = rows.select(*block, first.alias("s"), second.alias("t"), "node", "n", side.alias("side"), "comp", "bits", "tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches, cut):
            columns = [table.column(c).to_numpy() for c in ("node", "n", "side", "comp")]
            sets_ = [np.frombuffer(t.as_buffer(), np.uint64) for t in table.column("tokens")]
            links = _forest_links(*columns, table.column("bits").to_pylist(), sets_, percent)
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links)], names=["x", "y"])

    placed = dealt.repartition(*cut).sortWithinPartitions(*cut)
    return placed.mapInArrow(run, "x bigint, y bigint").select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes of ``edges`` (x, y); root is the smallest node of the component.

    Large-star and small-star turns until nothing changes: every turn is a
    join with a grouped minimum, so a hub is pre-aggregated and may be split.
    """
    edges = materialize(edges.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v"))
                        .where("u <> v").distinct(), "edges")
    state = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(joined.select("u", F.col("m").alias("v")))
        edges = materialize(small.where("u <> v").distinct(), "edges")
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == state:
            break
        state = now
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _open_blocks(groups: DataFrame, comps: DataFrame | None, held: DataFrame) -> DataFrame:
    """(group, a, b, node, part, comp): blocks (a = b) that left pairs out and pairs of blocks a < b of one group,
    where these are not one component."""
    rows = groups.withColumn("comp", F.col("node"))
    if comps is not None:
        rows = groups.join(comps, "node", "left").withColumn("comp", F.coalesce("root", "node")).drop("root")
    apart = (F.min("comp") < F.max("comp")).alias("apart")
    # Rows meet by block; only the blocks' own smallest and largest components meet by group.
    spans = materialize(rows.groupBy("group", "part").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")), "spans")
    mixed = spans.groupBy("group").agg((F.min("lo") < F.max("hi")).alias("apart")).where("apart").select("group")
    rows = materialize(rows.join(spans.join(mixed, "group", "left_semi"), ["group", "part"], "left_semi"), "mixed")
    own = rows.join(held, ["group", "part"], "left_semi").withColumn("other", F.col("part"))
    across = rows.where("parts > 1").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    blocks = own.select("group", "node", "part", "other", "comp").union(
        across.where("other <> part").select("group", "node", "part", "other", "comp"))
    blocks = blocks.select("group", F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b"),
                           "node", "part", "comp")
    block = ["group", "a", "b"]
    return blocks.join(blocks.groupBy(*block).agg(apart).where("apart").select(*block), block, "left_semi")


def _contracted(comps: DataFrame | None, links: DataFrame, name: str) -> DataFrame | None:
    """``comps`` (node, root) with the components that ``links`` join made one."""
    if links.isEmpty():
        return comps
    if comps is None:
        return materialize(components(links), name)
    # Components of components.
    of = comps.select(F.col("node").alias("at"), F.col("root").alias("to"))
    edges = (links.join(of, F.col("x") == F.col("at"), "left").select(F.coalesce("to", "x").alias("x"), "y")
             .join(of, F.col("y") == F.col("at"), "left").select("x", F.coalesce("to", "y").alias("y")))
    merged = components(edges)
    renamed = merged.select(F.col("node").alias("was"), F.col("root").alias("now"))
    older = comps.join(renamed, F.col("root") == F.col("was"), "left").select("node", F.coalesce("now", "root").alias("root"))
    return materialize(older.union(merged).groupBy("node").agg(F.min("root").alias("root")), name)


def link_documents(docs: DataFrame, doc: str = "doc_id", text: str = "text", k: int = WORDS,
                   percent: int = PERCENT) -> DataFrame:
    """Per row: ``doc``, text_hash, n_shingles, node (names equal sets; null if empty), component_id.

    ``component_id`` is the smallest document id reachable by links, the
    row's own included.  Null and wordless texts have no tokens and link with
    nothing; rows with equal texts link; rows that share an id but not the
    text are judged by their own text; null ids are never the smallest.
    Empty tables give no rows; other columns are ignored.
    """
    return _linked(docs, doc, text, k, percent).drop("root")


def _linked(docs: DataFrame, doc: str, text: str, k: int, percent: int) -> DataFrame:
    """``link_documents`` with ``root``: the smallest node of the component, null if empty."""
    slim = docs.select(F.col(doc).alias("doc"), F.col(text).alias("text"))
    scanned = materialize(_scan(slim, k, percent), "scanned")
    rows = scanned.where("chunk is null").drop("chunk", "counts")
    frequent = frequent_table(scanned)
    groups = materialize(_dealt(_groups(_postings(slim, frequent, k, percent))), "groups")
    named = rows.where("node is not null")
    nodes = materialize(groups.select("node").distinct()
                        .join(named.select("node", "n", "bits").dropDuplicates(["node"]), "node"), "nodes")

    texts, named_ids = slim.where("text is not null"), named.select("node", "doc", "text_hash")
    found = materialize(_candidates(groups.join(nodes, "node"), percent), "pairs")
    pairs, held = found.where("x is not null").select("x", "y"), found.where("x is null").select("group", "part")
    comps, sets = None, None
    if not pairs.isEmpty():
        paired = pairs.select(F.col("x").alias("node")).union(pairs.select("y")).distinct()
        sets = materialize(_sets(texts, named_ids, paired, k), "sets")
        comps = _contracted(None, materialize(_verified(pairs, sets, percent), "links"), "components")
    if not held.isEmpty() or not groups.where("parts > 1").isEmpty():
        # Blocks that are one component by now, and members that the bitmaps rule out, need no sets.
        members = materialize(_open_blocks(groups, comps, held).join(nodes, "node"), "open")
        left = materialize(_undecided(members, percent), "undecided")
        if not left.isEmpty():
            fresh = left.select("node").distinct()
            if sets is not None:
                fresh = fresh.join(sets.select("node"), "node", "left_anti")
            if not fresh.isEmpty():  # partners in other blocks of a group only
                more = materialize(_sets(texts, named_ids, fresh, k), "sets-blocks")
                sets = more if sets is None else sets.union(more)
            members = members.join(left, ["group", "a", "b", "node"], "left_semi")
            links = materialize(_block_links(members, sets, percent), "links-blocks")
            comps = _contracted(comps, links, "components-blocks")

    smallest = named.groupBy("node").agg(F.min("doc").alias("first"))
    if comps is not None:
        smallest = smallest.join(comps, "node", "left").withColumn("root", F.coalesce("root", "node"))
        lowest = smallest.groupBy("root").agg(F.min("first").alias("component_id"))
        smallest = smallest.join(lowest, "root").select("node", "root", "component_id")
    else:
        smallest = smallest.select("node", F.col("node").alias("root"), F.col("first").alias("component_id"))
    joined = rows.join(smallest, "node", "left")
    return joined.select(F.col("doc").alias(doc), "text_hash", F.col("n").alias("n_shingles"), "node", "root",
                         F.when(F.col("node").isNull(), F.col("doc")).otherwise(F.col("component_id")).alias("component_id"))


def keep_one(docs: DataFrame, doc: str = "doc_id", text: str = "text", k: int = WORDS,
             percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest id; all columns kept.

    Documents without words are linked with nothing and stay.  Of rows that
    are equal in id and text one stays; of different texts with the smallest
    id in one component the one with the smallest hash stays.  Components are
    told apart by their root: an id may be the smallest in several of them.
    """
    links = materialize(_linked(docs, doc, text, k, percent), "links")
    first = links.where(F.col(doc).eqNullSafe(F.col("component_id")) & F.col("node").isNotNull())
    stay = first.groupBy(F.col(doc).alias("__doc"), "root").agg(
        F.min("text_hash").alias("__hash"), F.count(F.lit(1)).alias("__n"))
    stay = stay.select("__doc", "__hash", "__n").union(
        links.where("node is null").select(doc, "text_hash", F.lit(1).cast("bigint"))).distinct()
    stay = materialize(stay, "stay")
    same = docs[doc].eqNullSafe(stay["__doc"]) & (F.xxhash64(docs[text]) == stay["__hash"])
    kept = docs.join(stay.select("__doc", "__hash"), same, "left_semi")
    if not stay.where("__n > 1").isEmpty():  # some id is repeated: equal rows, or other texts that are gone now
        words = F.coalesce(F.col(text), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
        kept = kept.where(words).dropDuplicates([doc, text]).unionByName(kept.where(~words))
    return kept
