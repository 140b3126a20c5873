"""Cross-tokenizer alignment by diagonal run skipping.

Two tokenizers cut the same bytes.  Wherever a token of each ends at the same
byte, the tokens so far form closed groups.  Most groups hold one token of
each, so the alignment follows a diagonal of the two arrays of token ends: at
the current index shift, blocks of the arrays are compared whole, twice as
long each time, and a block that differs is halved until the end of the run of
one-to-one groups is found.  Only the irregular group after it is walked token
by token; it gives the next shift.

A token pair is linked where their byte ranges overlap.  Counts of linked id
pairs over the whole corpus need no row per link: documents are packed into
chunks of bounded size, a chunk names each of its pairs once with its total,
and only those totals are shuffled.  The corpus-wide counts return to the
chunk, where each document adds up its own.

Encoding.  A byte-level BPE and a SentencePiece BPE both treat a text piece by
piece: no token holds a space or a line end after another character.  So a
text is cut before every single space or line end between two other
characters, and parts met before are looked up.
"""
from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickflow.llm.common import materialize

SPACE = "▁"          # SentencePiece's sign for a space
MEMORY = 400_000          # parts in a generation of a Python worker's memory (about 100 MB)
LONG = 64                 # characters; longer parts are not remembered
BLOCK = 20_000            # parts of a text that are aligned at a time
CHUNK_ENTRIES = 500_000   # (document, id pair) entries of a chunk

_PART = re.compile(r"[ \n]\S+")
_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: printable ones as they are, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}


def load_byte_bpe(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a byte-level BPE file, without its special tokens; ids must follow merge order."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    letters, special = byte_letters(), {t["content"] for t in spec["added_tokens"]}
    ids = {bytes(letters[c] for c in entry): i for entry, i in spec["model"]["vocab"].items() if entry not in special}
    vocab = spec["model"]["vocab"]
    made = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in spec["model"]["merges"]]
    if made != sorted(made):
        raise ValueError(f"{path}: token ids do not follow the order of merges")
    return ids


class Pair:
    """Both encoders, with a bounded memory of parts met before."""

    def __init__(self, ranks: dict[bytes, int], model: bytes, pattern: str, memory: int = MEMORY):
        self.bpe = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.a_bytes = {i: t for t, i in ranks.items()}
        self.b_bytes = {i: self._piece(i) for i in range(self.pieces.get_piece_size())}
        self.a_size = np.zeros(max(self.a_bytes) + 1, np.int64)
        self.a_size[list(self.a_bytes)] = [len(t) for t in self.a_bytes.values()]
        self.b_size = np.array([len(self.b_bytes[i]) for i in range(len(self.b_bytes))], np.int64)
        self.gap = self.pieces.piece_to_id(SPACE)
        self.size, self.known, self.old = memory, {}, {}
        if any(SPACE in p.lstrip(SPACE) or "\n" in p for p in map(self.pieces.id_to_piece, self._texts())):
            raise ValueError("a piece holds a space or line end after another character")

    def _texts(self) -> list[int]:
        p = self.pieces
        return [i for i in range(p.get_piece_size()) if not (p.is_byte(i) or p.is_control(i) or p.is_unknown(i))]

    def _piece(self, i: int) -> bytes:
        text = self.pieces.id_to_piece(i)
        if self.pieces.is_byte(i):
            return bytes([int(text[3:5], 16)])
        return text.replace(SPACE, " ").encode("utf-8")

    def _learn(self, parts: set[str]) -> dict[str, tuple[bytes, bytes] | None]:
        """Ids of both tokenizers for each part (int32 bytes), or None where the bytes are not the part's.

        Parts that end in no space stand one after the other as in a text, so
        all are encoded in one go and cut where the parts end.
        """
        listed = sorted(p for p in parts if not p[-1].isspace())
        listed.sort(key=lambda p: p[0] != " ")
        joined = "".join(listed)
        out = {}
        if joined[:1] == " ":
            raw, ends = joined.encode("utf-8"), np.cumsum([len(p.encode("utf-8")) for p in listed])
            cuts = [self._cut(ids, size, token, raw, ends) for ids, size, token in (
                (self.bpe.encode_ordinary(joined), self.a_size, self.a_bytes),
                (self.pieces.encode(joined[1:]), self.b_size, self.b_bytes))]
            if None not in cuts:
                out = dict(zip(listed, zip(*cuts)))
        for part in parts - out.keys():
            # The model adds a space itself; before a line end that space is taken off again.
            b = self.pieces.encode(part[1:] if part[0] == " " else part)
            if part[0] != " ":
                b = b[1:] if b[:1] == [self.gap] else []
            raw = part.encode("utf-8")
            cuts = [self._cut(ids, size, token, raw, np.array([len(raw)])) for ids, size, token in (
                (self.bpe.encode_ordinary(part), self.a_size, self.a_bytes), (b, self.b_size, self.b_bytes))]
            out[part] = None if None in cuts else (cuts[0][0], cuts[1][0])
        return out

    @staticmethod
    def _cut(ids: list[int], size: np.ndarray, token: dict[int, bytes], raw: bytes, ends: np.ndarray) -> list[bytes] | None:
        """The ids (int32 bytes) of each stretch of ``raw``, or None if the tokens' bytes are not ``raw`` so cut."""
        if b"".join(map(token.__getitem__, ids)) != raw:
            return None
        array = np.array(ids, np.int32)
        at = np.cumsum(size[array])
        last = np.searchsorted(at, ends)
        if (at[last] != ends).any():
            return None
        packed, stops = array.tobytes(), (4 * (last + 1)).tolist()
        return [packed[i:j] for i, j in zip([0, *stops], stops)]

    def encode(self, text: str) -> Iterator[tuple[np.ndarray, np.ndarray]] | None:
        """Ids of both tokenizers for a space and ``text``, block by block; both end a token where a block ends.

        None if the bytes of the tokens are not those of a space and the text.
        """
        whole = " " + text
        parts = _PART.findall(whole)
        if sum(map(len, parts)) != len(whole):
            parts = _CUT.split(whole)
        if SPACE in text or not all(self._look_up(parts[i:i + BLOCK], check=True) for i in range(BLOCK, len(parts), BLOCK)):
            return None
        first = self._look_up(parts[:BLOCK])
        return None if first is None else self._blocks(first, parts)

    def _blocks(self, first, parts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        yield first
        for i in range(BLOCK, len(parts), BLOCK):
            yield self._look_up(parts[i:i + BLOCK])

    def _look_up(self, parts: list[str], check: bool = False):
        found = list(map(self.known.get, parts))
        if None in found:
            missing = {p for p, f in zip(parts, found) if f is None}
            moved = {p: self.old[p] for p in missing if p in self.old}
            new = moved | self._learn(missing - moved.keys())
            if None in new.values():
                return None
            if len(self.known) >= self.size:
                self.old, self.known = self.known, {}
            self.known.update((p, f) for p, f in new.items() if len(p) <= LONG)
            found = [f if f is not None else new[p] for p, f in zip(parts, found)]
        if check:
            return True
        return (np.frombuffer(b"".join([f[0] for f in found]), np.int32),
                np.frombuffer(b"".join([f[1] for f in found]), np.int32))


def diagonal_runs(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[list[tuple[int, int, int]], list[tuple[int, ...]]]:
    """Alternating runs of one-to-one groups and irregular groups of two arrays of token ends with the same last end.

    Returns (index in A, index in B, length) of each run, some of length 0,
    and after each the irregular group that follows: indices of A from, to
    and of B from, to (ends not included; empty at the end of the arrays).
    """
    x, y = ends_a.astype(np.int64).tobytes(), ends_b.astype(np.int64).tobytes()
    a, b = ends_a.tolist(), ends_b.tolist()
    n, m = len(a), len(b)
    at = shift = 0
    runs, odd = [], []
    while at < n:
        room, off = min(n - at, m - at - shift), 8 * shift
        run, block, growing = 0, 1, True
        while block:
            stop = run + block
            if stop <= room and x[8 * (at + run):8 * (at + stop)] == y[8 * (at + run) + off:8 * (at + stop) + off]:
                run = stop
                block = block * 2 if growing else block // 2
            else:
                growing = False
                block //= 2
        runs.append((at, at + shift, run))
        at += run
        i, j = at, at + shift
        if at < n:  # tokens of both sides up to the next common end
            p, q = a[i], b[j]
            while p != q:
                if p < q:
                    i += 1
                    p = a[i]
                else:
                    j += 1
                    q = b[j]
            i, j = i + 1, j + 1
        odd.append((at, i, at + shift, j))
        at, shift = i, j - i
    return runs, odd


class Alignment:
    """Groups of one block: id pairs that are linked, and the groups as text."""

    def __init__(self, a: np.ndarray, b: np.ndarray, pair: Pair, names: "Names"):
        runs, odd = diagonal_runs(np.cumsum(pair.a_size[a]), np.cumsum(pair.b_size[b]))
        i0, j0, size = np.array(runs, np.int64).T if runs else np.zeros((3, 0), np.int64)
        step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        straight = _keys(a[np.repeat(i0, size) + step], b[np.repeat(j0, size) + step])
        texts, out, links, done = list(map(names.straight.__getitem__, straight.tolist())), [], [], 0
        a4, b4, crooked = a.tobytes(), b.tobytes(), names.crooked
        for (_, _, run), (i, i_end, j, j_end) in zip(runs, odd):
            out += texts[done:done + run]
            done += run
            if i < i_end:
                text, keys = crooked[a4[4 * i:4 * i_end], b4[4 * j:4 * j_end]]
                out.append(text)
                links.append(keys)
        self.keys = np.concatenate([straight, np.frombuffer(b"".join(links), np.int64)])
        self.n_groups = len(out)
        self.text = ";".join(out)


def _keys(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a.astype(np.int64) << 32 | b


class _Straight(dict):
    """The text of a one-to-one group by its id pair (forgotten as a whole when it grows large)."""

    def __missing__(self, key: int) -> str:
        if len(self) > 500_000:
            self.clear()
        text = self[key] = f"{key >> 32}|{key & 0xFFFFFFFF}"
        return text


class _Crooked(dict):
    """The text and the linked id pairs of an irregular group by the ids (int32 bytes) of both sides."""

    def __init__(self, pair: Pair):
        super().__init__()
        self.pair = pair

    def __missing__(self, key: tuple[bytes, bytes]) -> tuple[str, bytes]:
        if len(self) > 200_000:
            self.clear()
        a, b = (np.frombuffer(k, np.int32) for k in key)
        ends = np.cumsum(self.pair.a_size[a]), np.cumsum(self.pair.b_size[b])
        # A pair of overlapping tokens shares the stretch up to one end of either.
        stretch = np.union1d(*ends)
        links = _keys(a[np.searchsorted(ends[0], stretch)], b[np.searchsorted(ends[1], stretch)])
        text = f"{','.join(map(str, a.tolist()))}|{','.join(map(str, b.tolist()))}"
        if len(key[0]) + len(key[1]) > 256:
            return text, links.tobytes()
        known = self[key] = text, links.tobytes()
        return known


class Names:
    """Texts of groups met before, a bounded number of each kind."""

    def __init__(self, pair: Pair):
        self.straight, self.crooked = _Straight(), _Crooked(pair)


_PAIRS: dict[tuple, tuple[Pair, Names]] = {}  # one per Python worker


class _Text:
    """What one document gives: counts, linked id pairs with their numbers, the groups' digest and text."""

    def __init__(self, text: str | None, pair: Pair, names: Names, with_groups: bool):
        self.n_a = self.n_b = self.n_groups = self.n_links = 0
        self.digest, kept = "", []
        keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        blocks = pair.encode(text) if text else None
        if blocks is not None:
            sha = hashlib.sha256()
            for a, b in blocks:
                got = Alignment(a, b, pair, names)
                more = (";" if self.n_a else "") + got.text
                sha.update(more.encode())
                if with_groups:
                    kept.append(more)
                self.n_a, self.n_b = self.n_a + len(a), self.n_b + len(b)
                self.n_groups, self.n_links = self.n_groups + got.n_groups, self.n_links + len(got.keys)
                k, c = np.unique(got.keys, return_counts=True)
                keys.append(k)
                counts.append(c)
            self.digest = sha.hexdigest()
        self.groups = "".join(kept)
        self.keys, self.counts = keys[-1], counts[-1]
        if len(keys) > 2:
            self.keys, inverse = np.unique(np.concatenate(keys), return_inverse=True)
            self.counts = np.bincount(inverse, np.concatenate(counts)).astype(np.int64)


def _load(docs: DataFrame, a_path: str, b_path: str, pattern: str, memory: int):
    """A function for Python workers that gives their encoders; both vocabularies are broadcast (their files' size)."""
    with open(b_path, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast((load_byte_bpe(a_path), f.read()))
    key = (a_path, b_path, pattern, memory)

    def get() -> tuple[Pair, Names]:
        if key not in _PAIRS:
            _PAIRS.clear()
            pair = Pair(*shared.value, pattern, memory)
            _PAIRS[key] = pair, Names(pair)
        return _PAIRS[key]
    return get


def align_documents(docs: DataFrame, a_path: str, b_path: str, pattern: str, doc: str = "doc_id", text: str = "text",
                    memory: int = MEMORY) -> DataFrame:
    """Per row: ``doc``, n_a, n_b, n_groups, n_links, groups (``a1,a2|b1;a3|b2,b3``: ids of both tokenizers in each group).

    A space and the text are encoded by the byte-level BPE at ``a_path`` (split
    by ``pattern``), the text by the SentencePiece model at ``b_path``, which
    adds the space.  Texts that are null or empty, or whose tokens' bytes are
    not a space and the text (such as those holding U+2581), have no tokens:
    zeros and an empty string.  Repeated rows and null keys give a row each,
    other columns are ignored.  Rows are independent; nothing is shuffled.
    """
    load = _load(docs, a_path, b_path, pattern, memory)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [_Text(t, *load(), True) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), *[pa.array([getattr(g, c) for g in got], pa.int64()) for c in _COUNTS],
                 pa.array([g.groups for g in got], pa.string())], names=["doc", *_COUNTS, "groups"])

    slim = docs.select(F.col(doc).alias("doc"), F.col(text).alias("text"))
    schema = f"doc {dict(slim.dtypes)['doc']}, {', '.join(f'{c} bigint' for c in _COUNTS)}, groups string"
    return slim.mapInArrow(run, schema).withColumnRenamed("doc", doc)


_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]


def link_statistics(docs: DataFrame, a_path: str, b_path: str, pattern: str, doc: str = "doc_id", text: str = "text",
                    memory: int = MEMORY, chunk_entries: int = CHUNK_ENTRIES) -> DataFrame:
    """Per row: ``doc``, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    As ``align_documents``, with the digest in place of the groups, and with
    the corpus-wide counts of linked id pairs: ``count_sum`` adds up the count
    of each link's pair, ``n_best`` counts the links whose pair has the highest
    count of its B id (ties included).  An empty table gives no rows.

    A chunk holds at most ``chunk_entries`` (document, pair) entries, or one
    document.  What is shuffled is a row per chunk and distinct pair, and the
    documents' entries by chunk.  A pair that every document holds has one row
    per chunk, and the pairs of a B id are at most A's vocabulary.
    """
    load = _load(docs, a_path, b_path, pattern, memory)
    slim = docs.select(F.col(doc).alias("doc"), F.col(text).alias("text"))
    kind = slim.schema["doc"].dataType
    schema = (f"chunk bigint, doc {kind.simpleString()}, {', '.join(f'{c} bigint' for c in _COUNTS)}, "
              "groups_sha256 string, at array<int>, n array<bigint>, pairs array<bigint>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, names = load()
        # A retried task numbers its chunks alike, and only one attempt's rows are kept.
        chunk, held = TaskContext.get().partitionId() << 32, []
        entries = 0
        for batch in batches:
            key = batch.column("doc")
            for i, t in enumerate(batch.column("text")):
                got = _Text(t.as_py(), pair, names, False)
                held.append((key[i], got))
                entries += len(got.keys)
                if entries >= chunk_entries:
                    yield _packed(chunk, held, key.type)
                    chunk, held, entries = chunk + 1, [], 0
        if held:
            yield _packed(chunk, held, key.type)

    table = materialize(slim.mapInArrow(run, schema), "token-align")
    named = table.where("pairs is not null").select(
        "chunk", F.posexplode(F.arrays_zip("pairs", "n")).alias("at", "e")).select(
        "chunk", "at", F.col("e.pairs").alias("pair"), F.col("e.n").alias("n"))
    counts = named.groupBy("pair").agg(F.sum("n").alias("count"))
    b_id = Window.partitionBy(F.col("pair").bitwiseAND(0xFFFFFFFF))
    counts = counts.withColumn("best", F.col("count") == F.max("count").over(b_id))
    known = named.select("chunk", "at", "pair").join(counts, "pair").select(
        F.col("chunk").alias("of"), "at", "count", "best")
    texts = table.where("pairs is null").drop("pairs")

    def add_up(left: pa.Table, right: pa.Table) -> pa.Table:
        count, best = np.zeros(len(right), np.int64), np.zeros(len(right), np.int64)
        where = right.column("at").to_numpy()
        count[where], best[where] = right.column("count").to_numpy(), right.column("best").to_numpy()
        left = left.combine_chunks()
        at, n = left.column("at").combine_chunks(), left.column("n").combine_chunks()
        if isinstance(at, pa.ChunkedArray):
            at, n = at.chunk(0), n.chunk(0)
        flat, times = at.flatten().to_numpy(), n.flatten().to_numpy()
        row = np.repeat(np.arange(len(left)), at.value_lengths().to_numpy())

        def total(values: np.ndarray) -> pa.Array:
            sums = np.zeros(len(left), np.int64)
            np.add.at(sums, row, values[flat] * times)
            return pa.array(sums)
        return pa.table([*[left.column(c) for c in ["doc", *_COUNTS]], total(best), total(count),
                         left.column("groups_sha256")], names=result)

    result = ["doc", *_COUNTS, "n_best", "count_sum", "groups_sha256"]
    out = f"doc {kind.simpleString()}, {', '.join(f'{c} bigint' for c in result[1:-1])}, groups_sha256 string"
    return texts.groupBy("chunk").cogroup(known.groupBy("of")).applyInArrow(add_up, out).withColumnRenamed("doc", doc)


def _packed(chunk: int, held: list, key_type: pa.DataType) -> pa.RecordBatch:
    """A chunk's documents, their pairs as positions in the chunk's list of pairs, and that list with its totals."""
    sizes = [len(g.keys) for _, g in held]
    pairs, at = np.unique(np.concatenate([g.keys for _, g in held]), return_inverse=True)
    n = np.concatenate([g.counts for _, g in held])
    ends = np.cumsum([0, *sizes])
    totals = np.bincount(at, n, len(pairs)).astype(np.int64)
    lists = [pa.array([*np.split(at.astype(np.int32), ends[1:-1]), None], pa.list_(pa.int32())),
             pa.array([*np.split(n.astype(np.int64), ends[1:-1]), totals], pa.list_(pa.int64())),
             pa.array([*[None] * len(held), pairs], pa.list_(pa.int64()))]
    return pa.RecordBatch.from_arrays(
        [pa.array([chunk] * (len(held) + 1), pa.int64()),
         pa.array([*[k.as_py() for k, _ in held], None], key_type),
         *[pa.array([*[getattr(g, c) for _, g in held], None], pa.int64()) for c in _COUNTS],
         pa.array([*[g.digest for _, g in held], None], pa.string()), *lists],
        names=["chunk", "doc", *_COUNTS, "groups_sha256", "at", "n", "pairs"])
