"""Byte-level BPE by prefix dynamic programming.

For every prefix of a byte string, its BPE encoding ends in exactly one
token: the token ``t`` that ends there, whose neighbour to the left (the last
token of the prefix before ``t``) would not have merged into it.  So one
token per prefix is all that needs to be stored; following it backwards
gives the encoding.  A prefix's entry depends on earlier entries only, which
makes appends exact, and after an edit the table is the old one again as soon
as a longest token's length of entries agree.

Whether two tokens may stand side by side follows from ranks alone.  Merges
happen in rank order, so a token on the right edge of the left neighbour
lives from its own rank to the rank of the merge that swallows it, and so on
the left edge of the right neighbour.  The pair is stable if at no time the
two living edge tokens have a merge of lower rank than the ones that end them.
"""
from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FOREVER = 1 << 60
MEMORY = 500_000  # words in a generation of a Python worker's memory (about 100 MB); others are encoded again
LONG = 64         # characters; longer words are not remembered


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a tiktoken rank file (read by the driver, as any job parameter)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Vocabulary:
    """Ranks, the merge that made each token, and the lives of the tokens on its edges."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.text = {i: t for t, i in ranks.items()}
        self.longest = max(map(len, ranks))
        self.merges: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self._edges: tuple[dict, dict] = {}, {}
        self._pairs: dict[int, bool] = {}
        # In rank order, so that the merges below a token's own are known when it is split.
        for rank, token in sorted(self.text.items()):
            if len(token) > 1 and (made := self._made_of(token, rank)):
                self.parts[rank] = made
                self.merges[made] = rank
        #: Finds all tokens in a byte string (as Latin-1 text), by end, the longest first.
        self.finder = ahocorasick.Automaton()
        for token, rank in ranks.items():
            if self._whole(rank):
                self.finder.add_word(token.decode("latin-1"), (rank, len(token)))
        self.finder.make_automaton()

    def _made_of(self, token: bytes, rank: int) -> tuple[int, int] | None:
        """The two tokens whose merge gives ``token``: those it encodes to by lower ranks."""
        for cut in range(1, len(token)):
            a, b = self.ranks.get(token[:cut], rank), self.ranks.get(token[cut:], rank)
            if max(a, b) < rank and self._whole(a) and self._whole(b) and self._stable(a, b, rank):
                return a, b
        return None

    def _whole(self, t: int) -> bool:
        """Whether encoding the token's own bytes gives the token."""
        return len(self.text[t]) == 1 or t in self.parts

    def _edge(self, t: int, side: int) -> list[tuple[int, int]]:
        """(token, rank of the merge that ends it) from the outermost byte up to ``t`` itself."""
        known = self._edges[side].get(t)
        if known is None:
            chain = [t]
            while chain[-1] in self.parts:
                chain.append(self.parts[chain[-1]][side])
            chain.reverse()
            known = self._edges[side][t] = list(zip(chain, [*chain[1:], FOREVER]))
        return known

    def _stable(self, a: int, b: int, limit: int) -> bool:
        """No merge of rank below ``limit`` crosses between neighbours ``a`` and ``b``."""
        left, right = self._edge(a, 1), self._edge(b, 0)
        i = j = 0
        while True:
            (x, x_end), (y, y_end) = left[i], right[j]
            merge = self.merges.get((x, y), FOREVER)
            if merge < limit and merge < x_end and merge <= y_end:
                return False
            if x_end == y_end == FOREVER:
                return True
            if x_end <= y_end:  # equal ranks merge from the left
                i += 1
            else:
                j += 1

    def stable(self, a: int, b: int) -> bool:
        key = a << 20 | b
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) > 1_000_000:
                self._pairs.clear()
            known = self._pairs[key] = self._stable(a, b, FOREVER)
        return known


class Encoding:
    """A byte string with the last token of each of its prefixes."""

    def __init__(self, vocabulary: Vocabulary, text: bytes = b""):
        self.v = vocabulary
        self.text = bytearray()
        self.last: list[int] = []  # last[i]: last token of text[:i + 1]
        self.append(text)

    def append(self, more: bytes) -> None:
        """Add bytes at the end; earlier entries stay."""
        at = len(self.text)
        self.text += more
        for end in range(at + 1, len(self.text) + 1):
            self.last.append(self._last_token(end))

    def _last_token(self, end: int) -> int:
        get, text, last, stable = self.v.ranks.get, bytes(self.text[max(0, end - self.v.longest):end]), self.last, self.v.stable
        size = len(text)
        for start in range(size):
            token = get(text[start:])
            if token is None:
                continue
            before = end - (size - start)
            if before == 0:
                if size - start == 1 or token in self.v.parts:
                    return token
            elif stable(last[before - 1], token):
                return token
        raise ValueError("the vocabulary lacks single bytes")

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Replace text[start:stop]; returns how many entries were computed anew."""
        old_tail, moved = self.last[stop:], bytes(self.text[stop:])
        del self.text[start:], self.last[start:]
        self.append(new)
        computed, agree = len(new), 0
        for i in range(len(moved)):
            self.append(moved[i:i + 1])
            computed += 1
            agree = agree + 1 if self.last[-1] == old_tail[i] else 0
            # Entries depend on the last `longest` bytes and entries only.
            if agree >= self.v.longest and i + 1 >= self.v.longest:
                self.text += moved[i + 1:]
                self.last += old_tail[i + 1:]
                break
        return computed

    def ids(self) -> list[int]:
        out, end = [], len(self.text)
        while end:
            out.append(self.last[end - 1])
            end -= len(self.v.text[out[-1]])
        out.reverse()
        return out


def encode_bytes(v: Vocabulary, piece: bytes) -> list[int]:
    """Token ids of one piece: itself if it is a token, else by prefix dynamic programming."""
    whole = v.ranks.get(piece)
    if whole is not None:
        return [whole]
    # As Encoding, with all candidate tokens found in one scan.
    pairs, stable, done = v._pairs, v.stable, -1
    last: list[int] = []
    for end, (token, size) in v.finder.iter(piece.decode("latin-1")):
        if end == done:
            continue
        if size <= end:
            before = last[end - size]
            ok = pairs.get(before << 20 | token)
            if not (stable(before, token) if ok is None else ok):
                continue
        last.append(token)
        done = end
    out, end, text = [], len(piece), v.text
    while end:
        token = last[end - 1]
        out.append(token)
        end -= len(text[token])
    out.reverse()
    return out


class Tokenizer:
    """Encodes texts word by word with a bounded memory of words seen before.

    Ids are kept as decimal text, the form that is hashed: one small object a
    word, so that many words fit.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, memory: int = MEMORY):
        self.v = Vocabulary(ranks)
        self.split = regex.compile(pattern).findall
        self.token = {str(i).encode(): t for i, t in self.v.text.items()}
        self.spaced, self.bare = _Memory(self, " ", memory), _Memory(self, "", memory)

    def pieces(self, text: str) -> bytes:
        """Ids of each match of the pattern, in decimal, joined by spaces."""
        return b" ".join([self.piece(p) for p in self.split(text)])

    def piece(self, p: str) -> bytes:
        if len(p) > LONG:
            return self._encoded(p)
        return self.spaced[p[1:]] if p[0] == " " and p[1:].isalpha() else self.bare[p] if p.isalpha() else self._encoded(p)

    def _encoded(self, p: str) -> bytes:
        return b" ".join([b"%d" % i for i in encode_bytes(self.v, p.encode("utf-8"))])

    def word(self, prefix: str, word: str) -> bytes:
        # Letters alone, with or without the space before them, are one match.
        return self._encoded(prefix + word) if word.isalpha() else self.pieces(prefix + word)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, ids.split()))

    def encode(self, text: str) -> bytes:
        """The ids of ``text`` in decimal, joined by spaces.

        The pattern's matches hold a space at their start only.  Where words
        are parted by one space or one line end each, a word with the space
        before it is matched on its own, whatever stands beside it, so equal
        ones need one encoding.  Other texts go through the pattern whole.
        """
        words = text.split()
        blanks = text.count(" ") + text.count("\n")
        if not words or blanks != len(words) - 1 or sum(map(len, words)) + blanks != len(text):
            return self.pieces(text)
        out: list[bytes] = []
        spaced, bare = self.spaced.__getitem__, self.bare.__getitem__
        for line in text.split("\n"):
            first, *rest = line.split(" ")
            if out:
                out.append(bare("\n"))
            out.append(bare(first))
            out.extend(map(spaced, rest))
        return b" ".join(out)


class _Memory(dict):
    """Ids by word in two generations: words not met again for ``size`` new ones are forgotten."""

    def __init__(self, tokenizer: Tokenizer, prefix: str, size: int):
        super().__init__()
        self.tokenizer, self.prefix, self.size = tokenizer, prefix, size
        self.old: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        got = self.old.get(word) or self.tokenizer.word(self.prefix, word)
        if len(word) <= LONG:
            if len(self) >= self.size:
                self.old = dict(self)
                self.clear()
            self[word] = got
        return got


_TOKENIZERS: dict[tuple, Tokenizer] = {}  # one per Python worker and vocabulary


def _tokenizer(key: tuple, ranks: dict[bytes, int], pattern: str) -> Tokenizer:
    if key not in _TOKENIZERS:
        _TOKENIZERS.clear()
        _TOKENIZERS[key] = Tokenizer(ranks, pattern)
    return _TOKENIZERS[key]


def encode_documents(docs: DataFrame, path: str, pattern: str, doc: str = "doc_id", text: str = "text",
                     with_ids: bool = False) -> DataFrame:
    """Per row: ``doc``, n_tokens, ids_sha256 (of the decimal ids joined by spaces), decoded_sha256, and, if
    ``with_ids``, the ids as array<int>.

    The ids are decoded again for ``decoded_sha256``.  Null texts are empty;
    empty texts have no tokens; repeated rows and null keys give a row each;
    other columns are ignored.  Rows are independent: nothing is shuffled, and
    a lost task is simply run again.
    """
    spark = docs.sparkSession
    ranks = load_ranks(path)  # about a megabyte, fixed by the vocabulary
    shared, key = spark.sparkContext.broadcast(ranks), (path, len(ranks), pattern)
    slim = docs.select(F.col(doc).alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(key, shared.value, pattern)
        for b in batches:
            counts, digests, decoded, flat = [], [], [], []
            for t in b.column("text").to_pylist():
                ids = tokenizer.encode(t)
                counts.append(ids.count(b" ") + 1 if ids else 0)
                digests.append(hashlib.sha256(ids).hexdigest())
                decoded.append(hashlib.sha256(tokenizer.decode(ids)).hexdigest())
                if with_ids:
                    flat.append(np.fromstring(ids, dtype=np.int32, sep=" "))
            columns = [b.column("doc"), pa.array(counts, pa.int64()), pa.array(digests, pa.string()),
                       pa.array(decoded, pa.string())]
            if with_ids:
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                values = pa.array(np.concatenate([np.zeros(0, np.int32), *flat]))
                columns.append(pa.ListArray.from_arrays(pa.array(offsets), values))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["doc", "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * with_ids]
    kind = dict(slim.dtypes)["doc"]
    schema = f"doc {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return slim.mapInArrow(run, schema).withColumnRenamed("doc", doc)
