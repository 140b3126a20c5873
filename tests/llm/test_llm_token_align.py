"""Cross-tokenizer alignment against a token-by-token version that uses the public libraries on whole texts."""
from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clickflow.llm import token_align as ta

FILES = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"), P.PATTERN
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


class Naive:
    def __init__(self):
        self.a = Tokenizer.from_file(FILES[0])
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=FILES[1])
        self.letters = ta.byte_letters()

    def groups_and_links(self, text):
        if not text:
            return None
        a, b, p = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text), self.b
        x = [bytes(self.letters[c] for c in self.a.id_to_token(i)) for i in a]
        y = [bytes([int(p.id_to_piece(i)[3:5], 16)]) if p.is_byte(i) else p.id_to_piece(i).replace("▁", " ").encode()
             for i in b]
        raw = (" " + text).encode()
        if b"".join(x) != raw or b"".join(y) != raw:
            return None
        ends = [np.cumsum([0, *map(len, t)]).tolist() for t in (x, y)]
        links = [(a[i], b[j]) for i in range(len(a)) for j in range(len(b))
                 if ends[0][i] < ends[1][j + 1] and ends[1][j] < ends[0][i + 1]]
        groups, i, j = [], 0, 0
        for end in sorted(set(ends[0][1:]) & set(ends[1][1:])):
            i2, j2 = ends[0].index(end), ends[1].index(end)
            groups.append(",".join(map(str, a[i:i2])) + "|" + ",".join(map(str, b[j:j2])))
            i, j = i2, j2
        return len(a), len(b), groups, links

    def table(self, texts):
        found = [self.groups_and_links(t) for t in texts]
        count = Counter(link for f in found if f for link in f[3])
        most = {}
        for (_, b), n in count.items():
            most[b] = max(n, most.get(b, 0))
        return [(0, 0, 0, 0, 0, 0, "") if f is None else
                (f[0], f[1], len(f[2]), len(f[3]), sum(count[x] == most[x[1]] for x in f[3]), sum(count[x] for x in f[3]),
                 hashlib.sha256(";".join(f[2]).encode()).hexdigest()) for f in found]


@pytest.fixture(scope="module")
def naive():
    return Naive()


TEXTS = [
    None, "", " ", "\n", "a", "  two  spaces ", "tab\there and there", "line\nline\n\nline", " lead", "trail ", "x \n y",
    "<|endoftext|> and <s> </s> <0x41> <unk>", "U+2581 ▁ inside", "naïve café Êtes-vous là", "漢字かな交じり文 と 空白", "😀😃 👩‍👩‍👧",
    "don't they'll we've I'd", "1234567 3.14159 1,000,000", "ﬁ ligature Å combining á", "\x00\x01\x1f control", "same same same",
    "same same same", "ends in tab\t\t next", "  separators   \x85 x", "CamelCaseWordsAnd_snake_case --flags=1",
]


def _rows(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_equal_to_whole_texts(spark, naive):
    rng = random.Random(7)
    pieces = [" ", "\n", "the ", "thntwhre", "é", "▁", "\t", "漢", "a", ",", "ing ", "12", " ", "  "]
    texts = TEXTS + ["".join(rng.choices(pieces, [9, 3, 5, 5, 3, .05, .3, 1, 4, 1, 4, 1, .2, .3], k=rng.randint(1, 60)))
                     for _ in range(150)]
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in ta.link_statistics(_rows(spark, texts), *FILES).collect()}
    assert [got[i] for i in range(len(texts))] == naive.table(texts)


def test_small_chunks_blocks_and_memory(spark, naive, monkeypatch):
    texts = TEXTS + ["the other of them " * 40]
    want = naive.table(texts)
    docs = _rows(spark, texts).repartition(3)
    got = ta.link_statistics(docs, *FILES, memory=3, chunk_entries=5)
    assert [tuple(r[c] for c in COLUMNS) for r in got.orderBy("doc_id").collect()] == want
    pair = ta.Pair(ta.load_byte_bpe(FILES[0]), open(FILES[1], "rb").read(), FILES[2], memory=2)
    names = ta.Names(pair)
    monkeypatch.setattr(ta, "BLOCK", 2)
    for text, row in zip(texts, want):
        one = ta._Text(text, pair, names, True)
        assert (one.n_a, one.n_b, one.n_groups, one.n_links, one.digest) == (*row[:4], row[6])
        assert one.groups.count(";") == max(0, one.n_groups - 1)


def test_diagonal_runs_on_random_ends():
    rng = random.Random(3)
    for _ in range(500):
        last = rng.randint(1, 60)
        a, b = (np.array(sorted(set(rng.sample(range(1, last + 1), rng.randint(0, last))) | {last})) for _ in range(2))
        runs, odd = ta.diagonal_runs(a, b)
        groups = sorted([(i + k, i + k + 1, j + k, j + k + 1) for i, j, n in runs for k in range(n)]
                        + [g for g in odd if g[0] < g[1]])
        common = sorted(set(a) & set(b))
        i, j = ([0, *(np.searchsorted(e, common) + 1).tolist()] for e in (a, b))
        assert groups == list(zip(i, i[1:], j, j[1:]))
    assert ta.diagonal_runs(np.arange(1, 1001), np.arange(1, 1001)) == ([(0, 0, 1000)], [(1000, 1000, 1000, 1000)])


def test_groups_text(spark, naive):
    texts = ["the quick brown fox", None, "of thntwhre"]
    got = {r.doc_id: r for r in ta.align_documents(_rows(spark, texts), *FILES).collect()}
    for i, text in enumerate(texts):
        want = naive.groups_and_links(text)
        assert got[i].groups == (";".join(want[2]) if want else "")
        assert got[i].n_links == (len(want[3]) if want else 0)


def test_edges(spark):
    docs = _rows(spark, ["a b", "a b", None]).withColumns(
        {c: F.lit(c) for c in ("chunk", "at", "n", "pairs", "n_a", "doc", "of", "count")})
    rows = ta.link_statistics(docs, *FILES).orderBy("doc_id").collect()
    assert rows[0][1:] == rows[1][1:] and rows[2].n_a == 0 and rows[2].groups_sha256 == ""
    nulls = docs.withColumn("doc_id", F.lit(None).cast("long"))
    assert ta.link_statistics(nulls, *FILES).count() == 3
    assert ta.link_statistics(docs.where("false"), *FILES).count() == 0
    long = "antion the " * 30_000
    got = ta.link_statistics(_rows(spark, [long]), *FILES).first()
    assert got.n_a >= 60_000 and got.n_groups > 0


def test_ids_must_follow_merges(tmp_path):
    import json
    spec = json.load(open(FILES[0]))
    spec["model"]["merges"].reverse()
    (tmp_path / "v.json").write_text(json.dumps(spec))
    with pytest.raises(ValueError):
        ta.load_byte_bpe(str(tmp_path / "v.json"))
