"""Byte-level BPE against tiktoken."""
import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken

from clickflow.llm import bpe

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def tokenizer():
    return bpe.Tokenizer(bpe.load_ranks(PATH), P.PATTERN, memory=50)


@pytest.fixture(scope="module")
def reference(tokenizer):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=tokenizer.v.ranks, special_tokens={})


def ids(t, text):
    return [int(i) for i in t.encode(text).split()]


def test_random_texts(tokenizer, reference):
    rng = random.Random(0)
    alphabet = "abcdeth  \n\t\r'sllre1230½٣日本語🙂éÉ.,!?-_\x0b\x0c\x1c\x85\xa0 　ſK"
    for _ in range(3000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))
        assert ids(tokenizer, text) == reference.encode_ordinary(text), repr(text)
        assert tokenizer.decode(tokenizer.encode(text)) == text.encode()


def test_long_words(tokenizer, reference):
    for text in ("a" * 5000, "thth" * 3000, " " * 3000 + "x", "日本" * 2000, "<|endoftext|>", "ab " * 5000, "x\n" * 3000):
        assert ids(tokenizer, text) == reference.encode_ordinary(text)


def test_appends_and_edits_are_exact(tokenizer):
    rng = random.Random(1)
    v = tokenizer.v
    for _ in range(40):
        text = bytes(rng.choice(b"thenatio rs") for _ in range(rng.randint(1, 400)))
        e = bpe.Encoding(v)
        for a in range(0, len(text), 7):
            e.append(text[a:a + 7])
        assert e.last == bpe.Encoding(v, text).last
        a = rng.randint(0, len(text))
        b = rng.randint(a, min(len(text), a + 9))
        new = bytes(rng.choice(b"theq") for _ in range(rng.randint(0, 6)))
        e.replace(a, b, new)
        fresh = bpe.Encoding(v, text[:a] + new + text[b:])
        assert e.last == fresh.last and bytes(e.text) == bytes(fresh.text)
        assert b"".join(v.text[i] for i in e.ids()) == bytes(e.text)
    e = bpe.Encoding(v, b"the cat sat on the mat " * 400)
    assert e.replace(50, 52, b"og") < 2000  # the table is taken up again soon after the edit


def test_table_edges(spark, reference):
    texts = ["a b", "a b", None, "", "é" * 100000, "x  y\n\nz", "<|endoftext|>"]
    df = spark.createDataFrame([(i if i != 2 else None, t, 9, "k") for i, t in enumerate(texts)],
                               "doc_id long, text string, n_tokens int, ids string")
    got = {r.doc_id: r for r in bpe.encode_documents(df, PATH, P.PATTERN, with_ids=True).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        want, r = reference.encode_ordinary(t or ""), got[i if i != 2 else None]
        assert list(r["ids"]) == want and r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    assert bpe.encode_documents(df.limit(0), PATH, P.PATTERN).count() == 0


def test_given_documents(spark, reference):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in df.collect()}
    for r in bpe.encode_documents(df, PATH, P.PATTERN).collect():
        want = reference.encode_ordinary(texts[r.doc_id])
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()
