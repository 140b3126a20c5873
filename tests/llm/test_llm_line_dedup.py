"""Line dedup against longest previous factors found naively."""
import random

from clickflow.llm import line_dedup as ld


def naive(docs, min_words):
    """Lines deleted: for each position the longest earlier copy of what follows, if it has enough words."""
    seqs = {}
    for d, t in docs:
        ls = [(no, s.strip(" \t\r")) for no, s in enumerate((t or "").split("\n"))]
        seqs[(d, t)] = [(no, s) for no, s in ls if s.split()]
    order = sorted(seqs, key=lambda k: (k[0] is not None, k[0] or 0))
    gone = {k: set() for k in seqs}
    places = [(k, i) for k in order for i in range(len(seqs[k]))]
    for a, (k, i) in enumerate(places):
        best = 0
        for k2, j in places[:a]:
            n = 0
            while i + n < len(seqs[k]) and j + n < len(seqs[k2]) and seqs[k][i + n][1] == seqs[k2][j + n][1]:
                n += 1
            best = max(best, n)
        run = seqs[k][i:i + best]
        if sum(len(s.split()) for _, s in run) >= min_words:
            gone[k].update(no for no, _ in run)
    return {k: "\n".join(s for no, s in enumerate((k[1] or "").split("\n")) if no not in g) if k[1] is not None else None
            for k, g in gone.items()}


def make(rng, i):
    lines = [" ".join(rng.choice("abc") for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(0, 14))]
    lines = [x if rng.random() > 0.1 else rng.choice(["", "  ", x + " \r"]) for x in lines]
    return i, "\n".join(lines)


def check(spark, docs, min_words):
    df = spark.createDataFrame([(a, b, 7, "k") for a, b in docs], "doc_id long, text string, ord int, island string")
    got = ld.dedup_lines(df, min_words=min_words)
    assert got.columns == [*df.columns, "deleted_lines"]
    want = naive(docs, min_words)
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == sorted(((d, want[(d, t)]) for d, t in docs), key=repr)


def test_against_naive(spark):
    rng = random.Random(4)
    docs = [make(rng, i) for i in range(30)]
    docs += [(None, docs[3][1]), (40, None), (41, ""), (42, docs[5][1]), (43, "\n".join(["a b"] * 40)), docs[7], docs[7]]
    check(spark, docs, 4)
    check(spark, docs, 9)


def test_long_document_and_default_threshold(spark):
    rng = random.Random(6)
    passage = "\n".join(" ".join(f"w{rng.randint(0, 10**6)}" for _ in range(17)) for _ in range(3))  # 51 words
    other = lambda n: "\n".join(" ".join(f"u{rng.randint(0, 10**6)}" for _ in range(9)) for _ in range(n))
    docs = [(1, other(3) + "\n" + passage + "\n" + other(2)), (2, passage), (3, other(2) + "\n" + passage), (4, other(3000)),
            (5, passage.rsplit("\n", 1)[0])]  # 34 words: too short to be a repeat
    check(spark, docs, 50)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.doc_id for r in ld.dedup_lines(df, keep_empty=False).collect()} == {1, 3, 4, 5}


def test_empty_table(spark):
    assert ld.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0
