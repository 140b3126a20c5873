"""Winnowing decontamination against a naive scan."""
import hashlib
import random
import re

from pyspark.sql import functions as F

from clickflow.llm import decontaminate as dc

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def naive(docs, items):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(AZ))
    windows = [(i, w[a:a + 10]) for i, t in items for w in [words(t)] if w for a in range(max(1, len(w) - 9))]
    out = []
    for d, t in docs:
        w, hit, named = words(t), set(), set()
        for i, win in windows:
            for a in range(len(w) - len(win) + 1):
                if w[a:a + len(win)] == win:
                    hit.update(range(a, a + len(win)))
                    if i is not None:
                        named.add(str(i))
        out.append((d, len(w), len(hit), len(named), sorted(named), bool(hit)))
    return sorted(out, key=repr)


def test_against_naive(spark):
    rng = random.Random(1)
    vocab = ["a", "B", "é", "Ü7", "日本", "x1"]
    text = lambda n: " ".join(rng.choice(vocab) + rng.choice(["", ".", "--"]) for _ in range(n))
    items = [(i, text(rng.choice([1, 3, 5, 9, 10, 11, 20, 30]))) for i in range(12)] + [(20, None), (None, "zz yy"), (21, ""), (3, "q q q")]
    docs = [(i, text(rng.randint(0, 40)) + (" " + rng.choice(items)[1] if rng.random() < 0.5 and items else ""))
            if i % 7 else (i, None) for i in range(60) for _ in [0] if items]
    docs = [(i, t) for i, t in docs] + [(None, "zz yy"), (5, "other q q q"), (61, text(30000)), (62, "ZZ! YY?"), (62, "ZZ! YY?")]
    items = [(i, t) for i, t in items if t is None or len(t) != 1 or True]
    d = spark.createDataFrame([(a, b, 1, 2, "x") for a, b in docs], "doc_id long, text string, n int, found int, item string")
    b = spark.createDataFrame([(x, y, 0) for x, y in items], "item_id long, text string, pos int")
    got = dc.contamination(d, b).drop("text_hash").collect()
    small = [x for x in docs if x[0] != 61]
    mine = sorted([(r.doc_id, r.n_words, r.n_hit, r.n_items, list(r["items"]), r.contaminated) for r in got if r.doc_id != 61], key=repr)
    assert mine == naive(small, items)
    kept = dc.decontaminate(d, b)
    assert kept.columns == d.columns
    clean = [(x, y) for (x, y), r in zip(small, [naive([z], items)[0] for z in small]) if not r[-1]]
    assert sorted(((r.doc_id, r.text) for r in kept.where("doc_id is null or doc_id <> 61").collect()), key=repr) == sorted(clean, key=repr)
    assert dc.contamination(d.limit(0), b).count() == 0
    none = dc.contamination(d, b.limit(0))
    assert none.where("contaminated").count() == 0 and none.count() == len(docs)


def test_every_shared_span_is_found(spark):
    """Passages of exactly ten words at any offset."""
    rng = random.Random(2)
    item = [f"w{i}" for i in range(30)]
    docs = [(a, " ".join(f"z{rng.randint(0, 999)}" for _ in range(rng.randint(0, 5))) + " " + " ".join(item[a:a + 10]) + " tail")
            for a in range(21)] + [(100 + a, " ".join(item[a:a + 9])) for a in range(21)]
    got = dc.contamination(spark.createDataFrame(docs, "doc_id long, text string"),
                           spark.createDataFrame([(1, " ".join(item))], "item_id long, text string"))
    assert {r.doc_id: r.n_hit for r in got.collect()} == {**{a: 10 for a in range(21)}, **{100 + a: 0 for a in range(21)}}


def test_main_path_runs_no_python(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    plan = dc.contamination(d, d.withColumnRenamed("doc_id", "item_id"))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
    assert d.select(F.sha2(F.lit("x"), 256)).first()[0] == hashlib.sha256(b"x").hexdigest()
