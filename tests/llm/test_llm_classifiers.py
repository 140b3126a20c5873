"""Language identification and toxicity: held-out accuracy, model properties, edges."""
import random

import numpy as np
import pytest

from clickflow.llm import language_id as li
from clickflow.llm import toxicity as tx

SF = "/root/testdata/sf0.01"


def test_probabilities_sum_to_one():
    rng = random.Random(0)
    s = np.concatenate([li.symbols("".join(rng.choice("abc ") for _ in range(400))) for _ in range(3)])
    packed, counts = np.unique(li.grams(s), return_counts=True)
    alphabet = np.unique(s)
    model = li.KneserNey(packed, counts.astype(float), len(alphabet))
    for context in ("abc", "aaa", "c a", "zzz"):
        c = np.uint64(0)
        for x in context:
            c = c << np.uint64(16) | (np.uint64(ord(x)) if x != " " else np.uint64(0))
        p = model.probability((c << np.uint64(16)) | alphabet)
        assert p.sum() == pytest.approx(1, abs=1e-9) and (p > 0).all()


def test_one_array_gives_what_each_model_gives():
    counts = {}
    for k, t in {"x": "the then there theatre", "y": "una unas nada tuna"}.items():
        g, n = np.unique(li.grams(li.symbols(t)), return_counts=True)
        counts[k] = (g, n.astype(float))
    models = li.Models(counts)
    s = li.symbols("then unas qqq")
    direct = [-np.log2(m.probability(li.grams(s))).mean() for m in models.models]
    assert models.entropies(s) == pytest.approx(direct, rel=1e-5)


def test_held_out_languages_and_edges(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = li.identify_by_fold(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out and r.lang]
    assert sum(r.lang_pred == r.lang for r in held) / len(held) > 0.98
    assert sum(r.rejected for r in got) / len(got) < 0.01
    assert all(0 <= r.score <= 1 for r in got)

    models = li.train(docs)
    texts = [None, "", "123 !!", "the and of", "the and of", "xqzj wvkq zzxj qwpz " * 30, "the " * 100000]
    df = spark.createDataFrame([(None if i == 4 else i, t, "q", 1.5, "l") for i, t in enumerate(texts)],
                               "doc_id long, text string, lang string, score double, lang_pred string")
    out = li.identify(df, models)
    assert out.columns == ["doc_id", "text", "lang", "lang_pred", "score", "bits", "rejected"]
    rows = out.collect()
    assert [r.lang_pred for r in rows[:3]] == ["und"] * 3 and all(r.rejected and r.score == 0 for r in rows[:3])
    assert rows[3].lang_pred == rows[4].lang_pred == rows[6].lang_pred == "en" and rows[5].rejected
    assert li.identify(df.limit(0), models).count() == 0
    none = li.identify_by_fold(df.where("false")).count()
    assert none == 0
    untrained = li.identify(df, li.train(docs.where("lang is null")))
    assert {r.lang_pred for r in untrained.collect()} == {"und"}


def test_folding():
    assert tx.fold("YОU 1D10T, st4r$ l@st $5").split() == ["you", "idiot", "star", "last", "s"]
    assert tx.fold("ｆｕｌｌ") == " full "
    assert tx.fold("") == "  "


def test_exceptions_cover_entries():
    lex = tx.Lexicon({" bad ": 2.0, " awf": 1.0}, {" not bad "})
    a = lex.automaton()
    assert tx.weigh(tx.fold("bad"), a) == 2.0
    assert tx.weigh(tx.fold("not bad, bad awful AWFULLY"), a) == 4.0
    assert tx.weigh(tx.fold("nothing"), a) == 0.0 == tx.weigh(" x ", tx.Lexicon().automaton())


def test_held_out_toxicity(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = tx.score_by_fold(docs, labels).join(labels.select("doc_id", "toxic"), "doc_id").where("held_out").collect()
    hit = sum(r.predicted and r.toxic for r in rows)
    assert hit / sum(r.predicted for r in rows) > 0.9 and hit / sum(r.toxic for r in rows) > 0.8
    pos, neg = [r.score for r in rows if r.toxic], [r.score for r in rows if not r.toxic]
    assert np.mean([[(p > n) + 0.5 * (p == n) for n in neg] for p in pos]) > 0.9


def test_toxicity_edges(spark):
    docs = spark.createDataFrame([(i, f"{'vile' if i % 2 else 'good'} w{i} tail", "s", 0.1) for i in range(100)]
                                 + [(200, None, None, None), (201, "", "s", 0.1), (None, "vile thing", "s", 0.2), (202, "V1LE " * 50000, "s", 1.0)],
                                 "doc_id long, text string, predicted string, score double")
    labels = spark.createDataFrame([(i, i % 2, 5) for i in range(100)] + [(1, 1, 5), (None, 1, 5), (7, None, 5), (900, 1, 5)],
                                   "doc_id long, toxic int, text int")
    got = {r.doc_id: r for r in tx.score_by_fold(docs, labels).collect()}
    assert len(got) == 104
    assert all(got[i].predicted == i % 2 for i in range(100))
    assert got[None].predicted == 1 and got[202].predicted == 1 and got[200].predicted == 0 and got[200].score == got[201].score
    assert tx.score_by_fold(docs.limit(0), labels).count() == 0
    unlabelled = tx.score_by_fold(docs, labels.limit(0)).collect()
    assert len(unlabelled) == 104 and {r.predicted for r in unlabelled} == {0}


def test_phrases_of_toxic_texts_are_no_exceptions(spark):
    """However few toxic texts hold a phrase, it hides no entry."""
    toxic = [f"a{i} vile b{i}" for i in range(40)] + [f"not vile c{i}" for i in range(2)]
    clean = [f"not vile d{i}" for i in range(4)] + [f"so vile e{i}" for i in range(3)] + [f"good f{i}" for i in range(50)]
    rows = [(i, t, int(i < len(toxic))) for i, t in enumerate(toxic + clean)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    lexicon = tx.learn(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    assert " vile " in lexicon.weights and lexicon.exceptions == {" so vile "}


def test_all_grams_of_the_sample_count(spark):
    """Large alphabets have more than a few hundred thousand n-grams, most of them seen once."""
    rng = np.random.default_rng(6)
    texts = ["".join(map(chr, x)) for x in rng.integers(0x4E00, 0x9000, (300, 1000))]
    df = spark.createDataFrame([(i, t, "zz") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    models = li.train(df)
    grams = np.unique(np.concatenate([li.grams(li.symbols(t)) for t in texts]))
    assert len(grams) > 250_000 and len(models.keys) == len(grams)
