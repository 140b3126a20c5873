"""The corpus pipeline stage by stage against brute force, and its edges."""
import hashlib

import public_tokenizers as P
import tiktoken

import corpus_pipeline as C
from clickflow.llm.bpe import load_ranks
from clickflow.llm.common import materialize
from clickflow.llm.language_id import identify, train
from test_llm_decontaminate import naive as contaminated
from test_llm_line_dedup import naive as line_dedup
from test_llm_ngram_join import naive as components

SF = "/root/testdata/sf0.001"


def key(r):
    return repr(r.doc_id), repr(r.text)


def test_stages_against_brute_force(spark):
    given = spark.read.parquet(f"{SF}/documents.parquet")
    some = given.orderBy("doc_id").limit(3).collect()
    more = [(None, some[0].text, "en", None, 1), (9001, None, None, None, None), (9002, "", "en", "s", 0),
            (9003, "12 34 !!", "en", "s", 8), (9004, some[1].text + " tail", None, "s", 5),
            (9005, "the of and that\n" * 40, "en", "s", 1), (some[2].doc_id, some[2].text, "en", "s", 1)]
    docs = materialize(given.union(spark.createDataFrame(more, given.schema)), "fixture")
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    reached = {}
    for name, stage in C.STAGES:
        out = materialize(stage(spark, docs, SF), name)
        before, after = docs.collect(), out.collect()
        reached[name] = len(after)
        pairs = [(r.doc_id, r.text) for r in before]
        if name == "language_id":
            learned = docs.where("doc_id is null or crc32(cast(cast(doc_id as string) as binary)) % 5 <> 0")
            ok = {(r.doc_id, r.text) for r in identify(docs, train(learned)).where("not rejected").collect()}
            assert sorted(map(key, after)) == sorted(key(r) for r in before if (r.doc_id, r.text) in ok)
            assert not {9001, 9002, 9003} & {r.doc_id for r in after} and 9004 in {r.doc_id for r in after}
        elif name == "line_dedup":
            new = line_dedup(pairs, 50)
            want = sorted((repr(d), repr(new[d, t])) for d, t in pairs if new[d, t] == t or new[d, t].split())
            assert sorted(map(key, after)) == want
            old = {(r.text, r.n_chars) for r in before}
            assert all((r.text, r.n_chars) in old or r.n_chars == len(r.text) for r in after)
        elif name == "ngram_join":
            comps = components(pairs, 5, 80)
            stay = {d for d, n, c in comps if d == c and d is not None}
            assert sorted(r.doc_id for r in after if r.doc_id is not None) == sorted(stay)
        elif name == "benchmark_decontamination":
            dirty = {(d, t) for d, t in pairs if contaminated([(d, t)], bench)[0][-1]}
            assert sorted(map(key, after)) == sorted(key(r) for r in before if (r.doc_id, r.text) not in dirty) and dirty
        else:
            enc = tiktoken.Encoding("own", pat_str=P.PATTERN, special_tokens={},
                                    mergeable_ranks=load_ranks(P.path("byte_bpe_50k.tiktoken")))
            texts = {r.doc_id: r.text for r in before}
            for r in after:
                ids = enc.encode_ordinary(texts[r.doc_id])
                assert list(r["ids"]) == ids and r.n_tokens == len(ids)
                assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
        if name != "bpe":
            assert out.columns == given.columns and out.dtypes == given.dtypes
        docs = out
    assert reached["line_dedup"] < reached["language_id"] and reached["bpe"] == reached["benchmark_decontamination"] > 0


def test_empty_documents_and_extra_columns(spark):
    given = spark.read.parquet(f"{SF}/documents.parquet")
    wide = given.limit(40).selectExpr("*", "1 as node", "'x' as text_hash", "'y' as lang_pred", "2 as deleted_lines", "'z' as item")
    for docs in (given.limit(0), wide):
        for name, stage in C.STAGES[:-1]:
            if "deleted_lines" in docs.columns and name == "line_dedup":
                docs = docs.drop("deleted_lines")
            out = materialize(stage(spark, docs, SF), name)
            assert out.columns == docs.columns or name == "language_id"
            docs = out
        C.STAGES[-1][1](spark, docs, SF).count()
