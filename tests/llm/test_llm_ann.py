"""Hash-prefix forest against brute force."""
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from clickflow.llm import ann


def run(spark, rows, top=20, **kw):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score double, rank int, h1 int")
    out = {}
    for r in ann.search(df, df.where("vec_id % 20 = 0"), top=top, **kw).orderBy("query_id", "rank").collect():
        assert r["rank"] == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def table(v, ids=None):
    return [(int(i), None if x is None else [None if y is None else float(y) for y in x], 1.0, 2, 3)
            for i, x in zip(ids if ids is not None else range(len(v)), v)]


def test_edges_ties_and_norms(spark):
    rng = np.random.default_rng(1)
    v = [x * s for x, s in zip(rng.normal(size=(300, 8)).astype(np.float32), rng.uniform(0.1, 5, 300))]
    v[40:120] = [v[40]] * 80                       # a common vector
    rows = table([x.astype(np.float32) for x in v])
    rows += table([None, [0.0] * 8, [float("nan")] * 8, [None] + [1.0] * 7, [float("inf")] * 8, [1.0] * 5, []], range(400, 407))
    rows += [rows[0], (None, rows[1][1], 1.0, 1, 1)]
    got = run(spark, rows)
    m = np.array([r[1] for r in rows[:300]], dtype=float)
    assert sorted(got) == list(range(0, 300, 20))
    for q, found in got.items():
        s = (m * m[q]).sum(axis=1)
        s[q] = -np.inf
        want = np.lexsort((np.arange(300), -s))[:20]
        assert [i for i, _ in found] == want.tolist()
        assert [x for _, x in found] == s[want].tolist()


def test_few_vectors_and_empty_table(spark):
    got = run(spark, table(np.eye(4)))
    assert [i for i, _ in got[0]] == [1, 2, 3]
    assert run(spark, table(np.eye(4))[:1]) == {}
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert ann.search(df, df).count() == 0


def test_recall_where_the_search_is_cut_short(spark, monkeypatch):
    """Blocks, parts and ascending all in use."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 32))
    v = centres[rng.integers(0, 40, 3000)] + 0.5 * rng.normal(size=(3000, 32))
    monkeypatch.setattr(ann, "BLOCK", 200)
    got = run(spark, table(v.astype(np.float32)), candidates=8000)
    m = v.astype(np.float32).astype(float)
    at = np.arange(0, 3000, 20)
    true = ann.brute_force(m, np.arange(3000), at)
    recall = np.mean([len({i for i, _ in got[int(q)]} & set(t)) / 20 for q, t in zip(at, true)])
    assert recall >= 0.9


def unit_vectors(seed, n, dim=64):
    v = np.random.default_rng(seed).normal(size=(n, dim))
    return (v / np.sqrt((v * v).sum(axis=1))[:, None]).astype(np.float32)


def found_in_table(spark, folder, v, every):
    """The ids found for every so manieth vector of ``v``, read from Parquet."""
    pq.write_table(pa.table({"vec_id": np.arange(len(v)), "embedding": list(v)}), f"{folder}/v.parquet")
    df = spark.read.parquet(f"{folder}/v.parquet")
    out = {}
    for r in ann.search(df, df.where(f"vec_id % {every} = 0")).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append(r.vec_id)
    return out


def test_large_table_is_searched_whole(spark, tmp_path):
    v = unit_vectors(3, 60_000)
    at = np.arange(0, len(v), 1000)
    got = found_in_table(spark, tmp_path, v, 1000)
    assert [got[int(q)] for q in at] == ann.brute_force(v.astype(float), np.arange(len(v)), at)


def test_one_long_vector_hides_no_neighbours(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 50)
    v = unit_vectors(4, 5000, 16)
    v[2501] *= 100
    at = np.arange(0, len(v), 50)
    got = found_in_table(spark, tmp_path, v, 50)
    assert [got.get(int(q)) for q in at] == ann.brute_force(v.astype(float), np.arange(len(v)), at)


def test_repeated_ids_and_ties_at_the_last_rank():
    rng = np.random.default_rng(5)
    v = rng.integers(-1, 2, (3000, 6)).astype(float)  # few different scores, so ties at every rank
    ids = rng.integers(0, 900, len(v))
    row, found, scores = ann.nearest(v, ids, v[:300], 20)
    for q in range(300):
        best = {}
        for i, s in zip(ids.tolist(), (v * v[q]).sum(axis=1).tolist()):
            best[i] = max(best.get(i, s), s)
        want = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:20]
        assert list(zip(found[row == q].tolist(), scores[row == q].tolist())) == want
