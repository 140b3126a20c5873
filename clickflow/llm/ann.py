"""Nearest neighbours by inner product, exact, from blocks of scores.

The vectors are dealt into parts by a hash of the id and the queries into
turns of ``TURN`` rows; every pair of a part and a turn is one group, scored by
matrix products in bounded slices, and gives its best ``TOP`` + 1 ids a query.
The best of all parts are the answer.  A vector moves once per turn, a query
once per part.  There are ``PARTS`` parts until one would hold more than
``BLOCK`` vectors, so a group's memory is bounded.

Every query is compared with every vector: the work is their product, and no
limit on candidates, hash or norm decides what is found.  README gives the cost.

A matrix product's rounding depends on a row's place, so it only rules out what
is below the last rank by more than its error bound; what is left is scored row
by row.  Of vectors that are equal in all components only the TOP + 1 with the
smallest ids can be among the nearest; the others are never compared.  Equal
query vectors are searched once.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickflow.llm.common import materialize

TOP = 20
PARTS = 32            # parts the vectors are dealt into, at least
BLOCK = 131_072       # vectors in a part, about, at most
TURN = 16_384         # queries in a turn, about
ROWS, COLUMNS = 256, 8_192  # queries and vectors in one matrix product
PAIRS = 65_536        # pairs scored row by row at once


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def valid_vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v, dim, h1, h2) of the rows that take part; (h1, h2) names equal vectors."""
    v = F.col(vector)
    rows = df.select(F.col(key).alias("id"), v.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0))
    # 0.0 and -0.0 are one number.
    rows = rows.withColumn("v", F.transform("v", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x).cast("double")))
    return rows.select("id", "v", F.size("v").alias("dim"), F.xxhash64("v").alias("h1"),
                       F.xxhash64(F.lit(1), "v").alias("h2"))


KEYS = ["dim", "part", "turn"]


def _first(row: np.ndarray, ids: np.ndarray, scores: np.ndarray, top: int) -> tuple[np.ndarray, ...]:
    """The best ``top`` of each row, an id once with its best score; ties go to the smaller id."""
    order = np.lexsort((-scores, ids, row))
    row, ids, scores = row[order], ids[order], scores[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (ids[1:] != ids[:-1])
    row, ids, scores = row[new], ids[new], scores[new]
    order = np.lexsort((ids, -scores, row))
    row, ids, scores = row[order], ids[order], scores[order]
    keep = np.arange(len(row)) - np.searchsorted(row, row) < top
    return row[keep], ids[keep], scores[keep]


def nearest(entries: np.ndarray, ids: np.ndarray, asked: np.ndarray, top: int) -> tuple[np.ndarray, ...]:
    """(row of ``asked``, id, score): the best ``top`` ids among ``entries`` for each row."""
    order = np.argsort(ids, kind="stable")
    entries, ids = entries[order], ids[order]
    error = 4 * (entries.shape[1] + 1) * np.finfo(float).eps
    norms, asked_norms = (np.sqrt((x * x).sum(axis=1)) for x in (entries, asked))
    out: list[tuple[np.ndarray, ...]] = []
    for a in range(0, len(asked), ROWS):
        q = asked[a:a + ROWS]
        best = (np.zeros(0, np.int64), np.zeros(0, ids.dtype), np.zeros(0))
        last = np.full(len(q), -np.inf)  # score of the last rank so far
        for c in range(0, len(entries), COLUMNS):
            part, part_ids = entries[c:c + COLUMNS], ids[c:c + COLUMNS]
            rough = q @ part.T
            slack = error * asked_norms[a:a + ROWS] * norms[c:c + COLUMNS].max()
            starts = np.flatnonzero(np.r_[True, part_ids[1:] != part_ids[:-1]])
            if np.isinf(last).any() and len(starts) > top:
                by_id = rough if len(starts) == len(part_ids) else np.maximum.reduceat(rough, starts, axis=1)
                last = np.maximum(last, np.partition(by_id, -top, axis=1)[:, -top] - slack)
            row, at = np.nonzero(rough >= (last - slack)[:, None])
            for p in range(0, len(row), PAIRS):
                r, e = row[p:p + PAIRS], at[p:p + PAIRS]
                # Row by row, so that equal vectors get equal scores.
                exact = (part[e] * q[r]).sum(axis=1)
                best = _first(*(np.concatenate(x) for x in zip(best, (r, part_ids[e], exact))), top)
            full = np.bincount(best[0], minlength=len(q)) == top
            ends = np.searchsorted(best[0], np.flatnonzero(full), "right") - 1
            last[full] = best[2][ends]
        out.append((best[0] + a, best[1], best[2]))
    return tuple(np.concatenate(x) for x in zip(*out))


def search(vectors: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", top: int = TOP,
           candidates: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest ``top`` found of all ``vectors`` but the query's own id.

    Vectors that are null, zero, or hold null or non-finite components take
    no part on either side, nor do null ids.  Vectors of other lengths are
    never compared.  Ties go to the smaller id; a query id that is repeated is
    answered once for each different vector it has; an empty table gives no
    rows.  Scores are inner products of the vectors as given, in double
    precision.  Other columns are ignored.  ``candidates`` limits nothing any
    more; calls that give it get the exact answer too.
    """
    everyone = valid_vectors(vectors, key, vector)
    asked = materialize(valid_vectors(queries, key, vector).dropDuplicates(["id", "h1", "h2"]), "ann-queries")
    equal = Window.partitionBy("dim", "h1", "h2").orderBy("id")
    indexed = materialize(everyone.dropDuplicates(["id", "h1", "h2"]).withColumn("n", F.row_number().over(equal))
                          .where(F.col("n") <= top + 1).drop("n"), "ann-vectors")
    distinct = asked.dropDuplicates(["dim", "h1", "h2"]).drop("id")
    parts = max(PARTS, -(-indexed.count() // BLOCK))
    turns = max(1, -(-asked.count() // TURN))

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = indexed.select("dim", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("part"),
                          every(turns).alias("turn"), "id", "v")
    right = distinct.select("dim", every(parts).alias("part"),
                            F.pmod(F.col("h1"), F.lit(turns)).cast("int").alias("turn"), "h1", "h2", "v")

    def score(a: pa.Table, b: pa.Table) -> pa.Table:
        if not a.num_rows or not b.num_rows:
            return _scores([], [], [], [], [])
        dim = a.column("dim")[0].as_py()
        row, ids, scores = nearest(_matrix(a.column("v"), dim), a.column("id").to_numpy(), _matrix(b.column("v"), dim),
                                   top + 1)
        h1, h2 = (b.column(x).to_numpy()[row] for x in ("h1", "h2"))
        return _scores(np.full(len(row), dim), h1, h2, ids, scores)

    scored = (left.groupBy(*KEYS).cogroup(right.groupBy(*KEYS))
              .applyInArrow(score, "dim int, h1 bigint, h2 bigint, vec_id bigint, score double"))
    best = Window.partitionBy("dim", "h1", "h2").orderBy(F.desc("score"), "vec_id")
    lists = (scored.groupBy("dim", "h1", "h2", "vec_id").agg(F.max("score").alias("score"))
             .withColumn("n", F.row_number().over(best)).where(F.col("n") <= top + 1).drop("n"))
    answers = (asked.select(F.col("id").alias("query_id"), "dim", "h1", "h2").join(lists, ["dim", "h1", "h2"])
               .where("vec_id <> query_id"))
    final = Window.partitionBy("query_id", "h1", "h2").orderBy(F.desc("score"), "vec_id")
    kind = dict(vectors.dtypes)[key]
    return (answers.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= top)
            .select(F.col("query_id").cast(kind).alias("query_id"), "rank", F.col("vec_id").cast(kind).alias("vec_id"),
                    "score"))


def _scores(dim, h1, h2, ids, scores) -> pa.Table:
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
    return pa.table([pa.array(c, k) for c, k in zip((dim, h1, h2, ids, scores), kinds)],
                    names=["dim", "h1", "h2", "vec_id", "score"])


def brute_force(vectors: np.ndarray, ids: np.ndarray, at: np.ndarray, top: int = TOP) -> list[list[int]]:
    """The true nearest ids of the vectors at places ``at`` (for measuring recall)."""
    out = []
    for i in at:
        s = (vectors * vectors[i]).sum(axis=1)
        s[i] = -np.inf
        out.append([int(ids[j]) for j in np.lexsort((ids, -s))[:min(top, len(ids) - 1)]])
    return out
