"""Language identification with character language models.

One interpolated Kneser-Ney model of order ``ORDER`` per language, over lower
case letters with each run of other characters as one blank.  N-grams are 64-bit hashes in sorted arrays, found by binary search; the
n-grams of all languages share one array with a column of log probabilities
for each language, so a character costs one search.  The language with the
lowest cross-entropy per character wins.  A text is rejected if even that is
higher than what the language's own training texts show (their 99.9 %
quantile plus ``MARGIN`` bits).

Training counts n-grams of a sample of bounded size: about ``SAMPLE_DOCS``
texts of each language, picked by a hash of the id, counted whole on the
executors.  The driver gets the counts of all n-grams of the sample, so the
sample's size bounds them, and sends the arrays to the executors.
"""
from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from clickflow.llm.common import crc_fold, materialize

ORDER = 4
SAMPLE_DOCS = 3000
MARGIN = 1.0        # bits per character
CONFIDENCE = 20.0   # characters of evidence behind ``score``
UNDETERMINED = "und"
MIX = np.uint64(0x9E3779B97F4A7C15)  # odd, so that hashing is one to one
BITS = np.uint64(16)
BLOCK = 1 << 20     # characters scored at once


@cache
def _letters() -> np.ndarray:
    """Symbol of each code point: 0 for what is not a letter, else 1 to 65535 (65535: letters past the BMP)."""
    table = np.zeros(sys.maxunicode + 1, dtype=np.uint64)
    table[[i for i in range(sys.maxunicode + 1) if chr(i).isalpha()]] = 1
    points = np.arange(len(table), dtype=np.uint64)
    return np.where(table == 1, np.minimum(np.maximum(points, 1), 65535), 0).astype(np.uint64)


def symbols(text: str) -> np.ndarray:
    """Letters of the lower-cased text, runs of others as one 0, a 0 before and after."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    s = np.concatenate([[0], _letters()[points], [0]]).astype(np.uint64)
    keep = np.ones(len(s), dtype=bool)
    keep[1:] = (s[1:] != 0) | (s[:-1] != 0)
    return s[keep]


def grams(s: np.ndarray) -> np.ndarray:
    """The packed n-gram of ORDER symbols that ends at each symbol but the first (blanks before the text)."""
    padded = np.concatenate([np.zeros(ORDER - 2, dtype=np.uint64), s])
    packed = np.zeros(len(s) - 1, dtype=np.uint64)
    for i in range(ORDER):
        packed = (packed << BITS) | padded[i:i + len(packed)]
    return packed


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of hashed ``wanted`` in the sorted ``keys``, and whether they are there."""
    if not len(keys):
        return np.zeros(len(wanted), dtype=np.int64), np.zeros(len(wanted), dtype=bool)
    hashed = wanted * MIX
    at = np.searchsorted(keys, hashed)
    at[at == len(keys)] = 0
    return at, keys[at] == hashed


def _sorted(packed: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    hashed = packed * MIX
    order = np.argsort(hashed)
    return [hashed[order], *(v[order] for v in values)]


class KneserNey:
    """Interpolated Kneser-Ney over packed n-grams (0 is a symbol like any other)."""

    def __init__(self, packed: np.ndarray, counts: np.ndarray, alphabet: int):
        self.floor = 1.0 / max(alphabet, 1)
        self.levels: list[tuple[np.ndarray, ...]] = []  # for order 1, 2, ...
        for order in range(ORDER, 0, -1):
            ones, twos = (counts == 1).sum(), (counts == 2).sum()
            discount = ones / (ones + 2 * twos) if ones and twos else 0.5
            contexts, where = np.unique(packed >> BITS, return_inverse=True)
            total = np.bincount(where, counts)
            kinds = np.bincount(where)
            keys, own = _sorted(packed, (counts - discount) / total[where])
            ckeys, back = _sorted(contexts, discount * kinds / total)
            self.levels.insert(0, (keys, own, ckeys, back))
            # Lower orders count in how many places an n-gram stands, not how often.
            keep = np.uint64((1 << 16 * (order - 1)) - 1)
            packed, counts = np.unique(packed & keep, return_counts=True)
            counts = counts.astype(float)

    def probability(self, packed: np.ndarray, order: int = ORDER) -> np.ndarray:
        if order == 0 or not len(packed):
            return np.full(len(packed), self.floor)
        keys, own, ckeys, back = self.levels[order - 1]
        keep = np.uint64((1 << 16 * (order - 1)) - 1)
        lower = self.probability(packed & keep, order - 1)
        at, there = _find(ckeys, packed >> BITS)
        p = np.where(there, back[at] if len(back) else 1.0, 1.0) * lower
        at, there = _find(keys, packed)
        return p + np.where(there, own[at] if len(own) else 0.0, 0.0)


class Models:
    """The languages' models over one sorted array of n-grams."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.langs = sorted(counts)
        every = np.unique(np.concatenate([counts[x][0] for x in self.langs] or [np.zeros(0, np.uint64)]))
        alphabet = len(np.unique(every & np.uint64(65535)))
        self.models = [KneserNey(*counts[x], alphabet) for x in self.langs]
        logs = np.stack([np.log2(m.probability(every)) for m in self.models], axis=1) if self.langs else np.zeros((0, 0))
        self.keys, self.logs = _sorted(every, logs.astype(np.float32))
        self.limits = np.full(len(self.langs), np.inf)

    def entropies(self, s: np.ndarray) -> np.ndarray:
        """Bits per character of symbols ``s`` in each language."""
        packed = grams(s)
        total = np.zeros(len(self.langs))
        for a in range(0, len(packed), BLOCK):
            part = packed[a:a + BLOCK]
            at, there = _find(self.keys, part)
            total += self.logs[at[there]].sum(axis=0, dtype=np.float64) if len(self.keys) else 0.0
            rare, often = np.unique(part[~there], return_counts=True)
            if len(rare):
                total += [(np.log2(m.probability(rare)) * often).sum() for m in self.models]
        return -total / len(packed)

    def judge(self, text: str | None) -> tuple[str, float, float | None, bool]:
        """(language, score, bits per character, rejected)."""
        s = symbols(text) if text else None
        if s is None or not self.langs or not s.any():
            return UNDETERMINED, 0.0, None, True
        bits = self.entropies(s)
        best = int(bits.argmin())  # ties: the first name
        odds = np.exp2(-(bits - bits[best]) * CONFIDENCE)
        return self.langs[best], float(1 / odds.sum()), float(bits[best]), bool(bits[best] > self.limits[best])


def train(docs: DataFrame, text: str = "text", lang: str = "lang", doc: str = "doc_id",
          sample_docs: int = SAMPLE_DOCS) -> Models:
    """Models for every non-null ``lang`` of ``docs``; about ``sample_docs`` texts of each are counted."""
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy(lang).count().collect()}
    if not sizes:
        return Models({})
    share = F.element_at(F.create_map(*[x for k, n in sizes.items() for x in
                                        (F.lit(k), F.lit(int(min(1.0, sample_docs / n) * (1 << 32))))]), F.col(lang))
    picked = rows.where(F.pmod(F.xxhash64(F.col(doc).cast("string")), F.lit(1 << 32)) < share).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            by_lang: dict[str, list[np.ndarray]] = {}
            for name, t in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                s = symbols(t)
                if s.any():
                    by_lang.setdefault(name, []).append(grams(s))
            for name, found in by_lang.items():
                keys, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(keys)), pa.array(keys.view(np.int64)),
                                                  pa.array(n.astype(np.int64))], names=["lang", "gram", "n"])

    counted = materialize(picked.mapInArrow(count, "lang string, gram bigint, n bigint")
                          .groupBy("lang", "gram").agg(F.sum("n").alias("n")), "lang-grams")
    counts = {}
    for name in sizes:
        own = counted.where(F.col("lang") == name).toArrow()
        if own.num_rows:
            counts[name] = (own.column("gram").to_numpy().view(np.uint64), own.column("n").to_numpy().astype(float))
    models = Models(counts)
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        place = {x: i for i, x in enumerate(own.langs)}
        for b in batches:
            out = [(name, float(own.entropies(s)[place[name]])) for name, t in
                   zip(b.column("lang").to_pylist(), b.column("text").to_pylist())
                   if name in place and (s := symbols(t)).any()]
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.string()),
                                              pa.array([x for _, x in out], pa.float64())], names=["lang", "bits"])

    usual = (picked.mapInArrow(bits, "lang string, bits double").groupBy("lang")
             .agg(F.percentile_approx("bits", 0.999).alias("q")).collect())
    for r in usual:
        models.limits[models.langs.index(r["lang"])] = r["q"] + MARGIN
    return models


def identify(docs: DataFrame, models: Models, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (0 to 1), ``bits`` per character and ``rejected`` added.

    Null texts and texts without a letter are ``und`` with score 0 and are
    rejected.  Columns of those four names are replaced; all others pass
    unchanged; every row is judged alone, so repeated rows are judged alike
    and nothing is shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(models)
    new = ["lang_pred", "score", "bits", "rejected"]
    kept = docs.select(*[c for c in docs.columns if c not in new])
    at = kept.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for b in batches:
            found = [own.judge(t) for t in b.column(at).to_pylist()]
            kinds = [pa.string(), pa.float64(), pa.float64(), pa.bool_()]
            columns = [pa.array([f[i] for f in found], k) for i, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*b.columns, *columns], names=[*b.schema.names, *new])

    kinds = (StringType(), DoubleType(), DoubleType(), BooleanType())
    schema = StructType([*kept.schema.fields, *(StructField(n, k) for n, k in zip(new, kinds))])
    return kept.mapInArrow(run, schema)


def identify_by_fold(docs: DataFrame, doc: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """doc, held_out, lang_pred, score, bits, rejected; trained on rows whose crc32 fold is not 0 (null ids train)."""
    held_out = F.coalesce(crc_fold(F.col(doc)) == 0, F.lit(False))
    models = train(docs.where(~held_out), text, lang, doc)
    slim = docs.select(F.col(doc).alias("doc"), F.col(text).alias("text"), held_out.alias("held_out"))
    return identify(slim, models).drop("text").withColumnRenamed("doc", doc)
