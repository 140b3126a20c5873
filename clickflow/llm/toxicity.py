"""Toxicity by a weighted lexicon.

Texts are folded: lower case, look-alike letters of other scripts to Latin,
digits and symbols that stand for letters inside a word to those letters,
everything else to blanks.  An Aho-Corasick automaton finds the lexicon's
entries in one scan: whole words and stems (what words begin with), each with
a weight, and exception phrases, inside which entries do not count.  The
weights found are summed and set against the text's length; a logistic
function of the sum and the density gives the score.

The lexicon is learned from labelled texts: entries whose document frequency
is far higher among toxic ones.  Exceptions are learned likewise: an entry
with its neighbour that occurs in clean texts only.  At most ``SAMPLE_DOCS`` labelled documents are used,
picked by a hash of the id.  Scoring covers every text whole.
"""
from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from clickflow.llm.common import crc_fold, materialize

SAMPLE_DOCS = 30_000
MIN_DOCS = 8          # toxic texts that must hold an entry
MIN_PRECISION = 0.8   # share of toxic texts among those that hold it
MIN_CLEAN = 3         # clean texts that must hold an exception phrase
MAX_ENTRIES = 20_000
STEMS = range(4, 9)   # lengths of stems
FEATURE_ROWS = 200_000  # candidate entries the driver weighs, the most frequent first

# Letters of other scripts that look like Latin ones, and digits used for letters (lower case).
LOOK_ALIKE = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d",
    "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "ո": "n", "ս": "u",
    "α": "a", "ε": "e", "ο": "o", "ρ": "p", "ν": "v", "υ": "u", "ι": "i", "κ": "k", "τ": "t", "χ": "x",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b",
}
SYMBOLS = re.compile(r"(?<=[^\W\d_])[@$!|](?=[^\W\d_])")
SYMBOL_LETTERS = {"@": "a", "$": "s", "!": "i", "|": "l"}


class _Fold(dict):
    """Translation table that fills itself: folded letter, or a blank."""

    def __missing__(self, point: int) -> str:
        c = chr(point)
        low = LOOK_ALIKE.get(c.lower(), c.lower())
        if 0xFF01 <= point <= 0xFF5E:  # full-width forms
            low = chr(point - 0xFEE0).lower()
        self[point] = got = low if low.isalpha() else " "
        return got


_FOLD = _Fold()


def fold(text: str) -> str:
    """Folded text with blanks around it; words are parted by blanks."""
    if "$" in text or "@" in text or "!" in text or "|" in text:
        text = SYMBOLS.sub(lambda m: SYMBOL_LETTERS[m.group()], text)
    return f" {text.translate(_FOLD)} "


@dataclass
class Lexicon:
    """``weights``: entry to weight; an entry is " word " or " stem".  ``exceptions``: phrases " word word "."""
    weights: dict[str, float] = field(default_factory=dict)
    exceptions: set[str] = field(default_factory=set)
    logistic: tuple[float, float, float] = (-3.0, 2.0, 1.0)

    def automaton(self) -> ahocorasick.Automaton | None:
        a = ahocorasick.Automaton()
        for e, w in self.weights.items():
            a.add_word(e, (len(e), w))
        for e in self.exceptions:
            a.add_word(e, (len(e), None))
        if not len(a):
            return None
        a.make_automaton()
        return a


def weigh(folded: str, automaton) -> float:
    """Sum of the weights of the entries that start where no exception phrase covers them, the best of each place."""
    if automaton is None:
        return 0.0
    best: dict[int, float] = {}
    covered: list[tuple[int, int]] = []
    for end, (size, weight) in automaton.iter(folded):
        start = end - size + 1
        if weight is None:
            covered.append((start, end))
        else:
            best[start] = max(best.get(start, weight), weight)
    if covered:
        best = {s: w for s, w in best.items() if not any(a <= s < b for a, b in covered)}
    return sum(best.values())


def signals(weight: float, length: int) -> tuple[float, float]:
    """What the logistic function sees: the sum, and the sum per thousand characters."""
    return float(np.log1p(weight)), float(np.log1p(1000.0 * weight / max(length, 1)))


def score(folded: str, automaton, logistic: tuple[float, float, float]) -> float:
    x, y = signals(weigh(folded, automaton), len(folded))
    a, b, c = logistic
    return float(1 / (1 + np.exp(-np.clip(a + b * x + c * y, -30, 30))))


def _features(folded: str) -> set[str]:
    out = set()
    for w in set(folded.split()):
        if len(w) >= 3:
            out.add(f" {w} ")
            out.update(f" {w[:n]}" for n in STEMS if n < len(w))
    return out


def _choose(counts: dict[str, tuple[int, int]], toxic: int, clean: int) -> dict[str, float]:
    """Entries by rising length; one that a chosen stem covers already is left out.  Weight: log odds ratio."""
    chosen: dict[str, float] = {}
    stems: set[str] = set()
    for e, (t, c) in sorted(counts.items(), key=lambda kv: (len(kv[0].strip()), kv[0])):
        word = e.strip()
        if t < MIN_DOCS or t < MIN_PRECISION * (t + c) or any(f" {word[:n]}" in stems for n in STEMS):
            continue
        odds = np.log((t + 0.5) / (toxic - t + 0.5)) - np.log((c + 0.5) / (clean - c + 0.5))
        if odds <= 0:
            continue
        chosen[e] = float(odds)
        if not e.endswith(" "):
            stems.add(e)
        if len(chosen) >= MAX_ENTRIES:
            break
    return chosen


def _fit(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression with a weak ridge, by Newton's method."""
    X = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(X.shape[1])
    ridge = np.diag([1e-6, 1e-2, 1e-2])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(X @ w, -30, 30)))
        step = np.linalg.solve((X * (p * (1 - p))[:, None]).T @ X + ridge, X.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return tuple(float(v) for v in w)


def _count(rows: DataFrame, make) -> DataFrame:
    """(feature, toxic, n): documents by feature and label, counted in each task before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = (Counter(), Counter())
            for t, y in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist()):
                found[y].update(make(fold(t)))
            for y in (0, 1):
                if found[y]:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(found[y]), pa.string()), pa.array([y] * len(found[y]), pa.int32()),
                         pa.array(list(found[y].values()), pa.int64())], names=["feature", "toxic", "n"])
    return rows.mapInArrow(run, "feature string, toxic int, n bigint").groupBy("feature", "toxic").agg(
        F.sum("n").alias("n"))


def learn(docs: DataFrame, labels: DataFrame, doc: str = "doc_id", text: str = "text", label: str = "toxic",
          sample_docs: int = SAMPLE_DOCS) -> Lexicon:
    """A lexicon from labelled documents; equal texts count once."""
    known = (labels.where(F.col(label).isin(0, 1) & F.col(doc).isNotNull()).groupBy(F.col(doc).alias("id"))
             .agg(F.max(label).cast("int").alias("toxic"))
             .orderBy(F.xxhash64(F.col("id").cast("string"))).limit(sample_docs))  # the bounded sample
    rows = (docs.select(F.col(doc).alias("id"), F.col(text).alias("text")).where("text is not null")
            .join(F.broadcast(known), "id").select("text", "toxic").dropDuplicates(["text"]))
    rows = materialize(rows, "toxic-sample")
    sizes = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return Lexicon(logistic=(-3.0 if not toxic else 3.0, 0.0, 0.0))

    candidates = {r["feature"]: r["n"] for r in
                  _count(rows.where("toxic = 1"), _features).where(F.col("n") >= MIN_DOCS)
                  .orderBy(F.desc("n"), "feature").limit(FEATURE_ROWS).collect()}
    shared = docs.sparkSession.sparkContext.broadcast(set(candidates))
    in_clean = {r["feature"]: r["n"] for r in
                _count(rows.where("toxic = 0"), lambda f: _features(f) & shared.value).collect()}
    weights = _choose({e: (n, in_clean.get(e, 0)) for e, n in candidates.items()}, toxic, clean)

    # Phrases around an entry, in clean texts often and in toxic ones never.
    def phrases(folded: str) -> set[str]:
        words = folded.split()
        hit = [any(e in weights for e in (f" {w} ", *(f" {w[:n]}" for n in STEMS))) for w in words]
        return {f" {a} {b} " for a, b, x, y in zip(words, words[1:], hit, hit[1:]) if x or y}

    seen = _count(rows, phrases).groupBy("feature").agg(
        *[F.sum(F.when(F.col("toxic") == y, F.col("n")).otherwise(0)).alias(name) for y, name in ((0, "clean"), (1, "bad"))])
    # At most one phrase for each two words of the bounded sample, each in MIN_CLEAN texts.
    exceptions = {r["feature"] for r in seen.where((F.col("clean") >= MIN_CLEAN) & (F.col("bad") == 0)).select("feature").collect()}
    lexicon = Lexicon(weights, exceptions)
    shape = docs.sparkSession.sparkContext.broadcast(lexicon)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shape.value.automaton()
        for b in batches:
            folded = [fold(t) for t in b.column("text").to_pylist()]
            found = [signals(weigh(f, automaton), len(f)) for f in folded]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.float64()),
                                              pa.array([f[1] for f in found], pa.float64()),
                                              b.column("toxic")], names=["x", "y", "toxic"])

    points = rows.mapInArrow(measure, "x double, y double, toxic int").toArrow()  # three numbers a sampled text
    x = np.column_stack([points.column(0).to_numpy(), points.column(1).to_numpy()])
    lexicon.logistic = _fit(x, points.column(2).to_numpy().astype(float))
    return lexicon


def score_documents(docs: DataFrame, lexicon: Lexicon, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on) in place of ``text``.

    Null texts are scored as empty.  Columns named score or predicted are
    replaced; other columns pass unchanged.
    """
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    kept = docs.select(*[c for c in docs.columns if c not in ("score", "predicted")])
    at = kept.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        automaton = own.automaton()
        for b in batches:
            s = [score(fold(t or ""), automaton, own.logistic) for t in b.column(at).to_pylist()]
            rest = [(n, c) for i, (n, c) in enumerate(zip(b.schema.names, b.columns)) if i != at]
            yield pa.RecordBatch.from_arrays(
                [*(c for _, c in rest), pa.array(s, pa.float64()), pa.array([int(v >= 0.5) for v in s], pa.int32())],
                names=[*(n for n, _ in rest), "score", "predicted"])

    schema = StructType([*kept.drop(text).schema.fields, StructField("score", DoubleType()),
                         StructField("predicted", IntegerType())])
    return kept.mapInArrow(run, schema)


def score_by_fold(docs: DataFrame, labels: DataFrame, doc: str = "doc_id", text: str = "text",
                  label: str = "toxic") -> DataFrame:
    """doc, held_out, score, predicted; learned from labels whose document's crc32 fold is not 0."""
    lexicon = learn(docs, labels.where(crc_fold(F.col(doc)) != 0), doc, text, label)
    held_out = F.coalesce(crc_fold(F.col(doc)) == 0, F.lit(False))
    slim = docs.select(F.col(doc).alias("doc"), F.col(text).alias("text"), held_out.alias("held_out"))
    return score_documents(slim, lexicon).withColumnRenamed("doc", doc)
