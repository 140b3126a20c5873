"""Benchmark decontamination by winnowing, in DataFrame functions only.

Words are hashed, k-gram hashes are combined from them, and every window of
``W`` consecutive k-grams keeps its smallest hash.  Two texts that share
``K + W - 1`` words share a whole window of k-grams, hence its minimum, so no
shared span of that length can be missed.  Fingerprints found on both sides
are extended: the words around the k-gram, out to the whole window, must be
equal, and neighbouring windows merge into spans.

Benchmark windows are few next to the corpus.  A bitmap of their fingerprints
(at most ``BITMAP_BITS`` bits) is tested inside the document's own row, so
only windows that probably match leave it; the join that follows is exact.
Texts never move: what is shuffled is one small row per probable match.
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickflow.llm.common import ascii_lower, materialize

SPAN = 10        # words that make a hit
K = 5            # words in a k-gram
W = SPAN - K + 1  # k-grams in a winnowing window
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BITMAP_BITS = 22  # largest bitmap: 2**22 bits, 512 kB
BROADCAST_ROWS = 200_000  # benchmark windows of fixed width (about 120 bytes) that may be broadcast


def words(text: Column) -> Column:
    """Runs of 0-9, a-z (A-Z lower-cased) and non-ASCII characters; null has none."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def _gram(hashes: Column, at: Column, k: int) -> Column:
    return F.xxhash64(F.lit(k), *[F.get(hashes, at + j) for j in range(k)])


def _starts(n: Column, length: int) -> Column:
    """Start positions of all runs of ``length`` words."""
    return F.when(n >= length, F.sequence(F.lit(0), n - length)).otherwise(F.array().cast("array<int>"))


def _hashed(df: DataFrame, text: str, *keep: Column) -> DataFrame:
    """``keep`` and ``w`` (words), ``h`` (their hashes), ``g`` (k-gram hashes).

    Each level is its own projection and is used more than once by the next,
    so that Catalyst does not inline an array into a per-element lambda.
    """
    df = df.select(*keep, words(F.col(text)).alias("w"))
    kept = [c for c in df.columns if c != "w"]
    df = df.select(*kept, "w", F.size("w").alias("n"), F.transform("w", lambda x: F.xxhash64(x)).alias("h"))
    return df.select(*kept, "w", "n", "h",
                     F.transform(_starts(F.col("n"), K), lambda i: _gram(F.col("h"), i, K)).alias("g"))


def _minimum(at: Column) -> Column:
    """The winnowing fingerprint of the window of words that starts at ``at``."""
    return F.least(*[F.get(F.col("g"), at + j) for j in range(W)])


def _window(at: Column, length: int) -> Column:
    fp = _minimum(at) if length == SPAN else _gram(F.col("h"), at, length)
    return F.struct(at.alias("pos"), F.lit(length).alias("len"), fp.alias("fp"),
                    F.sha2(F.array_join(F.slice("w", at + 1, length), " "), 256).alias("sha"))


def benchmark_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct (item, fp, sha, len): every window of SPAN words; a shorter item is one window."""
    df = _hashed(benchmark, text, F.col(item).alias("item"))
    short = [F.when(F.col("n") == k, F.array(_window(F.lit(0), k))) for k in range(1, SPAN)]
    whole = F.transform(_starts(F.col("n"), SPAN), lambda i: _window(i, SPAN))
    return df.select("item", F.explode(F.coalesce(*short, whole)).alias("x")).select(
        "item", "x.fp", "x.sha", "x.len").distinct()


def _bitmap(windows: DataFrame, n: int) -> tuple[Column, int]:
    """The fingerprints as an array of 64-bit words (a literal of bounded size) and its word count."""
    bits = min(BITMAP_BITS, max(12, (64 * n - 1).bit_length()))
    size = 1 << (bits - 6)
    rows = (windows.groupBy(_slot(F.col("fp"), size).alias("slot"))
            .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), _bit(F.col("fp")))).alias("bits"))
            .collect())
    table = np.zeros(size, dtype=np.int64)
    for r in rows:
        table[r["slot"]] = r["bits"]
    return F.lit(table), size


def _slot(fp: Column, size: int) -> Column:
    return F.shiftrightunsigned(fp, 6).bitwiseAND(size - 1).cast("int")


def _bit(fp: Column) -> Column:
    return fp.bitwiseAND(63).cast("int")


def find_windows(docs: DataFrame, benchmark: DataFrame, doc: str = "doc_id", text: str = "text",
                 item: str = "item_id", item_text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(per document row: doc, text_hash, n_words; matches: doc, text_hash, pos, len, item).

    A match is one occurrence of a benchmark window; ``text_hash`` tells apart
    rows that repeat an id.  Null or wordless texts have no words and no
    matches; null item ids match but are not named.
    """
    bench = materialize(benchmark_windows(benchmark, item, item_text), "bench-windows")
    n, lengths = bench.agg(F.count(F.lit(1)), F.collect_set("len")).first()
    table, size = _bitmap(bench, n)

    def probable(length: int) -> Column:
        def test(i):
            fp = _minimum(i) if length == SPAN else _gram(F.col("h"), i, length)
            return F.getbit(F.get(table, _slot(fp, size)), _bit(fp)) == 1
        found = F.filter(_starts(F.col("n"), length), test)
        return F.transform(found, lambda i: _window(i, length))

    hashed = _hashed(docs, text, F.col(doc).alias("doc"), F.xxhash64(F.col(text)).alias("text_hash"))
    empty = F.array().cast("array<struct<pos:int,len:int,fp:bigint,sha:string>>")
    rows = materialize(hashed.select("doc", "text_hash", F.col("n").cast("long").alias("n_words"),
                                     F.concat(empty, *[probable(k) for k in sorted(lengths)]).alias("found")),
                       "doc-windows")
    windows = bench.select("fp", "sha", "item")
    hits = rows.select("doc", "text_hash", F.explode("found").alias("x")).select(
        "doc", "text_hash", "x.pos", "x.len", "x.fp", "x.sha")
    matches = hits.join(F.broadcast(windows) if n <= BROADCAST_ROWS else windows, ["fp", "sha"])
    return rows.select("doc", "text_hash", "n_words"), matches.select("doc", "text_hash", "pos", "len", "item")


def contamination(docs: DataFrame, benchmark: DataFrame, doc: str = "doc_id", text: str = "text",
                  item: str = "item_id", item_text: str = "text") -> DataFrame:
    """Per document row: doc, text_hash, n_words, n_hit, n_items, items (sorted strings), contaminated.

    A word is hit inside any occurrence of a benchmark window.  Equal rows get
    equal results, one each; rows that share an id but not the text are judged
    apart; null texts and an empty benchmark give zeros; empty documents give
    no rows; other columns are ignored.
    """
    rows, matches = find_windows(docs, benchmark, doc, text, item, item_text)
    # The matches of one document number at most its own words.
    spans = F.array_sort(F.collect_set(F.struct("pos", "len")))
    found = matches.groupBy("doc", "text_hash").agg(
        spans.alias("spans"), F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items"))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))

    def add(acc, x):
        end = x["pos"] + x["len"]
        fresh = F.greatest(F.lit(0), end - F.greatest(acc["end"], x["pos"]))
        return F.struct((acc["n"] + fresh).alias("n"), F.greatest(acc["end"], end).alias("end"))

    found = found.select(F.col("doc").alias("f_doc"), F.col("text_hash").alias("f_hash"), "items",
                         F.aggregate("spans", start, add, lambda acc: acc["n"]).alias("n_hit"))
    same = F.col("doc").eqNullSafe(F.col("f_doc")) & (F.col("text_hash") == F.col("f_hash"))
    items = F.coalesce("items", F.array().cast("array<string>"))
    hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return rows.join(found, same, "left").select(
        F.col("doc").alias(doc), "text_hash", "n_words", hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"), items.alias("items"), (hit > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without its contaminated rows, all columns kept."""
    bad = (contamination(docs, benchmark, doc, text).where("contaminated")
           .select(F.col(doc).alias("__bad_doc"), F.col("text_hash").alias("__bad_hash")).distinct())
    same = docs[doc].eqNullSafe(bad["__bad_doc"]) & (F.xxhash64(docs[text]) == bad["__bad_hash"])
    return docs.join(bad, same, "left_anti")
