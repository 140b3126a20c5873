"""Line deduplication with a suffix array over line ids, in DataFrame functions only.

The corpus is read as sequences of line ids, one per document.  Prefix
doubling ranks every position by its next 2^k lines: a round joins a
position's rank with that of the position 2^k lines on, counts the pairs, and
ranks the distinct pairs in order, range by range.  A rank is the number of
positions sorting before, that is where the position's group begins in the
suffix array; positions with one rank at level k are an interval of it whose
longest common prefix has at least 2^k lines.  Positions alone in their group
cannot repeat and take no part in later rounds; the first round drops most
of a corpus that way.

A run of lines is a repeat if it has ``min_words`` words or more and the same
lines occur at an earlier position (document order, then line order).  Its
lines are deleted there; the first occurrence stays.  Every line of a repeated
run lies in a shortest run of ``min_words`` words that is itself repeated: the
one that starts at the line, or the one that ends where the run ends.  So it
is enough to look at the shortest such run from each position and to each
position.  Two runs of n lines are equal if the ranks of their first and last
2^k lines are, 2^k <= n < 2^(k+1); a run of n lines needs level k only.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickflow.llm.common import materialize

MIN_WORDS = 50
ISLAND = ["doc", "text_hash", "island"]


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_sequences(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """One row per line that has words: doc, text_hash, ord (place among them), line_no, words, h1, h2.

    Lines are compared without spaces, tabs and carriage returns at their
    ends; (h1, h2) is a 128-bit id.
    """
    def line(x, i):
        s = F.btrim(x, F.lit(" \t\r"))
        return F.struct(i.alias("line_no"), F.regexp_count(s, F.lit(r"\S+")).alias("words"),
                        F.xxhash64(s).alias("h1"), F.xxhash64(F.lit(1), s).alias("h2"))
    found = F.filter(F.transform(_lines(F.col(text)), line), lambda x: x["words"] > 0)
    return (docs.select(F.col(doc).alias("doc"), F.xxhash64(F.col(text)).alias("text_hash"),
                        F.posexplode(found).alias("ord", "x"))
            .select("doc", "text_hash", "ord", "x.*"))


def _ranks(pairs: DataFrame, name: str) -> DataFrame:
    """(a, b, rank) for the pairs that occur more than once; ranks follow the order of (a, b).

    Distinct pairs with their counts are sorted by range and written once;
    a range's ranks start where the ranges before it end (one number a range).
    """
    counted = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    parts = materialize(counted.repartitionByRange("a", "b").withColumn("part", F.spark_partition_id()), name)
    sizes = {r["part"]: r["n"] for r in parts.groupBy("part").agg(F.sum("n").alias("n")).collect()}
    starts, total = [], 0
    for p in sorted(sizes):
        starts.append((p, total))
        total += sizes[p]
    spark = pairs.sparkSession
    offsets = spark.createDataFrame(starts, "part int, start bigint")
    before = Window.partitionBy("part").orderBy("a", "b").rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum("n").over(before), F.lit(0))
    return (parts.withColumn("within", within).join(F.broadcast(offsets), "part")
            .select("a", "b", (F.col("start") + F.col("within")).alias("rank")))


def _islands(known: DataFrame, min_words: int) -> DataFrame:
    """One row per island, a stretch of repeated lines without a gap, of ``min_words`` words or more.

    ``x`` lists its lines: line_no, rank, and the number of lines of the
    shortest run of ``min_words`` words from (``fwd``) and to (``bwd``) each,
    else null.  A line has a word at least, so ``min_words`` lines suffice.
    ``wanted`` is the longest of these runs.
    """
    whole = Window.partitionBy("doc", "text_hash").orderBy("ord")
    # Rows equal in id and text are one document.
    known = (known.withColumn("island", F.col("ord") - F.dense_rank().over(whole))
             .withColumn("again", F.lag("ord").over(whole).eqNullSafe(F.col("ord"))).where("not again"))
    order = Window.partitionBy(*ISLAND).orderBy("ord")
    known = known.withColumn("all", F.sum("words").over(Window.partitionBy(*ISLAND))).where(F.col("all") >= min_words)
    known = known.withColumn("upto", F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    known = known.withColumn("before", F.col("upto") - F.col("words"))
    known = known.withColumns({"ahead": F.collect_list("upto").over(order.rowsBetween(0, min_words - 1)),
                               "behind": F.collect_list("before").over(order.rowsBetween(1 - min_words, 0))})
    short_f = F.size(F.filter("ahead", lambda x: x < F.col("before") + min_words))
    short_b = F.size(F.filter("behind", lambda x: x > F.col("upto") - min_words))
    lines = known.select(*ISLAND, F.struct(
        "ord", "line_no", "rank", F.when(short_f < F.size("ahead"), short_f + 1).alias("fwd"),
        F.when(short_b < F.size("behind"), short_b + 1).alias("bwd")).alias("line"))
    return lines.groupBy(*ISLAND).agg(
        F.sort_array(F.collect_list("line")).alias("x"),  # lines of one document
        F.max(F.greatest("line.fwd", "line.bwd")).alias("wanted"))


def _next_level(ranked: DataFrame, level: int) -> DataFrame | None:
    """Islands with the ranks of 2^(level+1) lines from their ranks of 2^level, where runs that long are asked for."""
    step = 1 << level
    size = F.size("ranks")
    follow = F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.struct(
        F.get("ranks", i).alias("a"), F.get("ranks", i + step).alias("b")))
    pairs = (ranked.where((F.col("wanted") >= 2 * step) & (size > step))
             .select(*ISLAND, "wanted", F.posexplode(follow).alias("pos", "p")))
    alive = F.col("p.a").isNotNull() & F.col("p.b").isNotNull()
    ranks = _ranks(pairs.where(alive).select(F.col("p.a").alias("a"), F.col("p.b").alias("b")), f"ranks-{level + 1}")
    # Positions without a pair get keys that match nothing, spread out.
    lone = -1 - F.pmod(F.xxhash64(*ISLAND, "pos"), F.lit(1 << 20))
    pairs = pairs.select(*ISLAND, "wanted", "pos", F.when(alive, F.col("p.a")).otherwise(lone).alias("pa"),
                         F.when(alive, F.col("p.b")).otherwise(F.lit(-1)).alias("pb"))
    joined = pairs.join(ranks, (F.col("pa") == F.col("a")) & (F.col("pb") == F.col("b")), "left")
    rows = joined.groupBy(*ISLAND, "wanted").agg(F.sort_array(F.collect_list(F.struct("pos", "rank"))).alias("r"))
    return rows.select(*ISLAND, "wanted", F.transform("r", lambda x: x["rank"]).alias("ranks")).where(
        F.exists("ranks", lambda x: x.isNotNull()))


def repeated_lines(docs: DataFrame, doc: str = "doc_id", text: str = "text",
                   min_words: int = MIN_WORDS) -> DataFrame:
    """(doc, text_hash, line_no): the lines that belong to a later copy of a repeated run."""
    lines = materialize(line_sequences(docs, doc, text), "lines")
    # Level 0: ids of lines that occur more than once, ranked.
    ids = _ranks(lines.select(F.col("h1").alias("a"), F.col("h2").alias("b")), "ranks-0")
    known = (lines.join(ids, (F.col("h1") == F.col("a")) & (F.col("h2") == F.col("b")))
             .select("doc", "text_hash", "ord", "line_no", "words", "rank"))
    islands = materialize(_islands(known, min_words), "islands")
    longest = islands.agg(F.max("wanted")).first()[0] or 0

    ranked = islands.select(*ISLAND, "wanted", F.transform("x", lambda x: x["rank"]).alias("ranks"))
    levels = ranked.select(*ISLAND, F.lit(0).alias("level"), "ranks")
    level = 0
    while 2 << level <= longest:
        ranked = materialize(_next_level(ranked, level), f"level-{level + 1}")
        level += 1
        levels = levels.union(ranked.select(*ISLAND, F.lit(level).alias("level"), "ranks"))
    return _later_copies(islands, levels)


def _later_copies(islands: DataFrame, levels: DataFrame) -> DataFrame:
    """Lines of runs whose rank pair also names an earlier run."""
    # One row a level for each island, so this collects six short lists at most for 50 words.
    ladder = levels.groupBy(*ISLAND).agg(F.sort_array(F.collect_list(F.struct("level", "ranks"))).alias("r"))
    renamed = ladder.select(F.col("doc").alias("d"), F.col("text_hash").alias("t"), F.col("island").alias("i"), "r")
    one = islands.join(renamed, F.col("doc").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("t"))
                       & (F.col("island") == F.col("i"))).withColumn("n", F.size("x"))

    def run(start: Column, length: Column, kind: int) -> Column:
        # 2^k <= length < 2^(k+1)
        k = F.length(F.bin(length)) - 1
        last = start + length - F.call_function("shiftleft", F.lit(1), k.cast("int"))
        ranks = F.get("r", k)["ranks"]
        return F.struct(F.lit(kind).alias("kind"), start.alias("start"), length.alias("len"),
                        F.get(ranks, start).alias("a"), F.get(ranks, last).alias("b"))

    every = F.sequence(F.lit(0), F.col("n") - 1)
    ahead = F.transform(F.filter(every, lambda i: F.get("x", i)["fwd"].isNotNull()),
                        lambda i: run(i, F.get("x", i)["fwd"], 0))
    behind = F.transform(F.filter(every, lambda i: F.get("x", i)["bwd"].isNotNull()),
                         lambda i: run(i - F.get("x", i)["bwd"] + 1, F.get("x", i)["bwd"], 1))
    found = F.filter(F.concat(ahead, behind), lambda y: y["a"].isNotNull() & y["b"].isNotNull())
    runs = one.select(*ISLAND, F.explode(F.transform(found, lambda y: F.struct(
        y.alias("run"), F.transform(F.slice("x", y["start"] + 1, y["len"]), lambda z: z["line_no"]).alias("nos"),
        F.get("x", y["start"])["ord"].alias("ord")))).alias("y"))
    runs = materialize(runs.select("doc", "text_hash", "y.run.kind", "y.run.len", "y.run.a", "y.run.b",
                                   "y.ord", "y.nos"), "runs")
    same = ["kind", "len", "a", "b"]
    at = F.struct("doc", "text_hash", "ord")
    first = runs.groupBy(*same).agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    later = runs.join(first, same).where(~at.eqNullSafe(F.col("first")))
    return later.select("doc", "text_hash", F.explode("nos").alias("line_no")).distinct()


def dedup_lines(docs: DataFrame, doc: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS,
                keep_empty: bool = True) -> DataFrame:
    """``docs`` with the later copies of repeated runs of lines deleted from ``text``; adds ``deleted_lines``.

    Documents are ordered by id (null first), then by text hash.  Rows equal
    in id and text are one document: all of them keep the same lines.  Null
    texts stay null.  Lines without words are never counted nor deleted.  With
    ``keep_empty=False`` documents that lose all their words are left out;
    documents that had none stay.  Empty tables give no rows; all other
    columns are kept, a ``deleted_lines`` column would be replaced.
    """
    gone = (repeated_lines(docs, doc, text, min_words).groupBy("doc", "text_hash")
            .agg(F.collect_set("line_no").alias("__gone"))  # lines of one document
            .select(F.col("doc").alias("__doc"), F.col("text_hash").alias("__hash"), "__gone"))
    kept_columns = [c for c in docs.columns if c != "deleted_lines"]
    docs = docs.select(*kept_columns)
    same = docs[doc].eqNullSafe(gone["__doc"]) & (F.xxhash64(docs[text]) == gone["__hash"])
    joined = docs.join(gone, same, "left")
    lines = joined.withColumn("__lines", F.when(F.col("__gone").isNotNull(), _lines(F.col(text))))
    numbers = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__gone"))
    left = F.transform(numbers, lambda i: F.get("__lines", i))
    out = lines.withColumn("__text", F.when(F.col("__gone").isNull(), F.col(text)).otherwise(F.array_join(left, "\n")))
    if not keep_empty:
        out = out.where(F.col("__gone").isNull() | F.col("__text").rlike(r"\S"))
    deleted = F.coalesce(F.size("__gone"), F.lit(0))
    return out.select(*[F.col("__text").alias(c) if c == text else F.col(c) for c in kept_columns],
                      F.when(F.col("__gone").isNull(), 0).otherwise(deleted).alias("deleted_lines"))
