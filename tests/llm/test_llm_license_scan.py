"""Licence scans against naive matching statistics and phrase search."""
from __future__ import annotations

import random
import re
import time

from pyspark.sql import functions as F

from clickflow.llm import license_scan as ls

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def words(text):
    return WORD.findall(text.translate(LOWER))


def naive_base(text):
    w, found = words(text), []
    for p in ls.PHRASES:
        q = words(p.text)
        found += [(i, p.label) for i in range(len(w)) if w[i:i + len(q)] == q]
    return sorted(found)


def naive_matches(text, scanner_words):
    """(start, end) of the runs of MIN_MATCH words or more of some template that do not go on."""
    w, runs = words(text), set()
    for t in scanner_words:
        held = {tuple(t[i:j]) for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
        runs |= {(i, j) for i in range(len(w)) for j in range(i + 1, min(len(w), i + len(t)) + 1) if tuple(w[i:j]) in held}
    longest = {}
    for i, j in runs:
        longest[j] = min(i, longest.get(j, i))
    return sorted((i, j) for j, i in longest.items()
                  if j - i >= ls.MIN_MATCH and longest.get(j + 1, j + 1) > i)


def _random_text(rng, sources):
    out = []
    for _ in range(rng.randint(1, 6)):
        t = words(rng.choice(sources))
        i = rng.randrange(len(t))
        out += t[i:i + rng.randint(1, 12)] + rng.choices(["foo", "license", "the", "mit", "of"], k=rng.randint(0, 3))
    return rng.choice([" ", ", ", "\n"]).join(w.upper() if rng.random() < .1 else w for w in out)


def test_matching_statistics_and_phrases():
    rng = random.Random(4)
    scanner = ls.Scanner()
    listed = [words(t.text) for t in [*ls.PHRASES, *ls.TEMPLATES]]
    for _ in range(60):
        text = _random_text(rng, [t.text for t in ls.TEMPLATES])
        ended = [(p - e[1], p) for p, _, _, e in scanner._statistics(text) if p >= 0 and e]
        assert ended == naive_matches(text, listed)
        got = scanner.scan(text)
        assert sorted(got.base) == naive_base(text) and got.n_words == len(words(text))


def test_every_place_of_every_state():
    rng = random.Random(2)
    sequences = [[bytes([97 + rng.randrange(3)]) for _ in range(rng.randint(1, 12))] for _ in range(8)]
    a = ls.SuffixAutomaton(sequences)
    for s in sequences:
        for i in range(len(s)):
            for j in range(i + 1, len(s) + 1):
                run = s[i:j]
                assert a.places(a.state_of(run)) == sorted(
                    (n, e) for n, t in enumerate(sequences) for e in range(len(run), len(t) + 1) if t[e - len(run):e] == run)


def _labels(text):
    scan = ls.Scanner().scan(text)
    return {s.label for s in scan.spans}, scan


def test_spans():
    notice = ls.TEMPLATES[3].text
    assert _labels("intro words " + notice + " and code")[0] == {"mit"}
    changed = notice.replace("free of charge", "at no cost whatsoever").replace("merge, publish, ", "")
    labels, scan = _labels("x " * 500 + changed)
    assert labels == {"mit"} and scan.spans[0].first_word == 500 and 0.6 <= scan.spans[0].coverage < 1
    assert _labels(" ".join(words(notice)[:40]))[0] == set()           # under the share
    assert _labels(" ".join(reversed(words(notice))))[0] == set()      # not in order
    assert _labels("licensed under cc by nc 4 0")[0] >= {"cc-by-nc"}
    assert _labels("The terms of the contract and the rights to use it, subject to the following.")[0] == set()
    apache = "Licensed under the Apache License, Version 2.0."
    _, scan = _labels("\n".join([apache] * 5))
    assert len([s for s in scan.spans if s.label == "apache"]) == 5
    assert [b for _, b in scan.base] == ["apache"] * 5


def test_long_texts_are_fast_and_cut_anywhere():
    scanner = ls.Scanner()
    text = "Released under the MIT License. antion " * 60_000
    began = time.time()
    got = scanner.scan(text)
    assert time.time() - began < 20
    assert (got.n_words, len(got.base), len(got.spans)) == (360_000, 60_000, 60_000)
    data = "Été über LICENSE mit-license a1 ñandú".encode()
    for block in range(1, 40):
        assert [w.decode() for ws in ls.words_of(data, block) for w in ws] == words(data.decode())


def test_rows(spark):
    docs = spark.createDataFrame(
        [(1, "See the MIT License; the mit license, GNU General Public License."), (2, None), (3, ""), (4, "...!"), (5, "plain words"),
         (None, "mit license"), (6, "Mit\nLICENSE mit license"), (6, "Mit\nLICENSE mit license"), (7, "licensed under CC BY-NC 4.0")],
        "doc_id long, text string").withColumns({c: F.lit(1) for c in ("doc", "labels", "n_words", "spans")})
    rows = {r.doc_id: r for r in ls.scan_licenses(docs).collect()}
    assert tuple(rows[1])[1:7] == (11, 3, 2, 8, "gpl,mit", "gpl,mit")
    for i in (2, 3, 4):
        assert tuple(rows[i])[1:] == (0, 0, None, None, "", "", 0.0, [])
    assert tuple(rows[5])[1:] == (2, 0, None, None, "", "", 0.0, [])
    assert (rows[None].n_base, rows[None].score) == (1, ls.BASE_SCORE)
    assert (rows[6].n_base, rows[6].first_word, rows[6].last_word) == (2, 0, 2)
    assert (rows[7].base_labels, rows[7].labels, rows[7].n_base, rows[7].score) == ("", "cc-by-nc", 0, 1.0)
    assert ls.scan_licenses(docs).count() == 9
    assert ls.scan_licenses(docs.where("false")).count() == 0


def test_base_columns_equal_sql(spark):
    """The base part of the query over a given table, against DuckDB."""
    import duckdb

    from clickflow.llm import queries
    path = "/root/testdata/sf0.001"
    got = {r.doc_id: (r.n_words, r.n_base, r.base_labels) for r in queries.op13_license_scan(spark, path).collect()}
    az = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
    sql = f"""
WITH w AS (SELECT doc_id, ' ' || array_to_string(regexp_extract_all(translate(coalesce(text, ''), {az}), '{WORD.pattern}'), '  ')
           || ' ' AS s, len(regexp_extract_all(translate(coalesce(text, ''), {az}), '{WORD.pattern}')) AS n
           FROM '{path}/documents.parquet'),
h AS (SELECT doc_id, n, len(regexp_extract_all(s, ' mit  license ')) AS m, len(regexp_extract_all(s, ' apache  license ')) AS a,
             len(regexp_extract_all(s, ' general  public  license ')) AS g FROM w)
SELECT doc_id, n, m + a + g, array_to_string(list_filter([CASE WHEN a > 0 THEN 'apache' END, CASE WHEN g > 0 THEN 'gpl' END,
       CASE WHEN m > 0 THEN 'mit' END], lambda x: x IS NOT NULL), ',') FROM h"""
    assert got == {i: (n, k, labels) for i, n, k, labels in duckdb.sql(sql).fetchall()}
