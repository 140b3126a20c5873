"""WARC: exact round trips, revisits, merge order."""
import base64
import hashlib
import random

from clickflow.llm import warc


def digest(b):
    return base64.b32encode(hashlib.sha1(b).digest()).decode()


def test_round_trip_with_edges(spark):
    rn = "\r\n"
    rows = [(1, "http://b.com/x", "same"), (2, "http://a.com/", "same"), (3, "http://a.com/", None), (4, None, ""),
            (5, "http://a.com/\r\nX: y", "a" + rn * 2 + "WARC/1.1" + rn * 2 + "b"), (6, "u", "tail" + rn),
            (7, "u", rn), (8, "u", rn * 3), (9, "u", "é" * 200000), (None, "u", "null id"), (None, "u", "same"),
            (10, "u", "twice"), (10, "u", "twice"), (11, "u", "\x00\r")]
    df = spark.createDataFrame([(*r, "z", "z", 1) for r in rows],
                               "page_id long, url string, html string, body string, id string, first int")
    got = warc.archive_index(df.repartition(3)).collect()
    want = []
    for i, _, h in rows:
        b = (h or "").encode()
        ids = [j for j, _, g in rows if (g or "").encode() == b and j is not None]
        first = min(ids) if ids and sum((g or "").encode() == b for _, _, g in rows) > 1 else i
        want.append((i, len(b), digest(b), "response" if i == first else "revisit", None if i == first else first))
    mine = [(r.record_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got]
    assert sorted(mine, key=repr) == sorted(want, key=repr)
    assert warc.archive_index(df.limit(0)).count() == 0


def test_payloads_come_back(spark, tmp_path):
    texts = ["", "a\r\n\r\nb", "\r\n", "x" * 100000, "\r\n\r\n\r\n"]
    df = spark.createDataFrame(list(enumerate(texts)), "page_id long, html string").selectExpr("*", "'u' as url")
    path = str(tmp_path / "w")
    warc.write_archives(warc.records(df, min_bytes=10**9), path)
    lines = (spark.read.option("lineSep", warc.RECORD_END).text(path)
             .selectExpr("_metadata.file_path as f", "cast(value as binary) v").collect())
    found = {h["WARC-Record-ID"]: p.decode() for h, p in warc.parse_records((r.f, bytes(r.v)) for r in lines)}
    assert found == {f"<urn:row:{i}>": t for i, t in enumerate(texts)}


def test_loser_tree_sorts():
    rng = random.Random(3)
    for _ in range(60):
        runs = [sorted([((rng.randint(0, 9),), (rng.random(),)) for _ in range(rng.randint(0, 8))], key=lambda x: x[0])
                for _ in range(rng.randint(0, 9))]
        keyed = {id(e): k for r in runs for k, e in r}
        out = [keyed[id(e)] for e in warc.LoserTree(runs)]
        assert out == sorted(k for r in runs for k, _ in r)


def test_merge_is_globally_ordered(spark):
    rng = random.Random(5)
    rows = [(f"k{rng.randint(0, 3)}" if rng.random() < 0.6 else "hot", f"2024-01-0{rng.randint(1, 9)}T00:00:00Z", str(i),
             "u", "response", "D", 1, None) for i in range(600)]
    entries = spark.createDataFrame(rows, warc.ENTRY).repartition(5)
    got = warc.merge_index(entries, range_rows=100, run_rows=37).orderBy("range_no", "position").collect()
    keys = [warc.sort_key(tuple(r)[2:]) for r in got]
    assert keys == sorted(keys) and len(keys) == 600
    sizes = {}
    for r in got:
        sizes[r.range_no] = sizes.get(r.range_no, 0) + 1
    assert len(sizes) == 6 and max(sizes.values()) < 200  # the hot key is spread


def test_url_keys_group_hosts():
    assert warc.url_key("https://www.Example.com:443/a?b#c") == "com,example,www)/a?b"
    assert warc.url_key("") == ")"
