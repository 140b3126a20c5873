"""The training-data operators as queries over the driver tables, with DuckDB SQL where SQL can say the same."""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.llm.ann import search
from clickflow.llm.bpe import encode_documents
from clickflow.llm.conversation_repair import repair_damaged
from clickflow.llm.decontaminate import contamination
from clickflow.llm.html_extract import extract_pages
from clickflow.llm.language_id import identify_by_fold
from clickflow.llm.license_scan import scan_licenses
from clickflow.llm.line_dedup import dedup_lines
from clickflow.llm.ngram_join import link_documents
from clickflow.llm.token_align import link_statistics
from clickflow.llm.toxicity import score_by_fold
from clickflow.llm.url_filter import HOST_RULES, PATTERN_RULES, filter_urls
from clickflow.llm.warc import archive_index
from clickflow.sources import read_table


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = archive_index(read_table(spark, sf_dir, "pages"))
    return index.select(F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                        "refers_to")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_documents(read_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op4_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(read_table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op5_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return search(vectors, vectors.where(F.col("vec_id") % 20 == 0))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(read_table(spark, sf_dir, "documents"),
                            public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_by_fold(read_table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(read_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", F.col("deleted_lines").cast("long").alias("deleted_lines"),
                       F.length("text").cast("long").alias("n_chars_kept"), F.sha2("text", 256).alias("text_sha256"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_by_fold(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(read_table(spark, sf_dir, "pages"))


def op11_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_statistics(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                           public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.PATTERN)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_damaged(read_table(spark, sf_dir, "conversations"))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read_table(spark, sf_dir, "documents")).drop("spans")


QUERIES = {
    "op1_warc": op1_warc,
    "op2_decontaminate": op2_decontaminate,
    "op3_ngram_join": op3_ngram_join,
    "op4_html_extract": op4_html_extract,
    "op5_ann": op5_ann,
    "op6_bpe": op6_bpe,
    "op7_language_id": op7_language_id,
    "op8_line_dedup": op8_line_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_url_filter": op10_url_filter,
    "op11_token_align": op11_token_align,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_license_scan": op13_license_scan,
}

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_RULES = ", ".join(f"('{r.name}', '{r.host}', '{r.path}', '{r.verdict}')" for r in HOST_RULES)
_PATTERNS = " OR ".join(f"regexp_matches(translate(url, {_AZ}), '{r.regex}')" for r in PATTERN_RULES)

_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

ORACLE_SQL = {
    "op1_warc": """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
d AS (
  SELECT page_id, payload_bytes, min(page_id) OVER (PARTITION BY h, payload_bytes) AS first,
         array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + ((('0x' || substr(h, (1 + 10 * (i // 8))::BIGINT, 10))::BIGINT >> (5 * (7 - i % 8))) & 31), 1)), '')
           AS payload_digest
  FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM d""",
    "op2_decontaminate": f"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '{_WORDS}') AS w FROM documents),
bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '{_WORDS}') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, list_slice(w, i, i + least(len(w), 10) - 1) AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM bw WHERE len(w) > 0)),
grams AS (
  SELECT doc_id, i, n, list_slice(w, i, i + n - 1) AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM dw, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hits AS (SELECT doc_id, i, g.n, item_id FROM grams g JOIN win USING (n, win)),
hit_words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY 1),
hit_items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
         string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items
  FROM hits GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)""",
    "op3_ngram_join": f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, list_slice(w, i, i + 3) AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
inter AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM inter JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 85 * (nx.n + ny.n - c)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON r.other = l.x)
SELECT doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(other) AS component_id
FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id""",
    "op8_line_dedup": r"""
WITH raw AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l, text FROM documents),
li AS (
  SELECT doc_id, i - 1 AS line_no, trim(l[i], chr(32) || chr(9) || chr(13)) AS s,
         len(regexp_extract_all(l[i], '\S+')) AS words
  FROM raw, unnest(range(1, len(l) + 1)) AS u(i)),
seq AS (
  SELECT *, row_number() OVER d AS o, sum(words) OVER d AS upto
  FROM li WHERE words > 0 WINDOW d AS (PARTITION BY doc_id ORDER BY line_no)),
ends AS (
  SELECT a.doc_id, a.o AS lo, min(b.o) AS hi FROM seq a JOIN seq b
    ON a.doc_id = b.doc_id AND b.o >= a.o AND b.o < a.o + 50 AND b.upto >= a.upto - a.words + 50 GROUP BY 1, 2
  UNION
  SELECT a.doc_id, max(b.o) AS lo, a.o AS hi FROM seq a JOIN seq b
    ON a.doc_id = b.doc_id AND b.o <= a.o AND b.o > a.o - 50 AND a.upto - b.upto + b.words >= 50 GROUP BY 1, a.o),
runs AS (
  SELECT e.doc_id, lo, hi, string_agg(s, chr(10) ORDER BY o) AS content, list(line_no ORDER BY o) AS nos
  FROM ends e JOIN seq s ON s.doc_id = e.doc_id AND o BETWEEN lo AND hi GROUP BY 1, 2, 3),
firsts AS (SELECT *, min(struct_pack(d := doc_id, lo := lo)) OVER (PARTITION BY content) AS f FROM runs),
gone AS (
  SELECT DISTINCT doc_id, unnest(nos) AS line_no FROM firsts WHERE f.d <> doc_id OR f.lo <> lo),
per AS (SELECT doc_id, list(line_no) AS g FROM gone GROUP BY 1),
new AS (
  SELECT doc_id, coalesce(len(g), 0) AS deleted_lines, CASE WHEN g IS NULL THEN text ELSE array_to_string(
    list_transform(list_filter(range(len(l)), lambda i: NOT list_contains(g, i)), lambda i: l[i + 1]), chr(10)) END AS t
  FROM raw LEFT JOIN per USING (doc_id))
SELECT doc_id, deleted_lines::BIGINT AS deleted_lines, length(t)::BIGINT AS n_chars_kept, sha256(t) AS text_sha256 FROM new""",
    "op10_url_filter": f"""
WITH cut AS (
  SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT page_id, url, translate(regexp_extract(rest, '^([^/?#]*)', 1), {_AZ}) AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut),
rules(name, rhost, rpath, rverdict) AS (VALUES {_RULES}),
best AS (
  SELECT page_id, host, path, max_by(struct_pack(n := name, v := rverdict), length(name)) AS hit
  FROM (SELECT DISTINCT page_id, host, path FROM parts) p JOIN rules
    ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY ALL)
SELECT p.page_id, p.host, p.path, b.hit.n AS rule,
       coalesce(b.hit.v, CASE WHEN {_PATTERNS} THEN 'block' ELSE 'allow' END) AS verdict
FROM parts p LEFT JOIN best b USING (page_id, host, path)""",
    "op12_conversation_repair": r"""
WITH RECURSIVE src AS (
  SELECT dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS c, conv_id, turn, coalesce(role, ' ') AS role,
         coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k
  FROM conversations),
dice AS (
  SELECT *, xor(list_reduce([4294967295] || list_transform(range(1, len(k) + 1), lambda i: ascii(k[i])::BIGINT),
    lambda crc, byte: list_reduce([xor(crc, byte)] || range(8),
      lambda r, bit: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END)), 4294967295) % 20 AS d
  FROM src),
damaged AS (
  SELECT c, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
         CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN d = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM dice WHERE d <> 0),
placed AS (
  SELECT c, turn, role, text, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body,
         row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS pos
  FROM damaged),
judged AS (
  SELECT *, body = '' AS blank, body <> '' AND row_number() OVER (PARTITION BY c, role, text ORDER BY pos) > 1 AS twice,
         left(role, 1) AS letter, lag(left(role, 1)) OVER (PARTITION BY c ORDER BY pos) AS before
  FROM placed),
faults AS (
  SELECT *, NOT blank AND NOT twice AND right(body, 1) NOT IN ('.', '!', '?') AS cut, blank OR twice AS gone FROM judged),
ins(p, q, cost, audit) AS (VALUES (0, 0, 0, ''), (0, 2, 2, 'I'), (0, 3, 4, 'II'), (1, 1, 0, ''), (1, 2, 2, 'I'), (1, 3, 4, 'II'),
  (2, 2, 0, ''), (2, 3, 2, 'I'), (2, 2, 4, 'II'), (3, 3, 0, ''), (3, 2, 2, 'I'), (3, 3, 4, 'II')),
kept(q, letter, t) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)),
ways AS (
  SELECT c, 0::BIGINT AS pos, 0 AS s, struct_pack(cost := 0, audit := '') AS w FROM (SELECT DISTINCT c FROM faults)
  UNION ALL
  SELECT c, pos, s, min(struct_pack(cost := cost, audit := audit)) FROM (
    SELECT y.c, f.pos, e.s, y.w.cost + i.cost + e.cost AS cost, y.w.audit || i.audit || e.audit AS audit
    FROM ways y JOIN ins i ON i.p = y.s JOIN faults f ON f.c = y.c AND f.pos = y.pos + 1,
      LATERAL (SELECT i.q AS s, 3 AS cost, 'D' AS audit
        UNION ALL SELECT CASE i.q WHEN 2 THEN 3 ELSE 2 END, 2 + f.cut::INT, 'R' WHERE NOT f.gone
        UNION ALL SELECT k.t, f.cut::INT, 'K' FROM kept k WHERE NOT f.gone AND k.q = i.q AND k.letter = f.letter) e)
  GROUP BY c, pos, s),
best AS (
  SELECT c, min(struct_pack(cost := y.w.cost + i.cost, audit := y.w.audit || i.audit)) AS w
  FROM ways y JOIN ins i ON i.p = y.s JOIN (SELECT c, max(pos) AS pos FROM faults GROUP BY c) l USING (c, pos)
  WHERE i.q IN (0, 3) GROUP BY c),
letters AS (SELECT c, w.audit AS audit, unnest(range(1, len(w.audit) + 1)) AS j FROM best),
edits AS (
  SELECT c, j, audit[j] AS e, sum((audit[j] <> 'I')::INT) OVER (PARTITION BY c ORDER BY j) AS pos FROM letters),
turns AS (
  SELECT e.c, e.e, f.role, f.letter, CASE WHEN e.e = 'I' THEN '' ELSE f.text END AS text,
         row_number() OVER (PARTITION BY e.c ORDER BY j) AS m
  FROM edits e LEFT JOIN faults f ON f.c = e.c AND f.pos = e.pos WHERE e.e <> 'D'),
system AS (SELECT c, (e = 'K' AND letter = 's')::INT AS s FROM turns WHERE m = 1),
shas AS (
  SELECT c, sha256(string_agg(CASE WHEN e = 'K' THEN role WHEN (m - s) % 2 = 1 THEN 'user' ELSE 'assistant' END
    || ':' || text, chr(10) ORDER BY m)) AS sha FROM turns JOIN system USING (c) GROUP BY c),
counts AS (
  SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (twice) AS duplicate, count(*) FILTER (cut) AS truncated,
         count(*) FILTER (pos > 1 AND before || letter NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY c)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(w.cost, 0)::BIGINT AS cost, coalesce(w.audit, '') AS audit,
       coalesce(sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT c, conv_id FROM src) LEFT JOIN counts USING (c) LEFT JOIN best USING (c) LEFT JOIN shas USING (c)""",
}
