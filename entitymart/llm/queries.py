"""Registered queries of the corpus operators, with SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entitymart.llm import decontaminate, language, linededup, media_ts, ngramjoin, orcids, packing, quality, repair, simhash, urls, warc, whitening
from entitymart.llm.common import table

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op1_media_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_ts.media_features(table(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("spans")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.predict(docs, language.fit(docs))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules).drop("url")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.round_trip(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality.score(docs.select("doc_id", "text"), quality.fit(docs, table(spark, sf_dir, "labels")))
    predicted = (F.col("quality_score") >= quality.CUT).cast("int")
    return scored.select("doc_id", "held_out", F.col("quality_score").alias("score"), predicted.alias("predicted"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_orc_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orcids.round_trip(table(spark, sf_dir, "documents"))


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.reports(repair.damaged(table(spark, sf_dir, "conversations")))


def op12_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.join_similar(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.components(table(spark, sf_dir, "embeddings"))


def queries() -> dict:
    own = (
        op1_media_ts, op2_decontaminate, op3_language_id, op4_url_filter, op5_simhash, op6_warc, op7_packing, op8_quality, op9_line_dedup, op10_orc_ids,
        op11_repair, op12_ngram_join, op13_whitening,
    )
    return {f.__name__: f for f in own}


_OP2 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bs AS (SELECT item_id, w, least(len(w), 10) AS k, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM bs),
ks AS (SELECT DISTINCT k FROM bw),
dp AS (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks WHERE len(w) >= k),
dw AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS g FROM dp),
m AS (SELECT dw.doc_id, dw.i, dw.k, bw.item_id FROM dw JOIN bw ON dw.k = bw.k AND dw.g = bw.g),
p AS (SELECT DISTINCT doc_id, k, i FROM m),
h AS (SELECT doc_id, count(DISTINCT x) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS x FROM p) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS s FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(t.n, 0) AS BIGINT) AS n_items,
  sha256(coalesce(t.s, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM d LEFT JOIN h ON d.doc_id = h.doc_id LEFT JOIN t ON d.doc_id = t.doc_id
"""

_OP4 = r"""
WITH p AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
r(h, q, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
f AS (SELECT page_id, h || q AS rule, v, row_number() OVER (PARTITION BY page_id ORDER BY length(h || q) DESC) AS n
  FROM p, r WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q))
SELECT p.page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM p LEFT JOIN f ON p.page_id = f.page_id AND f.n = 1
"""

_OP6 = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
m AS (SELECT page_id, strlen(h) AS n, sha1(h) AS s, max(page_id) OVER (PARTITION BY sha1(h)) AS last FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((CAST('0x' || substr(s, CAST(5 * (i // 4) + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31 AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id < last THEN last END AS refers_to
FROM m
"""

_OP9 = r"""
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
s AS (SELECT doc_id, l, unnest(range(1, len(l) - 1)) AS i FROM d WHERE len(l) >= 3),
w AS (SELECT doc_id, i, row_number() OVER (PARTITION BY l[i], l[i + 1], l[i + 2] ORDER BY doc_id, i) AS n FROM s),
c AS (SELECT DISTINCT doc_id, unnest([i, i + 1, i + 2]) AS i FROM w WHERE n > 1),
x AS (SELECT doc_id, list(i) AS gone FROM c GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN x.doc_id IS NULL THEN d.text ELSE array_to_string(list_transform(list_filter(range(1, len(l) + 1), lambda i: NOT list_contains(gone, i)), lambda i: l[i]), chr(10)) END AS text,
  CAST(coalesce(len(l), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed
FROM d LEFT JOIN x ON d.doc_id = x.doc_id
"""


_OP11 = r"""
WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
f AS (SELECT *, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(name, ''), lambda c: CAST(ascii(c) AS BIGINT))),
  lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % 20 AS fate FROM k),
d AS (SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role, CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(CASE WHEN fate = 3 THEN [1, 2] ELSE [1] END) AS copy FROM f WHERE fate <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
  rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body, left(role, 1) AS r, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p FROM d),
g AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS seen FROM o),
v AS (SELECT *, CASE WHEN body = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM g),
m(st, c, nx) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
q(st, e, paid, nx, said) AS (
  SELECT st, '', 0, st, '' FROM (SELECT DISTINCT st FROM m) UNION ALL SELECT st, 'I', 5, nx, chr(10) || CASE c WHEN 'u' THEN 'user' ELSE 'assistant' END || ':' FROM m WHERE c <> 's'
  UNION ALL SELECT x.st, 'II', 10, y.nx, chr(10) || CASE x.c WHEN 'u' THEN 'user' ELSE 'assistant' END || ':' || chr(10) || CASE y.c WHEN 'u' THEN 'user' ELSE 'assistant' END || ':' FROM m x JOIN m y ON y.st = x.nx AND x.c <> 's'),
z AS (
  SELECT conv_id, i, st, 'K' AS e, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS paid, nx, chr(10) || role || ':' || text AS said FROM v JOIN m ON c = r WHERE fault NOT IN ('blank', 'duplicate')
  UNION ALL SELECT conv_id, i, st, 'R', CASE WHEN fault = 'truncated' THEN 6 ELSE 1 END, nx, chr(10) || CASE c WHEN 'u' THEN 'user' ELSE 'assistant' END || ':' || text FROM v JOIN m ON c <> 's' WHERE fault NOT IN ('blank', 'duplicate')
  UNION ALL SELECT conv_id, i, st, 'D', 2, st, '' FROM v, (SELECT DISTINCT st FROM m)),
w(conv_id, i, st, best) AS (
  SELECT conv_id, 0, q.nx, {'cost': paid, 'audit': e, 'said': said} FROM (SELECT DISTINCT conv_id FROM v), q WHERE q.st = 0
  UNION ALL SELECT w.conv_id, w.i + 1, q.nx, min({'cost': best.cost + z.paid + q.paid, 'audit': best.audit || z.e || q.e, 'said': best.said || z.said || q.said})
    FROM w JOIN z ON z.conv_id IS NOT DISTINCT FROM w.conv_id AND z.i = w.i + 1 AND z.st = w.st JOIN q ON q.st = z.nx GROUP BY w.conv_id, w.i, q.nx),
n AS (SELECT conv_id, max(i) AS n, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
  count(*) FILTER (i > 1 AND p || r NOT IN ('su', 'ua', 'au')) AS illegal, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps FROM v GROUP BY conv_id),
b AS (SELECT n.conv_id, min(best) AS best FROM n JOIN w ON w.conv_id IS NOT DISTINCT FROM n.conv_id AND w.i = n.n AND w.st IN (0, 3) GROUP BY n.conv_id)
SELECT a.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  CAST(coalesce(best.cost, 0) AS BIGINT) AS cost, coalesce(best.audit, '') AS audit, sha256(coalesce(best.said[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN b ON b.conv_id IS NOT DISTINCT FROM a.conv_id
"""

_OP12 = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT DISTINCT r, array_to_string(w[i:i + 2], ' ') AS s FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT r, count(*) AS n FROM g GROUP BY r),
p AS (SELECT a.r AS x, b.r AS y, count(*) AS common FROM g a JOIN g b ON a.s = b.s AND a.r < b.r GROUP BY a.r, b.r),
l AS (SELECT x, y FROM p JOIN n a ON a.r = x JOIN n b ON b.r = y WHERE 100 * common >= 90 * (a.n + b.n - common)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
c(r, z) AS (SELECT x, y FROM e UNION SELECT c.r, e.y FROM c JOIN e ON e.x = c.z),
m AS (SELECT c.r, min(o.doc_id) AS low FROM c JOIN d o ON o.r = c.z GROUP BY c.r)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m.low, d.doc_id)) AS component_id FROM d LEFT JOIN n ON n.r = d.r LEFT JOIN m ON m.r = d.r
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_decontaminate": _OP2, "op4_url_filter": _OP4, "op6_warc": _OP6, "op9_line_dedup": _OP9, "op11_repair": _OP11, "op12_ngram_join": _OP12}
