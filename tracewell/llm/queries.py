"""One query for each operator, over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.llm import (
    conversation_repair, decontaminate, embedding_dedup, lexical_search, license_scan, line_dedup, minhash, packing, pii,
    sharding, substring_dedup, toxicity, url_filter,
)
from tracewell.llm.catalog import ORACLES, QUERIES, query
from tracewell.llm.tables import table


def all_queries():
    return dict(QUERIES)


def all_oracles():
    return dict(ORACLES)


@query("op4_decontaminate", sql=r"""
WITH items AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL
), spots AS (
  SELECT item, w, unnest(range(greatest(len(w) - 9, 1))) AS pos FROM items WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item, array_to_string(w[pos + 1 : pos + 10], ' ') AS win, least(len(w), 10) AS size FROM spots
), docs AS (
  SELECT doc_id, row_number() OVER () AS rid,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), sizes AS (SELECT DISTINCT size FROM windows
), places AS (
  SELECT rid, size, w, unnest(range(len(w) - size + 1)) AS pos FROM docs, sizes WHERE len(w) >= size
), hits AS (
  SELECT p.rid, p.pos, p.size, x.item
  FROM places p JOIN windows x ON x.size = p.size AND x.win = array_to_string(p.w[p.pos + 1 : p.pos + p.size], ' ')
), marked AS (
  SELECT rid, count(DISTINCT k) AS n_hit FROM (SELECT rid, unnest(range(pos, pos + size)) AS k FROM hits) GROUP BY rid
), named AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN marked USING (rid) LEFT JOIN named USING (rid)
""")
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op1_minhash", sql=r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS w
  FROM documents
), spots AS (
  SELECT doc_id, w, unnest(range(greatest(len(w) - 4, 1))) AS pos FROM docs WHERE len(w) > 0
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[pos + 1 : pos + 5], ' ') AS s FROM spots
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 75 * (x.n + y.n - c)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM docs
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
), least AS (
  SELECT a, min(b) AS component_id FROM reach GROUP BY a
)
SELECT docs.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id,
       docs.doc_id = component_id AS kept
FROM docs JOIN least ON a = docs.doc_id LEFT JOIN sizes ON sizes.doc_id = docs.doc_id
""")
def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op9_licenses")
def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.report(table(spark, sf_dir, "documents"))


@query("op10_urls", sql=r"""
WITH raw AS (
  SELECT page_id, url,
         translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path,
         row_number() OVER () AS rid
  FROM pages
), rules(action, rhost, rpath) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
         ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), fitting AS (
  SELECT rid, action, rhost || rpath AS rule,
         row_number() OVER (PARTITION BY rid ORDER BY length(rhost || rpath) DESC) AS k
  FROM raw JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
), urls AS (
  SELECT raw.*, rule, action,
         '    ' || regexp_replace(translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[0-9]+', '0', 'g') || ' ' AS padded
  FROM raw LEFT JOIN fitting ON raw.rid = fitting.rid AND k = 1
), spots AS (
  SELECT rid, action, padded, unnest(range(1, length(padded) - 3)) AS pos FROM urls
), grams AS (
  SELECT rid, action, substr(padded, pos, 5) AS g FROM spots
), c5 AS (
  SELECT g, count(*) FILTER (action = 'allow') AS a, count(*) FILTER (action = 'block') AS b FROM grams GROUP BY g
), c1 AS (SELECT substr(g, 5, 1) AS g, sum(a) AS a, sum(b) AS b FROM c5 GROUP BY 1),
c2 AS (SELECT substr(g, 4, 2) AS g, sum(a) AS a, sum(b) AS b FROM c5 GROUP BY 1),
c3 AS (SELECT substr(g, 3, 3) AS g, sum(a) AS a, sum(b) AS b FROM c5 GROUP BY 1),
c4 AS (SELECT substr(g, 2, 4) AS g, sum(a) AS a, sum(b) AS b FROM c5 GROUP BY 1),
p1 AS (
  SELECT g, (a + 1.0e0 / 256) / (sum(a) OVER () + 1.0e0) AS a, (b + 1.0e0 / 256) / (sum(b) OVER () + 1.0e0) AS b FROM c1
), p2 AS (
  SELECT c.g, (c.a + p.a) / (sum(c.a) OVER (PARTITION BY c.g[1:1]) + 1.0e0) AS a,
         (c.b + p.b) / (sum(c.b) OVER (PARTITION BY c.g[1:1]) + 1.0e0) AS b FROM c2 c JOIN p1 p ON p.g = c.g[2:]
), p3 AS (
  SELECT c.g, (c.a + p.a) / (sum(c.a) OVER (PARTITION BY c.g[1:2]) + 1.0e0) AS a,
         (c.b + p.b) / (sum(c.b) OVER (PARTITION BY c.g[1:2]) + 1.0e0) AS b FROM c3 c JOIN p2 p ON p.g = c.g[2:]
), p4 AS (
  SELECT c.g, (c.a + p.a) / (sum(c.a) OVER (PARTITION BY c.g[1:3]) + 1.0e0) AS a,
         (c.b + p.b) / (sum(c.b) OVER (PARTITION BY c.g[1:3]) + 1.0e0) AS b FROM c4 c JOIN p3 p ON p.g = c.g[2:]
), p5 AS (
  SELECT c.g, (c.a + p.a) / (sum(c.a) OVER (PARTITION BY c.g[1:4]) + 1.0e0) AS a,
         (c.b + p.b) / (sum(c.b) OVER (PARTITION BY c.g[1:4]) + 1.0e0) AS b FROM c5 c JOIN p4 p ON p.g = c.g[2:]
), scores AS (
  SELECT rid, avg(ln(a) - ln(b)) AS score FROM grams JOIN p5 USING (g) GROUP BY rid
), classes AS (
  SELECT avg(score) FILTER (action = 'allow') AS ma, stddev_pop(score) FILTER (action = 'allow') AS sa,
         avg(score) FILTER (action = 'block') AS mb, stddev_pop(score) FILTER (action = 'block') AS sb
  FROM urls JOIN scores USING (rid)
)
SELECT page_id, host, path, rule,
       coalesce(action, CASE WHEN coalesce(score >= (ma * sb + mb * sa) / (sa + sb), true)
                             THEN 'allow' ELSE 'block' END) AS verdict
FROM urls JOIN scores USING (rid) CROSS JOIN classes
""")
def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.verdicts(table(spark, sf_dir, "pages")).drop("score")


@query("op7_pii")
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


@query("op8_embeddings", sql="""
WITH RECURSIVE vectors AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
), least AS (
  SELECT a, min(b) AS component_id FROM reach GROUP BY a
), counts AS (
  SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN least ON least.a = vec_id LEFT JOIN counts ON counts.a = vec_id
""")
def op8_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op3_packing")
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query("op5_lines")
def op5_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(table(spark, sf_dir, "documents"))


@query("op6_substrings", sql="""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, encode(coalesce(text, '')) AS b FROM documents
), starts AS (
  SELECT rid, doc_id, b, unnest(range(octet_length(b) - 49)) AS pos FROM docs
  WHERE doc_id IS NOT NULL AND octet_length(b) >= 50
), strings AS (
  SELECT rid, doc_id, pos, b[pos + 1 : pos + 50] AS s FROM starts
), firsts AS (
  SELECT s, min(doc_id) AS first_id FROM strings GROUP BY s
), hits AS (
  SELECT rid, pos FROM strings JOIN firsts USING (s) WHERE first_id < doc_id
), steps AS (
  SELECT rid, pos, CASE WHEN pos - lag(pos) OVER (PARTITION BY rid ORDER BY pos) <= 50 THEN 0 ELSE 1 END AS opens
  FROM hits
), islands AS (
  SELECT rid, pos, sum(opens) OVER (PARTITION BY rid ORDER BY pos) AS k FROM steps
), spans AS (
  SELECT rid, min(pos) AS s, max(pos) + 50 AS e FROM islands GROUP BY rid, k
), gaps AS (
  SELECT rid, coalesce(lag(e) OVER (PARTITION BY rid ORDER BY s), 0) AS s, s AS e FROM spans
  UNION ALL
  SELECT rid, max(e), 9223372036854775807 FROM spans GROUP BY rid
), kept AS (
  SELECT g.rid, string_agg(hex(d.b[g.s + 1 : least(g.e, octet_length(d.b))]), '' ORDER BY g.s) AS h
  FROM gaps g JOIN docs d USING (rid) GROUP BY g.rid
), cut AS (
  SELECT rid, sum(e - s) AS n_removed, count(*) AS n_spans FROM spans GROUP BY rid
)
SELECT doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(CASE WHEN kept.rid IS NULL THEN b ELSE unhex(h) END) AS kept_sha256
FROM docs LEFT JOIN cut USING (rid) LEFT JOIN kept ON kept.rid = docs.rid
""")
def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.report(table(spark, sf_dir, "documents"))


@query("op13_sharding", sql=r"""
WITH RECURSIVE bits(n, c, k) AS (
  SELECT CAST(n AS BIGINT), CAST(n AS BIGINT), 0 FROM range(256) t(n)
  UNION ALL
  SELECT n, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
), crc_table AS (
  SELECT list(c ORDER BY n) AS t FROM bits WHERE k = 8
), docs AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
         CAST(octet_length(encode(coalesce(text, ''))) + 8 AS BIGINT) AS size FROM documents
), sums AS (
  SELECT text, xor(4294967295, list_reduce(
           list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: CAST('0x' || h AS BIGINT))),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS text_crc32
  FROM (SELECT DISTINCT text FROM docs), crc_table
), groups AS (
  SELECT text, CAST(sum(size) AS BIGINT) AS group_size FROM docs GROUP BY text
), queue AS (
  SELECT text, group_size, row_number() OVER (ORDER BY group_size DESC, md5(text)) AS k,
         row_number() OVER (PARTITION BY group_size ORDER BY md5(text)) AS j FROM groups
), dealt(k, pick, group_size, loads) AS (
  SELECT CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), list_transform(range(24), lambda x: CAST(0 AS BIGINT))
  UNION ALL
  SELECT k, pick, group_size, list_transform(range(24), lambda x: CAST(loads[x + 1] + CASE WHEN x + 1 = pick THEN group_size ELSE 0 END AS BIGINT))
  FROM (SELECT queue.k, CAST(list_position(loads, list_min(loads)) AS BIGINT) AS pick, queue.group_size, loads
        FROM dealt JOIN queue ON queue.k = dealt.k + 1)
), shards AS (
  SELECT group_size, pick - 1 AS shard, row_number() OVER (PARTITION BY group_size ORDER BY pick) AS j FROM dealt WHERE k > 0
)
SELECT doc_id, size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'bytes' AS law, CAST(shard AS INTEGER) AS shard,
       CAST(row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS BIGINT) AS slot,
       CAST(NULL AS INTEGER) AS grown_shard
FROM docs JOIN sums USING (text) JOIN queue USING (text) JOIN shards ON shards.group_size = queue.group_size AND shards.j = queue.j
""")
def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@query("op12_search", sql=r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), sizes AS (
  SELECT CAST(count(*) FILTER (len(w) > 0) AS BIGINT) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM docs
), terms AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark WHERE item_id IS NOT NULL
), spots AS (
  SELECT rid, doc_id, CAST(len(w) AS BIGINT) AS n, unnest(w) AS term FROM docs
), postings AS (
  SELECT rid, doc_id, n, term, CAST(count(*) AS BIGINT) AS tf FROM spots WHERE term IN (SELECT term FROM terms) GROUP BY ALL
), weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM postings, sizes GROUP BY term, n_docs
), scores AS (
  SELECT item_id, rid, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM terms JOIN postings USING (term) JOIN weights USING (term), sizes GROUP BY item_id, rid, doc_id
), ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
  FROM scores WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 10
""")
def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = lexical_search.build_index(table(spark, sf_dir, "documents"))
    return lexical_search.search(index, table(spark, sf_dir, "benchmark"))


@query("op11_conversations", sql=r"""
WITH RECURSIVE bits(n, c, k) AS (
  SELECT CAST(n AS BIGINT), CAST(n AS BIGINT), 0 FROM range(256) t(n)
  UNION ALL
  SELECT n, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
), crc_table AS (
  SELECT list(c ORDER BY n) AS t FROM bits WHERE k = 8
), raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(4294967295, list_reduce(
           list_prepend(4294967295, list_transform(string_split(
             coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ascii(x) AS BIGINT))),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 20 AS fault,
         dense_rank() OVER (ORDER BY conv_id) AS cid
  FROM conversations, crc_table
), damaged AS (
  SELECT cid, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE WHEN fault = 3 THEN 2 ELSE 1 END)) AS copy
  FROM raw WHERE fault <> 0
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY cid ORDER BY turn NULLS FIRST, role, text) AS pos FROM damaged
), seen AS (
  SELECT *, row_number() OVER (PARTITION BY cid, role, text ORDER BY pos) > 1 AS again,
         lag(role[1:1]) OVER (PARTITION BY cid ORDER BY pos) || role[1:1] AS pair FROM numbered
), marked AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b' WHEN again THEN 'd'
                 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 't' ELSE '' END AS mark FROM seen
), inserts(st, nxt, cost, edit, line) AS (
  VALUES (0, 0, 0, '', NULL), (1, 1, 0, '', NULL), (2, 2, 0, '', NULL), (3, 3, 0, '', NULL),
         (0, 2, 5, 'I', 'user:'), (1, 2, 5, 'I', 'user:'), (2, 3, 5, 'I', 'assistant:'), (3, 2, 5, 'I', 'user:')
), moves(edit, initial, st, nxt, cost, role) AS (
  VALUES ('D', NULL, 0, 0, 2, NULL), ('D', NULL, 1, 1, 2, NULL), ('D', NULL, 2, 2, 2, NULL), ('D', NULL, 3, 3, 2, NULL),
         ('K', 's', 0, 1, 0, NULL), ('K', 'u', 0, 2, 0, NULL), ('K', 'u', 1, 2, 0, NULL), ('K', 'u', 3, 2, 0, NULL), ('K', 'a', 2, 3, 0, NULL),
         ('R', NULL, 0, 2, 1, 'user'), ('R', NULL, 1, 2, 1, 'user'), ('R', NULL, 3, 2, 1, 'user'), ('R', NULL, 2, 3, 1, 'assistant')
), best(cid, i, st, rank, lines) AS (
  SELECT cid, CAST(0 AS BIGINT), 0, '00000000', CAST([] AS VARCHAR[]) FROM (SELECT DISTINCT cid FROM marked)
  UNION ALL
  SELECT cid, i, st, min(rank), arg_min(lines, rank) FROM (
    SELECT b.cid, b.i + 1 AS i, v.nxt AS st,
           printf('%08d', CAST(b.rank[1:8] AS INTEGER) + x.cost + v.cost + CASE WHEN v.edit <> 'D' AND m.mark = 't' THEN 5 ELSE 0 END)
             || b.rank[9:] || x.edit || v.edit AS rank,
           list_concat(list_concat(b.lines, CASE WHEN x.line IS NULL THEN [] ELSE [x.line] END),
                       CASE WHEN v.edit = 'D' THEN [] ELSE [coalesce(v.role, m.role) || ':' || m.text] END) AS lines
    FROM best b JOIN marked m ON m.cid = b.cid AND m.pos = b.i + 1 JOIN inserts x ON x.st = b.st JOIN moves v ON v.st = x.nxt
    WHERE (v.edit = 'D' OR m.mark NOT IN ('b', 'd')) AND (v.initial IS NULL OR v.initial = m.role[1:1])
  ) GROUP BY cid, i, st
), sizes AS (
  SELECT cid, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (mark = 'b') AS blank,
         count(*) FILTER (mark = 'd') AS duplicate, count(*) FILTER (mark = 't') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(pos) AS n FROM marked GROUP BY cid
), ends AS (
  SELECT cid, min(rank) AS rank, arg_min(lines, rank) AS lines FROM (
    SELECT cid, CASE st WHEN 2 THEN printf('%08d', CAST(rank[1:8] AS INTEGER) + 5) || rank[9:] || 'I'
                        WHEN 1 THEN printf('%08d', CAST(rank[1:8] AS INTEGER) + 10) || rank[9:] || 'II' ELSE rank END AS rank,
           CASE st WHEN 2 THEN list_concat(lines, ['assistant:']) WHEN 1 THEN list_concat(lines, ['user:', 'assistant:']) ELSE lines END AS lines
    FROM best JOIN sizes USING (cid) WHERE i = n
  ) GROUP BY cid
)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(rank[1:8], '0') AS BIGINT) AS cost,
       coalesce(rank[9:], '') AS audit, sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, cid FROM raw) LEFT JOIN sizes USING (cid) LEFT JOIN ends USING (cid)
""")
def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return conversation_repair.report(conversation_repair.damaged(conversations), conversations)
