"""The registered queries of this subpackage and their DuckDB SQL.

Each opN_<name> applies operator N with its production parameters to its whole
table and derives the contract's columns from the operator's own result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import (chat, decontaminate, hard_negatives, jaccard_join, mixing, quality, rlz_dedup, structure_repair, suffix_dedup,
                          token_counts, topk, toxicity, warc)
from tidemark.llm.stage import read


def op1_block_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


#: Conversation -7 of the contract: texts that look like the template's own control strings.
PROBE = r"\### Assistant: </turn> ok"


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    return chat.read_back(chat.format_chats(rows.union(probe)))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(read(spark, sf_dir, "documents"))


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix_sources(read(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken", "source")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.digest(decontaminate.scan(docs, read(spark, sf_dir, "benchmark")))


def op6_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.fixity_audit(read(spark, sf_dir, "pages"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read(spark, sf_dir, "documents"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removed_bytes(read(spark, sf_dir, "documents"))


def op9_rlz_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    # how a document falls into factors depends on where blocks begin, so only the exact columns
    return rlz_dedup.removed_words(read(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op10_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return structure_repair.digest(structure_repair.repair(structure_repair.damage(rows), conversations=rows.select("conv_id")))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", label), F.col("vec_id") % 100 == 0)


def op13_toxicity_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


OP1_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""

OP2_SQL = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, len(text) + len(regexp_extract_all(text, '\\|</turn>')) AS base,
             list_sum(list_transform(regexp_extract_all(text, '##+'), lambda x: len(x) - 2)) AS hashes FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(len(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(4 + len(role) + 2 + base + coalesce(hashes, 0) + 9) AS BIGINT) AS formatted_chars,
       false AS rewrites_history
FROM e GROUP BY conv_id
"""

OP5_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
g AS (SELECT DISTINCT item, least(13, len(w)) AS k, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS phrase
      FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
p AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS phrase
      FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM g) WHERE len(w) >= k)),
h AS (SELECT doc_id, i, k, item FROM p JOIN g USING (k, phrase)),
n AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS x FROM h) GROUP BY doc_id),
s AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN s USING (doc_id)
"""

OP6_SQL = r"""
WITH r AS (SELECT page_id, url, 'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Date: 1970-01-01T00:00:00Z'
                  || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:'
                  || coalesce(CAST(page_id AS VARCHAR), '') || '>' || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10)
                  || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '')
                  || chr(13) || chr(10) || chr(13) || chr(10) AS a FROM pages),
p AS (SELECT page_id, a, row_number() OVER (ORDER BY page_id NULLS FIRST, url NULLS FIRST, sha256(a)) - 1 AS rank FROM r),
crc AS (SELECT range AS b, list_reduce(list_concat([CAST(range AS BIGINT)], range(8)), lambda c, y: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
        FROM range(256)),
t AS (SELECT list(v ORDER BY b) AS tab FROM crc),
k AS (SELECT p.*, CAST(floor(rank / 256) AS BIGINT) AS file, rank % 256 AS place, coalesce(CAST(page_id AS VARCHAR), '') AS id FROM p),
d AS (SELECT k.*, xor(list_reduce(list_concat([4294967295], list_transform(string_split(id, ''), lambda c: CAST(ascii(c) AS BIGINT))),
              lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1])), 4294967295) % 200 AS rule FROM k, t),
e AS (SELECT 'a' AS side, file, 2 * place AS place, page_id, a AS record FROM d
      UNION ALL SELECT 'b', file, 2 * place, page_id, CASE rule WHEN 0 THEN 'X' || substring(a, 2) WHEN 1 THEN left(a, len(a) - 1) ELSE a END FROM d WHERE rule <> 2
      UNION ALL SELECT 'b', file, 2 * place + 1, page_id, 'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: metadata' || chr(13) || chr(10) || 'Content-Length: 0'
                       || repeat(chr(13) || chr(10), 4) FROM d WHERE rule = 3),
l AS (SELECT side, file, page_id, strlen(record) AS length, sha256(record) AS hash, row_number() OVER w - 1 AS slot,
             coalesce(sum(strlen(record)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off
      FROM e WINDOW w AS (PARTITION BY side, file ORDER BY place)),
m AS (SELECT *, slot // 16 AS node, min(off) OVER (PARTITION BY side, file, slot // 16) AS start FROM l),
n AS (SELECT side, file, node, start, sum(length) AS length, count(*) AS n,
             sha256(string_agg((off - start) || ':' || length || ':' || hash, ',' ORDER BY slot)) AS hash FROM m GROUP BY ALL),
r2 AS (SELECT file, CAST(coalesce(sum(n) FILTER (side = 'a'), 0) AS BIGINT) AS n_records, CAST(coalesce(sum(length) FILTER (side = 'a'), 0) AS BIGINT) AS n_bytes,
              CAST(coalesce(sum(n) FILTER (side = 'b'), 0) AS BIGINT) AS n_records_b, CAST(coalesce(sum(length) FILTER (side = 'b'), 0) AS BIGINT) AS n_bytes_b,
              sha256(string_agg(start || ':' || length || ':' || hash, ',' ORDER BY node) FILTER (side = 'a')) AS root_a,
              sha256(string_agg(start || ':' || length || ':' || hash, ',' ORDER BY node) FILTER (side = 'b')) AS root_b FROM n GROUP BY file),
n2 AS (SELECT file, node, max(hash) FILTER (side = 'a') IS DISTINCT FROM max(hash) FILTER (side = 'b') AS bad
       FROM n SEMI JOIN (SELECT file FROM r2 WHERE root_a IS DISTINCT FROM root_b) USING (file) GROUP BY ALL),
l2 AS (SELECT file, slot, max(hash) FILTER (side = 'a') IS DISTINCT FROM max(hash) FILTER (side = 'b') AS bad
       FROM m SEMI JOIN (SELECT file, node FROM n2 WHERE bad) USING (file, node) GROUP BY ALL),
c AS (SELECT file, CAST(count(*) AS BIGINT) AS n FROM (SELECT file FROM r2 UNION ALL SELECT file FROM n2 UNION ALL SELECT file FROM l2) GROUP BY file),
x AS (SELECT *, row_number() OVER (PARTITION BY side, file, page_id ORDER BY slot) AS nth FROM m SEMI JOIN (SELECT file, slot FROM l2 WHERE bad) USING (file, slot)),
y AS (SELECT file, coalesce(max(off) FILTER (side = 'a'), max(off) FILTER (side = 'b')) AS off,
             CASE WHEN count(*) FILTER (side = 'b') = 0 THEN 'missing' WHEN count(*) FILTER (side = 'a') = 0 THEN 'added'
                  WHEN min(hash) = max(hash) THEN 'moved' ELSE 'changed' END AS kind FROM x GROUP BY file, page_id, nth),
z AS (SELECT file, count(*) FILTER (kind <> 'moved') AS n_damaged, count(*) FILTER (kind = 'moved') AS n_moved,
             string_agg(CAST(off AS VARCHAR) || ':' || kind, ',' ORDER BY off, kind) FILTER (kind <> 'moved') AS damaged FROM y GROUP BY file)
SELECT r2.*, c.n AS n_compared, coalesce(n_damaged, 0) AS n_damaged, coalesce(n_moved, 0) AS n_moved, coalesce(damaged, '') AS damaged
FROM r2 JOIN c USING (file) LEFT JOIN z USING (file)
"""


OP3_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM c JOIN n p ON x = p.doc_id JOIN n q ON y = q.doc_id WHERE 100 * i >= 85 * (p.n + q.n - i)),
r AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
k AS (SELECT x, min(y) AS component_id FROM r GROUP BY x),
m AS (SELECT x, count(*) AS n_links FROM l GROUP BY x)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, coalesce(n_links, 0) AS n_links
FROM d JOIN k ON k.x = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN m ON m.x = d.doc_id
"""

OP8_SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS p FROM d WHERE len(h) >= 100)),
f AS (SELECT s, min(doc_id) AS first FROM w GROUP BY s),
r AS (SELECT doc_id, p, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 50 THEN 0 ELSE 1 END AS new FROM w JOIN f USING (s) WHERE first < doc_id),
g AS (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM r),
s AS (SELECT doc_id, run, min(p) AS lo, max(p) + 50 AS hi FROM g GROUP BY ALL),
k AS (SELECT doc_id, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS a, lo AS b FROM s
      UNION ALL SELECT doc_id, max(hi), 1000000000 FROM s GROUP BY doc_id),
t AS (SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS kept FROM k JOIN d USING (doc_id) GROUP BY doc_id),
u AS (SELECT doc_id, count(*) AS n_spans, CAST(sum(hi - lo) AS BIGINT) AS n_removed FROM s GROUP BY doc_id)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, h))) AS kept_sha256 FROM d LEFT JOIN t USING (doc_id) LEFT JOIN u USING (doc_id)
"""

OP9_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
v AS (SELECT doc_id, p, array_to_string(w[p:p + 34], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS p FROM d WHERE len(w) >= 35)),
f AS (SELECT s FROM v GROUP BY s HAVING count(*) > 1),
x AS (SELECT doc_id, list(DISTINCT q) AS gone FROM (SELECT doc_id, unnest(range(p, p + 35)) AS q FROM v SEMI JOIN f USING (s)) GROUP BY doc_id),
k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d)
      ANTI JOIN (SELECT doc_id, unnest(gone) AS i FROM x) USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN x USING (doc_id) LEFT JOIN k USING (doc_id)
"""


def _op11_sql() -> str:
    """Left to right over a conversation's rows: for each of the four states the least (cost, audit), as a
    cost of 12 digits with the audit behind it, so that least() compares both."""
    more = lambda cell, cost, letters: f"lpad(CAST(CAST(left({cell}, 12) AS BIGINT) + {cost} AS VARCHAR), 12, '0') || substr({cell}, 13) || {letters}"
    gone = [more(f"a{q}", 2, "'D'") for q in range(4)]

    def kept(p: int, letter: str) -> str:
        stays = more(f"a{p}", "CASE fault WHEN 3 THEN 5 ELSE 0 END", "'K'")
        if letter == "s":
            return f"CASE WHEN fault IN (0, 3) AND c = 's' THEN {stays} END"
        other = more(f"a{p}", "CASE fault WHEN 3 THEN 6 ELSE 1 END", "'R'")
        return f"CASE WHEN fault IN (0, 3) THEN CASE WHEN c = '{letter}' THEN {stays} ELSE {other} END END"

    return rf"""
WITH RECURSIVE raw AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text FROM conversations),
crc AS (SELECT range AS b, list_reduce(list_concat([CAST(range AS BIGINT)], range(8)), lambda c, y: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
        FROM range(256)),
tabled AS (SELECT list(v ORDER BY b) AS tab FROM crc),
ruled AS (SELECT raw.*, xor(list_reduce(list_concat([4294967295], list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
              lambda c: CAST(ascii(c) AS BIGINT))), lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1])), 4294967295) % 20 AS rule FROM raw, tabled),
d AS (SELECT conv_id, turn, CASE rule WHEN 4 THEN 'user' ELSE role END AS role,
             CASE rule WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE rule WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
      FROM ruled WHERE rule <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM d),
f AS MATERIALIZED (SELECT *, left(role, 1) AS c, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair,
             CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1 WHEN i > min(i) OVER (PARTITION BY conv_id, role, text) THEN 2
                  WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 3 ELSE 0 END AS fault FROM o),
p AS (SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, '000000000000' AS a0, CAST(NULL AS VARCHAR) AS a1, '000000000005I' AS a2, '000000000010II' AS a3 FROM raw
      UNION ALL
      SELECT conv_id, i, b0, b1, least(b2, {more("b0", 5, "'I'")}, {more("b1", 5, "'I'")}, {more("b3", 5, "'I'")}),
             least(b3, {more("b2", 5, "'I'")}, {more("b0", 10, "'II'")}, {more("b1", 10, "'II'")})
      FROM (SELECT p.conv_id, f.i, {gone[0]} AS b0, least({gone[1]}, {kept(0, "s")}) AS b1,
                   least({gone[2]}, {kept(0, "u")}, {kept(1, "u")}, {kept(3, "u")}) AS b2, least({gone[3]}, {kept(2, "a")}) AS b3
            FROM p JOIN f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.i = p.i + 1)),
v AS (SELECT conv_id, CAST(left(x, 12) AS BIGINT) AS cost, substr(x, 13) AS audit FROM (SELECT conv_id, arg_max(least(a0, a3), i) AS x FROM p GROUP BY conv_id)),
g AS (SELECT conv_id, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps, count(*) FILTER (fault = 1) AS blank,
             count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id),
e AS (SELECT conv_id, letter, j, sum(CAST(letter <> 'I' AS INT)) OVER w AS i, sum(CAST(letter <> 'D' AS INT)) OVER w AS place,
             sum(CAST(letter <> 'D' AS INT)) OVER (PARTITION BY conv_id) AS n
      FROM (SELECT conv_id, unnest(string_split(audit, '')) AS letter, unnest(range(len(audit))) AS j FROM v WHERE audit <> '') WINDOW w AS (PARTITION BY conv_id ORDER BY j)),
t AS (SELECT e.conv_id, string_agg(CASE letter WHEN 'K' THEN role || ':' || text ELSE CASE (place + n) % 2 WHEN 1 THEN 'user:' ELSE 'assistant:' END
             || CASE letter WHEN 'R' THEN text ELSE '' END END, chr(10) ORDER BY j) AS repaired
      FROM e JOIN f ON f.conv_id IS NOT DISTINCT FROM e.conv_id AND f.i = greatest(e.i, 1) WHERE letter <> 'D' GROUP BY e.conv_id)
SELECT v.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, cost, audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM v LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM v.conv_id LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM v.conv_id
"""


OP12_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score
      FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS r FROM s WHERE same) WHERE r <= 5),
n AS (SELECT anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score,
             row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
      FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {f.__name__: f for f in (op1_block_topk, op2_chat_format, op3_jaccard_join, op4_source_mix, op5_decontaminate, op6_warc_fixity,
                                     op7_token_counts, op8_suffix_dedup, op9_rlz_dedup, op10_quality_knn, op11_structure_repair, op12_hard_negatives,
                                     op13_toxicity_fm)}
    return found | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {"op1_block_topk": OP1_SQL, "op2_chat_format": OP2_SQL, "op3_jaccard_join": OP3_SQL, "op5_decontaminate": OP5_SQL,
            "op6_warc_fixity": OP6_SQL, "op8_suffix_dedup": OP8_SQL, "op9_rlz_dedup": OP9_SQL,
            "op11_structure_repair": _op11_sql(), "op12_hard_negatives": OP12_SQL}
