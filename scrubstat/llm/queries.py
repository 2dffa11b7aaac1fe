"""The pipeline operators as registered queries: name -> (fn(spark, sf_dir), SQL or None)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..plans.registry import make_registry
from ..plans.tables import table
from ..session import scratch_path
from .jaccard import jaccard_classes, jaccard_links
from .langid import identify
from .mixing import mix_plan
from .negatives import hard_negatives
from .packing import pack_documents
from .pii import BASE_KINDS, find_pii
from .quality import score_quality
from .rules import quality_rules
from .secrets import BASE_RULES, find_secrets
from .sketch import fingerprint, fingerprint_documents
from .spans import kind_count, spans_text
from .topk import top_k_search
from .trie import prefix_trie
from .warc import archive_round_trip

Q, q = make_registry()


@q("op1_packing")
def op1_packing(spark, sf_dir):
    p = pack_documents(table(spark, sf_dir, "documents"))
    return p.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                    "sequence_id", "offset", "tier", "step_group")


def _base(kinds):
    names = [k for k, *_ in kinds]
    return F.filter("spans", lambda s: s["kind"].isin(names))


@q("op10_secret_scan")
def op10_secret_scan(spark, sf_dir):
    found = find_secrets(table(spark, sf_dir, "documents")).withColumn("base", _base(BASE_RULES))
    return found.select("doc_id", *[kind_count(F.col("base"), k).alias(f"n_{k}")
                                    for k in ("assign", "access", "hex")],
                        F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"),
                        spans_text(F.col("spans")).alias("spans"))


@q("op3_pii")
def op3_pii(spark, sf_dir):
    found = find_pii(table(spark, sf_dir, "documents")).withColumn("base", _base(BASE_KINDS))
    return found.select("doc_id", *[kind_count(F.col("base"), k).alias(f"n_{k}")
                                    for k in ("email", "ip", "card", "phone")],
                        F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"),
                        spans_text(F.col("spans")).alias("spans"))


OP8_SQL = r"""
WITH items AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    md5(concat(coalesce(doc_id::VARCHAR, 'null'), ':', coalesce(text, ''))) AS u
  FROM documents),
totals AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
  FROM items GROUP BY source),
levels AS (
  SELECT *, 3 * source_size AS cap, (3 * source_size) / w AS ratio,
    (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER lower, 0))::DOUBLE
      / (sum(w) OVER () - coalesce(sum(w) OVER lower, 0))::DOUBLE AS level,
    row_number() OVER (ORDER BY (3 * source_size) / w, source NULLS LAST) AS pos
  FROM totals
  WINDOW lower AS (ORDER BY (3 * source_size) / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size, least(cap::DOUBLE, w * (SELECT arg_min(level, pos) FROM levels WHERE level <= ratio)) AS target
  FROM levels),
placed AS (
  SELECT doc_id, size, source_size, target, round(target)::BIGINT AS lim,
    (sum(size) OVER (PARTITION BY i.source ORDER BY u, doc_id, size ROWS UNBOUNDED PRECEDING))::BIGINT - size AS before
  FROM items i JOIN targets t ON i.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  (greatest(0, least(size, lim - before)) + greatest(0, least(size, lim - source_size - before))
   + greatest(0, least(size, lim - 2 * source_size - before)))::BIGINT AS taken
FROM placed"""


@q("op8_mixing", OP8_SQL)
def op8_mixing(spark, sf_dir):
    return mix_plan(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def quality_learn():
    """Labels are learned only from rows whose crc32(doc_id as text) mod 3 is not 1."""
    return F.crc32(F.col("doc_id").cast("string")) % 3 != 1


@q("op9_quality")
def op9_quality(spark, sf_dir):
    out = score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), quality_learn())
    return out.select("doc_id", F.coalesce(~quality_learn(), F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


@q("op4_language")
def op4_language(spark, sf_dir):
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    out = identify(table(spark, sf_dir, "documents"), ~held_out)
    return out.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")


OP5_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE [array_to_string(ws[i:i + 3], ' ') FOR i IN range(1, len(ws) - 2)] END)) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(w.doc_id, min(reach.b)) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN reach ON reach.a = w.doc_id GROUP BY w.doc_id, n.n"""


@q("op5_jaccard_join", OP5_SQL)
def op5_jaccard_join(spark, sf_dir):
    return jaccard_classes(table(spark, sf_dir, "documents"), n=4, percent=85)


OP5_LINKS_SQL = OP5_SQL.replace("AS component_id", """AS component_id,
  (SELECT count(*) FROM links WHERE links.a = w.doc_id)::BIGINT AS n_links""", 1)


@q("op5_jaccard_links", OP5_LINKS_SQL)
def op5_jaccard_links(spark, sf_dir):
    return jaccard_links(table(spark, sf_dir, "documents"), n=4, percent=85).drop("class")


@q("op2_fingerprint")
def op2_fingerprint(spark, sf_dir):
    out = fingerprint_documents(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                      fingerprint(F.col("sketch")).alias("fingerprint"),
                      fingerprint(F.col("edited_sketch")).alias("edited_fingerprint"),
                      "near_edited", "near_next", "contained_edited", "contained_next")


OP6_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 20 = 0)
SELECT query_id, (row_number() OVER w)::INTEGER AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 20"""


@q("op6_topk", OP6_SQL)
def op6_topk(spark, sf_dir):
    return top_k_search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


OP7_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT h, min(page_id) AS first FROM p GROUP BY h)
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes,
  list_aggregate([list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      ((('0x' || substr(p.h, 5 * g + 1, 5))::INTEGER >> (15 - 5 * k)) & 31) + 1, 1)
    FOR k IN range(4)], 'string_agg', '') FOR g IN range(8)], 'string_agg', '') AS payload_digest,
  CASE WHEN page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM p JOIN f USING (h)"""


@q("op7_warc", OP7_SQL)
def op7_warc(spark, sf_dir):
    back = archive_round_trip(table(spark, sf_dir, "pages"), scratch_path(spark, f"warc-{uuid.uuid4().hex}"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP11_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
    list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 3"""


@q("op11_hard_negatives", OP11_SQL)
def op11_hard_negatives(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", label)
    return hard_negatives(rows, F.col("vec_id") % 50 == 0)


# The checksum of a decimal id is folded byte by byte through a table of 256 entries, itself computed.
OP12_SQL = """
WITH crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
    lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS tab),
t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST,
      substr(sha256(concat(length(role), ':', role, text)), 1, 32)) AS own,
    xor(list_reduce(list_concat([4294967295], list_transform(string_split(conv_id::VARCHAR, ''), lambda b: ascii(b)::BIGINT)),
      lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295) % 6 AS h
  FROM t, crc GROUP BY conv_id, tab),
r AS (
  SELECT a.conv_id, list_concat(coalesce(b.own, [])[1:a.h], a.own[a.h + 1:]) AS seq
  FROM c a LEFT JOIN c b ON b.conv_id = a.conv_id - a.conv_id % 100),
pre AS (SELECT conv_id, len(seq) AS n, seq, unnest(range(len(seq) + 1)) AS depth FROM r),
nodes AS (
  SELECT depth, seq[1:depth] AS key, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n = depth), '')) AS ends_sha256
  FROM pre GROUP BY ALL),
up AS (
  SELECT n.*, p.conv_id AS parent_conv_id FROM nodes n
  LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.key = n.key[1:n.depth - 1]),
kids AS (SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM up WHERE depth > 0 GROUP BY ALL),
own AS (
  SELECT up.*, coalesce(n_children, 0) AS n_children, (n_children IS NULL)::BIGINT AS leaf,
    CASE WHEN depth > 0 THEN (n_convs - 1) * length(key[-1].text) ELSE 0 END AS saved
  FROM up LEFT JOIN kids USING (conv_id, depth)),
below AS (SELECT key, leaf, saved, unnest(range(depth + 1)) AS top FROM own),
sums AS (SELECT top AS depth, key[1:top] AS key, sum(leaf)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM below GROUP BY ALL)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM own JOIN sums USING (depth, key)"""


@q("op12_prefix_trie", OP12_SQL)
def op12_prefix_trie(spark, sf_dir):
    c = F.col("conv_id")
    return prefix_trie(table(spark, sf_dir, "conversations"), F.crc32(c.cast("string")) % 6, c - c % 100)


@q("op13_quality_rules")
def op13_quality_rules(spark, sf_dir):
    out = quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "probability")
