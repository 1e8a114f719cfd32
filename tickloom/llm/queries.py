"""One query per operator over its whole table, and DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.llm import (
    bpe, embedding_dedup, hard_negatives, html_text, jaccard_join, licenses, merkle, mixing, packing, quality, sharding,
    topk_search, url_filter,
)

Query = Callable[[SparkSession, str], DataFrame]

#: Rules of the URL query, as (verdict, host, path).
URL_RULES = (
    ("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"),
)
SHARDS = tuple(f"shard-{i:03d}" for i in range(256))
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(table(spark, sf_dir, "documents"), ["doc_id"], SHARDS)


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(table(spark, sf_dir, "documents"), TOKENIZER)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in the order of their first place in the training order."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select(
        "doc_id", "size", "source_size", "target", "taken", F.get("times", F.lit(0)).alias("first_time"),
    ).orderBy(F.col("first_time").asc_nulls_last(), "doc_id")


def op5_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "verdict string, host string, path string")
    return url_filter.judge(table(spark, sf_dir, "pages"), rules)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"), licenses.known_texts(spark))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.classify(table(spark, sf_dir, "documents"), quality_labels(spark, sf_dir))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), TOKENIZER)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "tier",
        "step_id")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh label is wrong, as the contract has it."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", label)
    return hard_negatives.mine(vectors, F.col("id") % 100 == 0)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest's proofs, checked against rows some of which are tampered with."""
    names = ("doc_id", "source", "lang", "n_chars", "text")
    fields = [F.col(n) for n in names]
    tampered = [F.try_add("n_chars", F.lit(1).cast("bigint")) if n == "n_chars" else F.col(n) for n in names]
    is_tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    found = merkle.manifest(
        table(spark, sf_dir, "documents"), fields, group=F.col("lang"), order=[F.col("doc_id")],
        keep=[F.col("doc_id"), F.when(is_tampered, merkle.leaf_digest(*tampered)).alias("tampered")])
    shown = F.coalesce("tampered", "leaf")
    folded = merkle.fold(merkle.fold(shown, F.col("pos"), F.col("proof")), F.col("group_pos"), F.col("group_proof"))
    found = found.select(
        "doc_id", "leaf", "subroot", "root",
        F.sha2(F.array_join(F.concat("proof", "group_proof"), ""), 256).alias("proof_sha256"),
        folded.alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def build_queries() -> dict[str, Query]:
    return {
        "op1_sharding": op1_sharding,
        "op2_embedding_dedup": op2_embedding_dedup,
        "op3_bpe": op3_bpe,
        "op4_mixing": op4_mixing,
        "op5_topk_search": op5_topk_search,
        "op6_url_filter": op6_url_filter,
        "op7_license_scan": op7_license_scan,
        "op8_html_text": op8_html_text,
        "op9_quality_classifier": op9_quality_classifier,
        "op10_ngram_jaccard_join": op10_ngram_jaccard_join,
        "op11_packing": op11_packing,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_merkle_manifest": op13_merkle_manifest,
    }


MIXING_SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
queued AS (
  SELECT *, CAST('0x' || substr(md5(concat_ws(':', CAST(doc_id AS VARCHAR), CAST(size AS VARCHAR))), 1, 8)
    AS BIGINT) AS h
  FROM sized),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS place
  FROM sized GROUP BY source),
weighed AS (SELECT *, place + 1 AS weight, 1.5e0 - 0.5e0 * place AS ramp FROM sources),
ordered AS (
  SELECT *, row_number() OVER w AS number,
    (SELECT sum(source_size) FROM weighed) - coalesce(sum(3 * source_size) OVER b, 0) AS rest,
    (SELECT sum(weight) FROM weighed) - coalesce(sum(weight) OVER b, 0) AS weights
  FROM weighed
  WINDOW w AS (ORDER BY CAST(source_size AS DOUBLE) / weight, source),
    b AS (ORDER BY CAST(source_size AS DOUBLE) / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT number AS first_free, rest, weights FROM ordered
  WHERE 3 * source_size * weights >= rest * weight ORDER BY number LIMIT 1),
targets AS (
  SELECT source, source_size, ramp, CASE WHEN number < first_free THEN CAST(3 * source_size AS DOUBLE)
    ELSE CAST(level.rest * weight AS DOUBLE) / CAST(level.weights AS DOUBLE) END AS target
  FROM ordered, level),
placed AS (
  SELECT q.doc_id, q.size, t.source_size, t.target, t.ramp, CAST(floor(t.target + 0.5) AS BIGINT) AS goal,
    CAST(coalesce(sum(q.size) OVER (PARTITION BY q.source ORDER BY q.h, q.doc_id, q.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS place
  FROM queued q JOIN targets t ON q.source IS NOT DISTINCT FROM t.source),
cut AS (
  SELECT *, CASE WHEN source_size > 0 THEN goal // source_size ELSE 0 END AS whole FROM placed),
parts AS (
  SELECT *, least(greatest(goal - whole * source_size - place, 0), size) AS part,
    CAST(place AS DOUBLE) / CAST(goal AS DOUBLE) AS x FROM cut)
SELECT doc_id, size, source_size, target, CAST(whole * size + part AS BIGINT) AS taken,
  CASE WHEN size > 0 AND (whole > 0 OR part > 0)
    THEN 2 * x / (ramp + sqrt(ramp * ramp + 4 * (1 - ramp) * x)) END AS first_time
FROM parts
"""


TOPK_SQL = """
WITH scaled AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM scaled q JOIN scaled c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

URL_SQL = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
hosted AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS named FROM cut),
parted AS (
  SELECT page_id, translate(coalesce(named, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(substr(rest, length(named) + 1), '^[^?#]*'), '') AS path
  FROM hosted),
rules(verdict, host, path) AS (VALUES
  ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/'))
SELECT p.page_id, p.host, p.path, max_by(r.host || r.path, length(r.host || r.path)) AS rule,
  coalesce(max_by(r.verdict, length(r.host || r.path)), 'allow') AS verdict
FROM (SELECT *, row_number() OVER () AS number FROM parted) p
LEFT JOIN rules r ON (p.host = r.host OR p.host LIKE '%.' || r.host) AND starts_with(p.path, r.path)
GROUP BY p.number, p.page_id, p.host, p.path
"""


EMBEDDING_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))
    AND NOT list_bool_and(list_transform(embedding, lambda x: x = 0))),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a
  JOIN v b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.9),
reach AS (
  SELECT vec_id, vec_id AS r FROM embeddings UNION SELECT reach.vec_id, links.b FROM reach JOIN links ON reach.r = links.a),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(any_value(n), 0) AS n_links, min(r) AS component_id, vec_id = min(r) AS kept
FROM reach LEFT JOIN counts USING (vec_id) GROUP BY vec_id
"""

JACCARD_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM w),
tokens AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM tokens a JOIN tokens b ON a.t = b.t AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (
  SELECT doc_id, doc_id AS r FROM sets UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.r = links.a),
least AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id FROM sets JOIN least USING (doc_id)
"""


NEGATIVES_SQL = """
WITH scaled AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))),
pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM scaled a JOIN scaled b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, b) AS place FROM pairs WHERE same),
negatives AS (
  SELECT p.a AS anchor_id, p.b AS positive_id,
    CAST(row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.score DESC, n.b) AS INTEGER) AS rank,
    n.b AS negative_id, p.score AS positive_score, n.score AS negative_score
  FROM positives p JOIN pairs n ON p.a = n.a AND NOT n.same
    AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
  WHERE p.place <= 5)
SELECT * FROM negatives WHERE rank <= 10
"""

#: A CRC-32 bit by bit, since DuckDB has none.
MERKLE_SQL = """
WITH RECURSIVE rows_ AS (
  SELECT row_number() OVER () AS id, *, CAST(doc_id AS VARCHAR) AS digits FROM documents),
parts AS (
  SELECT id, doc_id, lang,
    coalesce(strlen(digits) || ':' || digits, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    n_chars, coalesce(strlen(text) || ':' || text, '-') AS tail,
    xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(digits) + 1), lambda i: ascii(digits[i]))),
      lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
        lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) AS crc
  FROM rows_),
leaves AS (
  SELECT id, doc_id, lang, crc,
    sha256(head || coalesce(length(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf,
    sha256(head || coalesce(length(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1), '-') || tail) AS tampered
  FROM parts),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
tree AS (
  SELECT lang, 0 AS level, list(leaf ORDER BY pos) AS l FROM ranked GROUP BY lang
  UNION ALL
  SELECT lang, level + 1, list_transform(range(0, (len(l) + 1) // 2), lambda i: sha256(array_to_string(l[2*i+1:2*i+2], '')))
  FROM tree WHERE len(l) > 1),
groups AS (
  SELECT lang, l[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos FROM tree WHERE len(l) = 1),
top AS (
  SELECT 0 AS level, list(subroot ORDER BY pos) AS l FROM groups
  UNION ALL
  SELECT level + 1, list_transform(range(0, (len(l) + 1) // 2), lambda i: sha256(array_to_string(l[2*i+1:2*i+2], '')))
  FROM top WHERE len(l) > 1),
steps AS (
  SELECT r.id, t.level, (r.pos >> t.level) & 1 AS is_right, coalesce(t.l[xor(r.pos >> t.level, 1) + 1], '') AS sibling
  FROM ranked r JOIN tree t ON r.lang IS NOT DISTINCT FROM t.lang WHERE len(t.l) > 1
  UNION ALL
  SELECT r.id, 1000 + t.level, (g.pos >> t.level) & 1, coalesce(t.l[xor(g.pos >> t.level, 1) + 1], '')
  FROM ranked r JOIN groups g ON r.lang IS NOT DISTINCT FROM g.lang, top t WHERE len(t.l) > 1),
numbered AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY level) AS k FROM steps),
folds AS (
  SELECT id, CAST(0 AS BIGINT) AS k, CASE WHEN crc % 7 = 0 THEN tampered ELSE leaf END AS node FROM ranked
  UNION ALL
  SELECT f.id, s.k, sha256(CASE WHEN s.is_right = 1 THEN s.sibling || f.node ELSE f.node || s.sibling END)
  FROM folds f JOIN numbered s ON s.id = f.id AND s.k = f.k + 1),
folded AS (SELECT id, arg_max(node, k) AS folded_root FROM folds GROUP BY id),
proofs AS (SELECT id, string_agg(sibling, '' ORDER BY k) AS proof FROM numbered GROUP BY id)
SELECT r.doc_id, r.leaf, g.subroot, (SELECT l[1] FROM top WHERE len(l) = 1) AS root,
  sha256(coalesce(p.proof, '')) AS proof_sha256, f.folded_root,
  f.folded_root = (SELECT l[1] FROM top WHERE len(l) = 1) AS verified
FROM ranked r JOIN groups g ON r.lang IS NOT DISTINCT FROM g.lang JOIN folded f USING (id) LEFT JOIN proofs p USING (id)
"""


def build_sql() -> dict[str, str]:
    return {
        "op2_embedding_dedup": EMBEDDING_SQL,
        "op4_mixing": MIXING_SQL,
        "op5_topk_search": TOPK_SQL,
        "op6_url_filter": URL_SQL,
        "op10_ngram_jaccard_join": JACCARD_SQL,
        "op12_hard_negatives": NEGATIVES_SQL,
        "op13_merkle_manifest": MERKLE_SQL,
    }
