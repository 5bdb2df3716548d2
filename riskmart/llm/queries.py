"""The registered queries of the training-data operators, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.llm import (collocations, fingerprints, hard_negatives, langid, minhash, mixing, packing, quality,
                          secret_scan, sharding, suffix, vptree, warc)
from riskmart.llm.common import table


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_per_document(mixing.mix(table(spark, sf_dir, "documents"))).select(
        "doc_id", "size", "source_size", "target", "taken")


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = secret_scan.RULES
    found = secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"), rules)
    return found.select(
        "doc_id", *[secret_scan.count_of(i).alias(f"n_{r.kind}") for i, r in enumerate(secret_scan.BASE_RULES)],
        F.sha2(secret_scan.listed(len(secret_scan.BASE_RULES), rules), 256).alias("base_sha256"),
        secret_scan.listed(len(rules), rules).alias("spans"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality.judge(docs, table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "llr")


def op5_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id", "kept")


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vptree.neighbours(table(spark, sf_dir, "embeddings"))


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = suffix.remove_repeats(table(spark, sf_dir, "documents"))
    return removed.withColumn("n_kept", F.col("n_bytes") - F.col("n_removed"))


def op10_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = hard_negatives.relabelled(F.col("label"), F.col("vec_id"))
    return hard_negatives.hard_negatives(vectors.withColumn("label", label))


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_mix_sources": op1_mix_sources,
        "op2_secrets": op2_secrets,
        "op3_language": op3_language,
        "op4_quality": op4_quality,
        "op5_pack": op5_pack,
        "op6_warc": op6_warc,
        "op7_near_duplicates": op7_near_duplicates,
        "op8_neighbours": op8_neighbours,
        "op9_repeats": op9_repeats,
        "op10_shards": op10_shards,
        "op11_collocations": op11_collocations,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_fingerprints": op13_fingerprints,
    }


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, 'null') || ':17') AS place
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, 3 * sum(size)::BIGINT AS cap,
         [5, 2, 1][((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::INT] AS weight
  FROM d GROUP BY source),
l AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER e, 0))::DOUBLE
            / (sum(weight) OVER () - coalesce(sum(weight) OVER e, 0))::DOUBLE AS level
  FROM s
  WINDOW e AS (ORDER BY cap / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT source, source_size, least(weight * max(level) OVER (), cap::DOUBLE) AS target FROM l),
q AS (
  SELECT doc_id, size, place, source_size, target, floor(target + 0.5)::BIGINT AS quota,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY place
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (
  SELECT *, greatest(0, least(size, quota - epoch * source_size - start)) AS words,
         least(1.0::DOUBLE, (epoch * source_size + start + size) / target) AS line
  FROM q, (SELECT unnest([0, 1, 2]) AS epoch)),
m AS (
  SELECT *, least(words, greatest(0, (SELECT sum(source_size) FROM t)
                  - coalesce(sum(words) OVER (ORDER BY words = 0 AND size > 0, line, place, epoch
                                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS got
  FROM c)
SELECT doc_id, any_value(size) AS size, any_value(source_size) AS source_size, any_value(target) AS target,
       sum(got)::BIGINT AS taken
FROM m GROUP BY doc_id
"""

OP6_SQL = r"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT h, max(page_id) AS top FROM p GROUP BY h)
SELECT page_id, payload_bytes,
       translate(list_reduce(list_transform(range(0, 8), lambda i:
                   to_base(('0x' || substr(p.h, (5 * i + 1)::INT, 5))::BIGINT, 32, 4)), lambda a, b: a || b),
                 '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> top THEN top END AS refers_to
FROM p JOIN f USING (h)
"""


OP8_SQL = """
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
d AS (
  SELECT q.vec_id AS query_id, v.vec_id, sqrt(list_reduce(list_transform(
           range(1, len(q.e) + 1), lambda i: (v.e[i] - q.e[i]) * (v.e[i] - q.e[i])), lambda a, b: a + b)) AS score
  FROM v AS q JOIN v ON q.vec_id <> v.vec_id AND len(q.e) = len(v.e) WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id)::INT AS rank FROM d)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


OP11_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p),
g AS (
  SELECT lang, size, array_to_string(words[i:i + size - 1], ' ') AS phrase
  FROM (SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS i
        FROM w, (SELECT unnest([1, 2, 3]) AS size))),
c AS (SELECT lang, size, phrase, count(*) AS f FROM g GROUP BY ALL),
t AS (SELECT lang, sum(f)::BIGINT AS n FROM c WHERE size = 1 GROUP BY lang),
k AS (
  SELECT lang, size, phrase, f AS a, unnest(range(1, size)) AS k, string_split(phrase, ' ') AS words
  FROM c WHERE size > 1 AND f >= 10),
s AS (
  SELECT k.lang, k.size, k.phrase, a, l.f AS l, r.f AS r, k,
         (a::HUGEINT * a * 1000000 // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM k JOIN c AS l ON l.lang = k.lang AND l.phrase = array_to_string(words[1:k], ' ')
         JOIN c AS r ON r.lang = k.lang AND r.phrase = array_to_string(words[k + 1:], ' ')),
m AS (
  SELECT lang, size, phrase, a, arg_min(l, score * 10 + k) AS l, arg_min(r, score * 10 + k) AS r, min(score) AS score
  FROM s GROUP BY lang, size, phrase, a),
x AS (
  SELECT DISTINCT b.lang, b.phrase
  FROM (SELECT lang, a AS longer, unnest([array_to_string(words[1:2], ' '), array_to_string(words[2:3], ' ')]) AS part
        FROM k WHERE size = 3 AND k = 1) AS q
       JOIN m AS b ON b.size = 2 AND b.lang = q.lang AND b.phrase = part WHERE 100 * longer >= 50 * b.a),
o AS (
  SELECT m.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM m ANTI JOIN x USING (lang, phrase))
SELECT lang, rank, phrase, a, l, r, n, score FROM o JOIN t USING (lang) WHERE rank <= 2000
"""


OP12_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.rid AS anchor, q.vec_id AS anchor_id, v.rid, v.vec_id, q.label = v.label AS same,
         list_inner_product(q.e, v.e)::BIGINT AS score
  FROM v AS q JOIN v ON q.rid <> v.rid AND len(q.e) = len(v.e) WHERE q.vec_id % 50 = 0),
p AS (
  SELECT anchor, anchor_id, rid AS positive, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, rid) <= 5)
SELECT p.anchor_id, positive_id,
       row_number() OVER (PARTITION BY p.anchor, positive ORDER BY score DESC, vec_id, rid)::INT AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor = p.anchor AND NOT same
  AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_mix_sources": OP1_SQL, "op6_warc": OP6_SQL, "op8_neighbours": OP8_SQL, "op11_collocations": OP11_SQL,
            "op12_hard_negatives": OP12_SQL}
