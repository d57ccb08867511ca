"""One registered query per operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import bpe_decode, bpe_encode
from .common import read, stored, word_count
from .conversation_repair import conversation_digests, damaged
from .hard_negatives import hard_negatives
from .histogram_sort import shard_by_bytes
from .html_wrappers import extract_main_text
from .mixing import mix_sources
from .packing import pack_documents
from .pivot_topk import exact_top_k
from .registry import query
from .secrets import scan_secrets
from .simhash import fingerprint_text, near_duplicate_groups, with_fingerprint
from .substring_dedup import substring_dedup
from .syncmers import compare_with_next
from .toxicity import toxicity


@query("op1_substring_dedup")
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup(docs, keep_text=True).drop("deduped")


@query("op2_simhash")
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    groups = near_duplicate_groups(stored(with_fingerprint(docs, keep_text=False)))
    return groups.select("doc_id", fingerprint_text().alias("fingerprint"), "component_id")


@query("op3_histogram_sort")
def op3_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
    )
    return shard_by_bytes(rows, 40, "size", ["doc_id", "text_crc32"])


@query("op4_mixing", """
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
                  substr(md5('0:' || coalesce(doc_id::VARCHAR, '')), 1, 12) AS k FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1) % 3 + 1 AS weight, source_size * 3 AS cap FROM s),
l AS (SELECT *, row_number() OVER f AS pos,
             ((SELECT sum(source_size)::BIGINT FROM s) - coalesce(sum(cap) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)::DOUBLE
             / (sum(weight) OVER (f ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
      FROM w WINDOW f AS (ORDER BY cap::DOUBLE / weight, source NULLS LAST)),
t AS (SELECT source, source_size, least(cap::DOUBLE, weight * (SELECT level FROM l WHERE level * weight <= cap ORDER BY pos LIMIT 1)) AS target FROM l),
r AS (SELECT d.doc_id, d.size, t.source_size, t.target, floor(t.target)::BIGINT AS budget,
             (sum(d.size) OVER (PARTITION BY d.source ORDER BY k, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT - d.size AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (CASE WHEN source_size > 0 THEN (budget // source_size) * size + greatest(0, least(size, budget % source_size - before)) ELSE 0 END)::BIGINT AS taken
FROM r
""")
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", word_count("text").alias("size"))
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


@query("op5_pivot_topk", """
WITH e AS (SELECT vec_id, [floor(256 * x::DOUBLE) for x in embedding] AS v, row_number() OVER () AS uid FROM embeddings
           WHERE vec_id IS NOT NULL AND len(embedding) > 0
             AND len([x for x in embedding if x IS NULL OR isnan(x) OR isinf(x)]) = 0),
s AS (SELECT q.uid, q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
      FROM e q JOIN e c ON q.uid != c.uid AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
""")
def op5_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query("op6_secrets")
def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return scan_secrets(docs, keep_text=False).drop("redacted")


@query("op7_html_wrappers")
def op7_html_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(read(spark, sf_dir, "pages"))


@query("op8_syncmers")
def op8_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_next(read(spark, sf_dir, "documents"))


@query("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity(docs, read(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


@query("op10_packing")
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents"))


@query("op11_hard_negatives", """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  [floor(256 * x::DOUBLE) for x in embedding] AS v, row_number() OVER () AS uid FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len([x for x in embedding if x IS NULL OR isnan(x) OR isinf(x)]) = 0),
s AS (SELECT a.uid, a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id, list_inner_product(a.v, c.v)::BIGINT AS score
      FROM e a JOIN e c ON a.uid != c.uid AND len(a.v) = len(c.v) WHERE a.vec_id % 50 = 0),
p AS (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY score DESC, vec_id) AS place FROM s WHERE same QUALIFY place <= 5),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.uid, p.place ORDER BY s.score DESC, s.vec_id) AS rank
      FROM p JOIN s ON p.uid = s.uid AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
""")
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", label), F.col("vec_id") % 50 == 0)


@query("op12_conversation_repair")
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_digests(damaged(read(spark, sf_dir, "conversations")), F.col("absent"))


@query("op13_bpe")
def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    decoded = bpe_decode(bpe_encode(docs, path), path)
    return decoded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    )
