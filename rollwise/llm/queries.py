"""The named queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (contamination, jaccard, knn, langid, lines, negatives, packing, pii, repeats, secrets, sharding,
               token_counts, whitening)
from .common import count_kind, of_kinds, prepare, sha256, spans_text, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    base = of_kinds(F.col("spans"), secrets.BASE_KINDS)
    return found.select(
        F.col("id").alias("doc_id"), *(count_kind(F.col("spans"), k).alias(f"n_{k}") for k in secrets.BASE_KINDS),
        sha256(spans_text(base)).alias("base_sha256"), spans_text(F.col("spans")).alias("spans"))


def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.components(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_shingles", "component_id")


OP2_SQL = r"""
WITH RECURSIVE word AS (
    SELECT doc_id, [x FOR x IN regexp_split_to_array(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF x <> ''] AS w FROM documents
), place AS (
    SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM word WHERE len(w) > 0
), shingle AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s FROM place
), size AS (
    SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id
), link AS (
    SELECT x, y FROM shared JOIN size p ON p.doc_id = x JOIN size q ON q.doc_id = y
    WHERE 100 * shared.n >= 90 * (p.n + q.n - shared.n)
), edge AS (
    SELECT x, y FROM link UNION ALL SELECT y, x FROM link
), reach AS (
    SELECT doc_id, doc_id AS root FROM documents
    UNION
    SELECT edge.y, reach.root FROM reach JOIN edge ON edge.x = reach.doc_id AND reach.root < edge.y
), least_root AS (
    SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id
)
SELECT doc_id, coalesce(size.n, 0)::BIGINT AS n_shingles, component_id FROM least_root LEFT JOIN size USING (doc_id)
"""


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


OP3_SQL = """
WITH v AS (
    SELECT vec_id, [floor(256 * c::DOUBLE)::BIGINT FOR c IN embedding] AS x FROM embeddings
    WHERE embedding IS NOT NULL AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0
), scored AS (
    SELECT q.vec_id AS query_id, d.vec_id, list_sum([p[1] * p[2] FOR p IN list_zip(q.x, d.x)])::BIGINT AS score
    FROM v q JOIN v d ON q.vec_id % 50 = 0 AND q.vec_id <> d.vec_id
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM scored
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op5_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "n_item", "n_shared")


OP5_SQL = r"""
WITH word AS (
    SELECT 'd' AS kind, doc_id AS id, [x FOR x IN regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+') IF x <> ''] AS w FROM documents
    UNION ALL
    SELECT 'b', item_id, [x FOR x IN regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+') IF x <> ''] FROM benchmark
), place AS (
    SELECT kind, id, w, unnest(range(1, len(w) - 3)) AS i FROM word WHERE len(w) >= 5
), shingle AS (
    SELECT DISTINCT kind, id, array_to_string(w[i:i + 4], ' ') AS s FROM place
), size AS (
    SELECT id, count(*) AS n FROM shingle WHERE kind = 'b' GROUP BY id
), shared AS (
    SELECT d.id AS doc_id, b.id AS item_id, count(*) AS n FROM shingle d JOIN shingle b ON d.s = b.s AND d.kind = 'd' AND b.kind = 'b'
    GROUP BY d.id, b.id
)
SELECT doc_id, item_id, size.n AS n_item, shared.n AS n_shared FROM shared JOIN size ON size.id = item_id
WHERE shared.n * 100 >= size.n * 80
"""


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(table(spark, sf_dir, "documents"))
    base = of_kinds(F.col("spans"), pii.KINDS)
    return found.select(
        F.col("id").alias("doc_id"), *(count_kind(F.col("spans"), k).alias(f"n_{k}") for k in pii.KINDS),
        sha256(spans_text(base)).alias("base_sha256"), spans_text(F.col("spans")).alias("spans"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    out = langid.held_out(F.col("doc_id"))
    model = langid.fit(docs.filter(~out).select("text", "lang"))
    return langid.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", out.alias("held_out"), "lang_pred", "score")


def op8_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.digest(table(spark, sf_dir, "documents"))


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


OP9_SQL = """
WITH byte AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), block AS (
    SELECT doc_id, h, unnest(range(0, length(h) // 2 - 399, 512)) AS base FROM byte WHERE length(h) >= 800
), part AS (
    SELECT doc_id, base, substr(h, 2 * base + 1, 2 * (512 + 399)) AS h FROM block
), start AS (
    SELECT doc_id, base, h, unnest(range(0, length(h) // 2 - 399)) AS i FROM part
), string AS (
    SELECT doc_id, base + i AS i, md5_number(substr(h, 2 * i + 1, 800)) AS m FROM start
), hit AS (
    SELECT doc_id, i FROM string WHERE m IN (SELECT m FROM string GROUP BY m HAVING count(*) > 1)
), step AS (
    SELECT doc_id, i, CASE WHEN i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 400 THEN 1 ELSE 0 END AS fresh FROM hit
), numbered AS (
    SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM step
), run AS (
    SELECT doc_id, min(i) AS a, max(i) + 400 AS b FROM numbered GROUP BY doc_id, g
), gap AS (
    SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM run
), cut AS (
    SELECT doc_id, sum(b - a) AS removed, count(*) AS spans, max(b) AS stop,
           string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head
    FROM gap JOIN byte USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(head || substr(h, 2 * stop + 1), h))) AS kept_sha256
FROM byte LEFT JOIN cut USING (doc_id)
"""


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)


OP12_SQL = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           [floor(256 * c::DOUBLE)::BIGINT FOR c IN embedding] AS x
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
           list_sum([p[1] * p[2] FOR p IN list_zip(a.x, b.x)])::BIGINT AS score
    FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positive AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INT AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN scored USING (anchor_id)
WHERE NOT same AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) <= 10
"""


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        F.col("place").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        F.col("slot").alias("virtual_slot"), "map_version")


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_secrets, op2_jaccard, op3_top_k, op4_packing, op5_contamination, op6_personal_data, op7_language, op8_lines,
        op9_repeats, op10_token_counts, op11_whitening, op12_hard_negatives, op13_sharding)}


def oracle_sql() -> dict[str, str]:
    return {"op2_jaccard": OP2_SQL, "op3_top_k": OP3_SQL, "op5_contamination": OP5_SQL, "op9_repeats": OP9_SQL,
            "op12_hard_negatives": OP12_SQL}
