"""The registered queries of the training-data operators."""
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, codes, common, decontaminate, divergence, licenses, line_dedup, mixing, pii, quality, simhash, vectors


def _read(spark, sf_dir, name):
    common.bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.line_dedup(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op2_embedding_near_dedup(spark, sf_dir):
    return vectors.embedding_near_dedup(_read(spark, sf_dir, "embeddings"))


def op3_mixing_targets(spark, sf_dir):
    return mixing.mix_to_targets(_read(spark, sf_dir, "documents"))


def op4_chat_perspectives(spark, sf_dir):
    return chat.rotate_perspectives(_read(spark, sf_dir, "conversations"))


def op5_hilbert_neighbours(spark, sf_dir):
    v = _read(spark, sf_dir, "embeddings")
    return vectors.hilbert_neighbours(v, v.filter("vec_id % 100 = 0"))


def op6_license_scan(spark, sf_dir):
    return licenses.license_scan(_read(spark, sf_dir, "documents"))


def op7_quality_scores(spark, sf_dir):
    return quality.quality_scores(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op8_personal_data(spark, sf_dir):
    x = pii.find_pii(_read(spark, sf_dir, "documents"))
    base = pii.span_text(*pii.KINDS)
    return x.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in pii.KINDS], F.sha2(base, 256).alias("base_sha256"), pii.span_text(*pii.KINDS, *pii.ADDED).alias("spans"),
                    *[F.size(k).cast("long").alias(f"n_{k}") for k in pii.ADDED], sum((F.size(k) for k in (*pii.KINDS, *pii.ADDED)), F.lit(0)).cast("long").alias("n_spans"))


def op9_simhash_near_dedup(spark, sf_dir):
    x = simhash.simhash_near_dedup(_read(spark, sf_dir, "documents"))
    return x.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_byte_bpe(spark, sf_dir):
    import public_tokenizers as P

    path = P.path("byte_bpe_multi_50k.tiktoken")
    x = bpe.bpe_decode(bpe.bpe_encode(_read(spark, sf_dir, "documents").select("doc_id", "text"), path, P.PATTERN), path, P.PATTERN)
    return x.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"), F.sha2("ids_bytes", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op11_vector_codes(spark, sf_dir):
    return codes.compress(_read(spark, sf_dir, "embeddings"))


def op12_decontamination(spark, sf_dir):
    x = decontaminate.find_contamination(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    return x.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op13_source_divergence(spark, sf_dir):
    return divergence.source_divergence(_read(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_line_dedup, op2_embedding_near_dedup, op3_mixing_targets, op4_chat_perspectives, op5_hilbert_neighbours, op6_license_scan, op7_quality_scores, op8_personal_data, op9_simhash_near_dedup, op10_byte_bpe, op11_vector_codes, op12_decontamination, op13_source_divergence)}

ORACLES = {
    "op11_vector_codes": codes.codes_sql(),
    "op12_decontamination": decontaminate.CONTAMINATION_SQL,
    "op13_source_divergence": divergence.DIVERGENCE_SQL,
    "op3_mixing_targets": mixing.mixing_sql(),
    "op4_chat_perspectives": chat.CHAT_SQL,
    "op1_line_dedup": r"""
WITH l AS (SELECT doc_id, i, x AS line, translate(trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
           FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS x, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)),
r AS (SELECT k, max(doc_id) AS top FROM l WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
j AS (SELECT l.*, r.top IS NOT NULL AND l.doc_id <> r.top AS gone FROM l LEFT JOIN r USING (k))
SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(gone AS INT)) AS BIGINT) AS n_dropped, sha256(coalesce(string_agg(CASE WHEN NOT gone THEN line END, chr(10) ORDER BY i), '')) AS kept_sha256
FROM j GROUP BY doc_id""",
    "op2_embedding_near_dedup": """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.93),
r(vec_id, c) AS (SELECT vec_id, vec_id FROM v UNION SELECT l.b, r.c FROM r JOIN l ON r.vec_id = l.a),
m AS (SELECT vec_id, min(c) AS component_id FROM r GROUP BY 1), n AS (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY 1)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept FROM m LEFT JOIN n USING (vec_id)""",
    "op5_hilbert_neighbours": """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
d AS (SELECT q.vec_id AS query_id, v.vec_id, list_distance(q.e, v.e) AS score FROM v q JOIN v ON q.vec_id % 100 = 0 AND q.vec_id <> v.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM d)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10""",
}
