"""The registered queries of the operators, with SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nightshare.llm import chaining, collocations, lexical, licenses, mixing, packing, permutation_search, pieces, pivot_search, planes, quality, simhash, warc
from nightshare.llm.common import saved, table


def op1_warc_capture_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


def op2_pivot_distance_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_search.exact_top(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op3_hierarchical_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), quality.good_label())
    evidence = quality.with_evidence(docs.select("doc_id", "source", "lang", "text"), model).drop("text")
    rows = quality.classify(saved(evidence, "evidence"), F.col("source"), F.col("lang"))
    return rows.select("doc_id", "quality_logit", "host_rate", "path_rate", "quality_score", "quality_keep")


def op4_swap_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op5_bit_sliced_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op6_bit_plane_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planes.id_files_round_trip(table(spark, sf_dir, "documents"))


def op7_diagonal_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op8_permutation_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation_search.permutation_top(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op9_hypergeometric_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_summary(table(spark, sf_dir, "documents")).drop("shards")


def op10_collinear_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chaining.passages(table(spark, sf_dir, "documents"))


def op11_stripe_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_geometric_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_merge_round_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.piece_digests(table(spark, sf_dir, "documents"))


OP1_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest HAVING count(*) > 1)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN first IS NULL OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first IS NULL OR page_id = first THEN NULL ELSE first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""

OP2_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS c FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, x.vec_id AS vec_id, CAST(list_sum(list_transform(list_zip(q.c, x.c), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v x ON q.vec_id % 50 = 0 AND q.vec_id <> x.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""

OP9_SQL = f"""
WITH r AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
  CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 8) AS BIGINT) % {mixing.BLOCKS} AS block FROM documents),
b AS (SELECT source, block, CAST(sum(size) AS BIGINT) AS words FROM r GROUP BY ALL),
s AS (SELECT source, CAST(sum(words) AS BIGINT) AS source_size FROM b GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY source_size / weight, source IS NULL, source) AS n FROM w),
l AS (SELECT o.*, (1.5 * (SELECT CAST(sum(source_size) AS BIGINT) FROM o) - 2 * coalesce(CAST((SELECT sum(p.source_size) FROM o p WHERE p.n < o.n) AS BIGINT), 0))
  / ((SELECT sum(weight) FROM o) - coalesce((SELECT sum(p.weight) FROM o p WHERE p.n < o.n), 0)) AS level FROM o),
t AS (SELECT source, source_size, CASE WHEN level * weight >= 2 * source_size THEN 2.0 * source_size
  ELSE (SELECT arg_min(level, n) FROM l WHERE level * weight < 2 * source_size) * weight END AS target FROM l),
q AS (SELECT b.*, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole,
  sum(words) OVER (PARTITION BY b.source ORDER BY md5(CASE WHEN b.source IS NULL THEN 'n' ELSE 's' || b.source END || ':' || block), block ROWS UNBOUNDED PRECEDING) AS upto
  FROM b JOIN t ON b.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, CAST(target AS DOUBLE) AS target, CAST(size * (whole + CASE WHEN upto - words / 2 <= target - whole * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM r JOIN q ON r.source IS NOT DISTINCT FROM q.source AND r.block = q.block
"""

QUERIES = {
    f.__name__: f
    for f in (
        op1_warc_capture_index,
        op2_pivot_distance_topk,
        op3_hierarchical_quality,
        op4_swap_packing,
        op5_bit_sliced_simhash,
        op6_bit_plane_ids,
        op7_diagonal_licenses,
        op8_permutation_neighbours,
        op9_hypergeometric_mix,
        op10_collinear_passages,
        op11_stripe_collocations,
        op12_geometric_search,
        op13_merge_round_pieces,
    )
}
SQL = {"op1_warc_capture_index": OP1_SQL, "op2_pivot_distance_topk": OP2_SQL, "op7_diagonal_licenses": licenses.license_sql(), "op9_hypergeometric_mix": OP9_SQL, "op11_stripe_collocations": collocations.collocation_sql(), "op12_geometric_search": lexical.LEXICAL_SQL}
