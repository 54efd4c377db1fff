"""The registered opN_ queries, one per operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from studylake.llm import (byte_cnn, lattice, licenses, minhash, mixing, packing, pii, quality_rules, secrets, sharding,
                           term_pipeline, warc, whitening)
from studylake.llm.common import read_table


def op1_e8_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_duplicates(read_table(spark, sf_dir, "embeddings"), least=0.95)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op3_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(read_table(spark, sf_dir, "documents"))


def op4_subset_sum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"))


def op5_rare_token_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read_table(spark, sf_dir, "documents"))


def op6_tensored_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the contract of this query fixes shingles of four words
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"), width=4, percent=80)


def op7_byte_cnn_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_cnn.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op8_randomness_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(read_table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read_table(spark, sf_dir, "documents"))


def op10_bilstm_crf_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(read_table(spark, sf_dir, "documents"))


def op11_sharded_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read_table(spark, sf_dir, "pages"))


def op12_term_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return term_pipeline.rank(read_table(spark, sf_dir, "benchmark"), read_table(spark, sf_dir, "documents"))


def op13_qdwh_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


WARC_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS last FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN last END AS refers_to
FROM g"""


def _terms_sql(column: str) -> str:
    return (f"unnest(regexp_extract_all(translate({column}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
            r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))")


SEARCH_SQL = f"""
WITH t AS (SELECT doc_id, {_terms_sql("text")} AS term FROM documents),
d AS (SELECT doc_id, term, COUNT(*) AS tf FROM t GROUP BY doc_id, term),
l AS (SELECT doc_id, CAST(SUM(tf) AS BIGINT) AS n FROM d GROUP BY doc_id),
totals AS (SELECT COUNT(*) AS all_docs, CAST(SUM(n) AS BIGINT) AS all_terms FROM l),
m AS (SELECT doc_id, 100 - 90 + (90 * n * all_docs) // all_terms AS m FROM l, totals),
w AS (SELECT term, CAST(floor(1000 * ln((2 * all_docs + 2) / (2 * COUNT(*) + 1))) AS BIGINT) AS w
  FROM d, totals GROUP BY term, all_docs),
i AS (SELECT DISTINCT item_id, {_terms_sql("text")} AS term FROM benchmark),
s AS (SELECT item_id, doc_id, CAST(SUM(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM i JOIN d USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place FROM s WHERE score > 0)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM r WHERE place <= 10"""


QUERIES = {
    "op1_e8_lattice": op1_e8_lattice,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_histogram_sort": op3_histogram_sort,
    "op4_subset_sum_mix": op4_subset_sum_mix,
    "op5_rare_token_licenses": op5_rare_token_licenses,
    "op6_tensored_minhash": op6_tensored_minhash,
    "op7_byte_cnn_quality": op7_byte_cnn_quality,
    "op8_randomness_secrets": op8_randomness_secrets,
    "op9_quality_rules": op9_quality_rules,
    "op10_bilstm_crf_pii": op10_bilstm_crf_pii,
    "op11_sharded_warc": op11_sharded_warc,
    "op12_term_pipeline": op12_term_pipeline,
    "op13_qdwh_whitening": op13_qdwh_whitening,
}
ORACLES = {"op11_sharded_warc": WARC_SQL, "op12_term_pipeline": SEARCH_SQL}
