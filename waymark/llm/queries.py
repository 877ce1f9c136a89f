"""The registered queries of the training-data operators, one for each, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import bpe_round_trip
from .common import documents
from .conversation_repair import damaged_and_repaired
from .decontamination import passages
from .hard_negatives import hard_negatives
from .license_join import license_join
from .merkle_fixity import audit, damaged
from .pii_bootstrap import personal_data_report
from .quality_rules import quality_rules
from .rans_tokens import rans_round_trip
from .simhash_vptree import simhash_near_dedup
from .suffix_dedup import suffix_array_dedup
from .toxicity_nnpu import toxicity
from .two_fit import pack

WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.json"


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_array_dedup(documents(spark, sf_dir))


def op2_merkle_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages against a replica of them with known damage."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return audit(pages, damaged(pages)).select("page_id", "copy", "file", "offset", "length", "problem")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules(documents(spark, sf_dir))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_round_trip(documents(spark, sf_dir), public_tokenizers.path(WORD_BPE))


def op5_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data_report(documents(spark, sf_dir))


def op6_simhash_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_near_dedup(documents(spark, sf_dir))


def op7_rans_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rans_round_trip(documents(spark, sf_dir), public_tokenizers.path(BYTE_BPE))


def op8_toxicity_nnpu(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op9_license_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_join(documents(spark, sf_dir))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = passages(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "item_id", "start_word", "item_word", "n_words", "n_equal", F.round("share", 6).alias("share"))


def op11_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), public_tokenizers.path(BYTE_BPE))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return damaged_and_repaired(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_suffix_array_dedup, op2_merkle_fixity, op3_quality_rules, op4_bpe, op5_pii_bootstrap,
    op6_simhash_vptree, op7_rans_tokens, op8_toxicity_nnpu, op9_license_join, op10_decontamination, op11_best_two_fit, op12_hard_negatives, op13_conversation_repair,
)}

#: The pages and their damaged replica as records with offsets, joined; the audit reads only ranges whose hashes differ.
_RECORDS = r"""SELECT page_id, CAST(floor(page_id / 4096) AS BIGINT) AS file, sha256(record) AS hash, CAST(octet_length(encode(record)) AS BIGINT) AS length
  FROM (SELECT page_id, concat(E'WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: ', coalesce(url, ''), E'\r\nContent-Length: ', octet_length(encode(coalesce(html, ''))), E'\r\n\r\n', coalesce(html, ''), E'\r\n\r\n') AS record FROM {0})"""

ORACLES: dict[str, str] = {
    "op2_merkle_fixity": f"""WITH replica AS (SELECT page_id, url, CASE WHEN page_id % 997 = 0 THEN concat(html, '!') ELSE html END AS html FROM pages WHERE page_id % 1499 <> 1),
      a AS (SELECT *, CAST(sum(length) OVER (PARTITION BY file ORDER BY page_id) - length AS BIGINT) AS "offset" FROM ({_RECORDS.format("pages")})),
      b AS (SELECT *, CAST(sum(length) OVER (PARTITION BY file ORDER BY page_id) - length AS BIGINT) AS "offset" FROM ({_RECORDS.format("replica")}))
      SELECT coalesce(a.page_id, b.page_id) AS page_id, CAST(0 AS BIGINT) AS copy, coalesce(a.file, b.file) AS file, coalesce(a."offset", b."offset") AS "offset", coalesce(a.length, b.length) AS length,
        CASE WHEN b.page_id IS NULL THEN 'missing' WHEN a.page_id IS NULL THEN 'added' ELSE 'changed' END AS problem
      FROM a FULL JOIN b ON a.page_id = b.page_id WHERE a.hash IS DISTINCT FROM b.hash""",
    "op12_hard_negatives": """WITH c AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
      FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
      s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
        FROM c a JOIN c b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
      p AS (SELECT anchor_id, id, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
      SELECT p.anchor_id, p.id AS positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
      QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) <= 3""",
}
