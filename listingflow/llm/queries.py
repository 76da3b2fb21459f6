"""Registered corpus queries: each applies one operator with production settings to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listingflow.llm import codec, counts, exact, licenses, lines, negatives, neighbours, packing, pieces, quality, ranking, sharding, simhash
from listingflow.llm.common import table
from listingflow.llm.sql import ORACLES as SQL


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = counts.token_counts(table(spark, sf_dir, "documents"))
    return counted.selectExpr("doc_id", "n_bytes", "n_tokens", "n_tokens > 512 as over_limit")


def op3_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codec.digests(table(spark, sf_dir, "documents"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(table(spark, sf_dir, "documents"))


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_report(table(spark, sf_dir, "documents"))


def op9_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return negatives.hard_negatives(rows.withColumn("label", negatives.relabelled(F.col("label"), F.col("vec_id"))))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_classifier, op2_token_counts, op3_bpe_codec, op4_sharding, op5_simhash_near_dedup, op6_nearest_neighbours,
        op7_exact_dedup, op8_line_dedup, op9_license_scans, op10_best_fit_packing, op11_hard_negatives,
        op12_ranked_search, op13_piece_codec, pipeline,
    )
}
ORACLES = dict(SQL)
