"""The registered queries ``opN_<name>``, with production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import bpe, crf, fertility, license_scan, maxent, piece_model, sentencepiece_ac, simhash, spaced_seeds, suffix_dedup, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = {"piece": piece_model.default_model(), "multi": piece_model.default_path("byte_bpe_multi_50k.tiktoken")}
    return fertility.fertility_rule(table(spark, sf_dir, "documents"), files, {"piece": fertility.BANDS, "multi": fertility.MULTI_BANDS})


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removed_digest(table(spark, sf_dir, "documents"))


def op4_crf_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return crf.score(docs, crf.train(docs, table(spark, sf_dir, "labels")))


def op5_bpe_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.count_tokens(table(spark, sf_dir, "documents"), piece_model.default_model())


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_ac.round_trip(table(spark, sf_dir, "documents"), piece_model.default_model())


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent.train_and_score(table(spark, sf_dir, "documents"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return license_scan.scan(docs, license_scan.train(docs))


def op10_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spaced_seeds.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (op1_fertility, op2_warc, op3_suffix_dedup, op4_crf_quality, op5_bpe_count, op6_sentencepiece, op7_simhash, op8_maxent_lm, op9_license_scan, op10_spaced_seeds)}
ORACLES: dict[str, str] = {"op2_warc": warc.SQL}
