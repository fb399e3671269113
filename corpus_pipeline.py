"""Documents to training tokens in five stages, each written before the next reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.llm import crf, near_copies, piece_model, sentencepiece_ac, spaced_seeds, suffix_dedup
from quillmark.llm.common import materialise


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the line classifier, trained on the labelled ones, rejects."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return crf.keep_good(docs, crf.train(docs, labels))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the least doc_id of each group of texts linked by a Jaccard similarity of 0.8 of their five-word shingles."""
    return near_copies.one_of_each(docs)


def suffix_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out bytes of 50-byte strings that a smaller doc_id has; documents of which nothing is left go."""
    return suffix_dedup.without_repeats(docs).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that overlap a benchmark item."""
    return spaced_seeds.without_overlaps(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece numbers of each text, checked by decoding them."""
    return sentencepiece_ac.round_trip(docs, piece_model.default_model(), with_ids=True)


STAGES = [("quality_classifier", quality), ("simhash_near_dedup", near_dedup), ("suffix_array_dedup", suffix_repeats), ("benchmark_decontamination", decontaminate), ("sentencepiece_encoding", encode)]

#: Training, fingerprints, suffix sorting and Viterbi aren't expressible in SQL; tests/llm holds run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, from the table ``documents`` under ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
