"""Raw documents to training sequences: the stages, their order, and one run of all."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wattframe.checkpoints import shared_folder
from wattframe.llm import decontamination, line_dedup, near_dedup, packing, quality
from wattframe.llm.common import free_name, parquet
from wattframe.llm.queries import LINE_WORDS, QUALITY_THRESHOLD, tokenizer_path


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold.

    The model learns from the labelled raw documents."""
    raw = parquet(spark, sf_dir, "documents")
    model = quality.fit(raw, parquet(spark, sf_dir, "labels"))
    return quality.keep_quality(docs, model, QUALITY_THRESHOLD)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that match an earlier line."""
    return line_dedup.drop_repeated_lines(docs, min_words=LINE_WORDS)


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return near_dedup.drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the contamination rule does not catch."""
    plain = docs
    names = {}
    for name in decontamination.ADDED:
        if name in docs.columns:  # the operator would replace it
            names[name] = free_name([*plain.columns, *decontamination.ADDED], f"own_{name}")
            plain = plain.withColumnRenamed(name, names[name])
    found = decontamination.find_contamination(plain, parquet(spark, sf_dir, "benchmark"))
    found = found.filter("not contaminated").drop(*decontamination.ADDED)
    for name, own in names.items():
        found = found.withColumnRenamed(own, name)
    return found


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document's tokens stands in the training sequences."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_deduplication),
    ("minhash_near_dedup", near_deduplication),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: SQL expresses neither the classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each is stored and read again, so none is computed twice."""
    docs = parquet(spark, sf_dir, "documents")
    folder = shared_folder(spark)
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
