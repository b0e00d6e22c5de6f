"""The registered queries: each operator on its whole table, in the columns of its contract."""

from __future__ import annotations

import importlib.util
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattframe.llm import (
    decontamination,
    licenses,
    line_dedup,
    near_dedup,
    packing,
    quality,
    quality_rules,
    source_divergence,
    substring_dedup,
    top_k,
    toxicity,
    url_filter,
    whitening,
)
from wattframe.llm.common import held_out, parquet

# fixed values: the rules of the URL query
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
QUALITY_THRESHOLD = 0.7
#: Every line that has a word takes part.
LINE_WORDS = 1


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Place of a public tokenizer's file."""
    spec = importlib.util.find_spec("public_tokenizers")
    if spec is None or spec.origin is None:
        raise ModuleNotFoundError("public_tokenizers is not installed")
    return str(Path(spec.origin).parent / name)


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = parquet(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_filter.judge_urls(pages, url_filter.rule_table(spark, URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = parquet(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.find_contamination(docs, parquet(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = parquet(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, parquet(spark, sf_dir, "labels"))
    scored = quality.score_documents(docs, model)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted"),
    )


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = parquet(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, parquet(spark, sf_dir, "labels"))
    graded = toxicity.grade_documents(docs, model)
    return graded.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        "severity",
        "grade",
        "predicted",
        (F.col("predicted") == 1).alias("toxic"),
    )


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = parquet(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack_documents(docs, tokenizer_path())


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = parquet(spark, sf_dir, "embeddings")
    weights = top_k.integer_vector(F.col("embedding"))
    vectors = rows.select(F.col("vec_id").alias("id"), weights.alias("weights"))
    vectors = vectors.withColumn("terms", top_k.dense_terms(F.col("weights")))
    found = top_k.top_k(top_k.build_index(vectors), vectors.filter("id % 100 = 0"), 10)
    return found.withColumnRenamed("id", "vec_id")


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(parquet(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(parquet(spark, sf_dir, "documents"), min_words=LINE_WORDS)


def op9_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeated(parquet(spark, sf_dir, "documents"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = parquet(spark, sf_dir, "documents")
    found = licenses.scan_licenses(docs, licenses.known_table(spark))
    names = F.array_join("line_licenses", ",")
    return found.select("doc_id", "license", "n_license_lines", names.alias("line_licenses"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every two sources of a language, and the ten terms that tell a source from its language.

    Null texts, languages and sources are empty; ties are in the items' order; no rows without
    documents."""
    return source_divergence.audit(parquet(spark, sf_dir, "documents"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every text, and whether the rules keep it. A null or empty text has no words and
    fails; equal texts have equal verdicts; no rows without documents."""
    docs = parquet(spark, sf_dir, "documents").select("doc_id", "text")
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    judged = quality_rules.judge(docs, measures=base)
    return judged.select(
        "doc_id", *base, failed.alias("base_failed"), (F.col("kept") & ~failed).alias("kept")
    )


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each usable vector and component. Null vectors and those with null or non-finite
    components go; repeated rows stay; components of no variance, and so all rows if vectors are
    alike, are left out; a deviation beyond 64 bits is an error."""
    rows = parquet(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = whitening.fit(rows)
    white = whitening.whiten(rows, model)
    explained = F.array(*map(F.lit, model.explained.tolist())).cast("array<double>")
    place = F.posexplode("whitened").alias("place", "whitened")
    found = white.select("vec_id", F.col("deviation").cast("long").alias("deviation"), place)
    return found.select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("place")).alias("explained"),
        whitening.identity_error(white).scalar().alias("identity_error"),
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of ``corpus_pipeline``, one after the other."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q
    for q in (
        op1_url_filter,
        op2_decontamination,
        op3_quality,
        op4_toxicity,
        op5_packing,
        op6_top_k,
        op7_near_dedup,
        op8_line_dedup,
        op9_suffix_array,
        op10_licenses,
        op11_source_divergence,
        op12_quality_rules,
        op13_whitening,
        pipeline,
    )
}
