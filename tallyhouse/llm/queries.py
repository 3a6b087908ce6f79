"""The operators over the test tables, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import decontamination, fingerprints, jaccard_join, licenses, line_dedup, minhash_dedup, packing, quality_gam, ranked_search, secrets, token_alignment, token_files, toxicity
from tallyhouse.llm.common import table
from tallyhouse.llm.tokens import tokenizer_path


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find(table(spark, sf_dir, "documents"), quality_gam.fold(5) == 0)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "text", F.col("_lines").alias("n_lines"), F.col("_removed").alias("n_removed"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_next(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontamination.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated"
    )


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_gam.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.classes(table(spark, sf_dir, "documents"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_files.write_files(
        table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), end_id=1, vocabulary=49_408
    )
    return token_files.read_files(files)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(
        table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    )


def op13_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.classes(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secrets": op1_secrets,
    "op2_line_dedup": op2_line_dedup,
    "op3_fingerprints": op3_fingerprints,
    "op4_decontamination": op4_decontamination,
    "op5_licenses": op5_licenses,
    "op6_packing": op6_packing,
    "op7_quality": op7_quality,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_token_files": op9_token_files,
    "op10_toxicity": op10_toxicity,
    "op11_ranked_search": op11_ranked_search,
    "op12_token_alignment": op12_token_alignment,
    "op13_minhash_dedup": op13_minhash_dedup,
}

ORACLES: dict[str, str] = {
    "op2_line_dedup": line_dedup.ORACLE,
    "op4_decontamination": decontamination.ORACLE,
    "op8_jaccard_join": jaccard_join.ORACLE,
    "op11_ranked_search": ranked_search.ORACLE,
    "op13_minhash_dedup": minhash_dedup.ORACLE,
}
