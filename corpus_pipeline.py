"""A corpus from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import decontamination, jaccard_join, line_dedup, packing, quality_gam
from tallyhouse.llm.common import ship, stored, table
from tallyhouse.llm.tokens import tokenizer_path

#: Near duplicates share so many hundredths of their runs of so many words; op8_jaccard_join alone has its own measure.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier does not reject, unchanged."""
    model = quality_gam.train(docs, table(spark, sf_dir, "labels"), "quality", quality_gam.fold(5) != 0)
    return quality_gam.keep(docs, model)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later repeated runs of lines, n_chars counted anew; a text that was nothing else goes."""
    ship(spark)
    out = line_dedup.dedup_lines(docs)
    left = (F.col("_removed") == 0) | F.col("text").rlike(r"\S")
    out = out.filter(left)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the least id, unchanged."""
    ship(spark)
    found = jaccard_join.classes(docs, percent=NEAR_PERCENT, size=NEAR_WORDS)
    others = stored(found.filter("component_id <> doc_id").select("doc_id").distinct(), "duplicates")
    # A share of all documents, and so no side to send to every task.
    return docs.join(others.hint("merge"), "doc_id", "left_anti").select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that share no span with a benchmark item, unchanged."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences, all ids of all documents."""
    ship(spark)
    return packing.pack_documents(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", good_quality),
    ("line dedup", without_repeated_lines),
    ("n-gram jaccard join", one_of_each),
    ("benchmark decontamination", without_benchmark),
    ("packing", packed),
]

#: SQL has no trained classifier, no tokenizer and no greedy packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
