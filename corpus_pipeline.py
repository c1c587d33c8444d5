"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and gives a table; ``run`` writes it to the shared
folder and the next stage reads it from there, so a lost executor never costs a finished
stage.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from dayledger.llm import linededup, minhash, packing, passages, quality
from dayledger.session import write_and_reread


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the length, repetition and fertility rules."""
    return quality.keep_good(docs, public_tokenizers.path("piece_bpe_32k.model"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that many sources share."""
    return linededup.remove_boilerplate(docs).drop("lines_removed")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, one row of each document."""
    return minhash.one_of_each(docs, once=True)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages that an earlier one holds."""
    return passages.repeated_passages(docs).drop("passages")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("minhash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("best-fit packing", best_fit_packing),
]
#: Fuzzy passages, fertility and packing are beyond SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; null texts and rows with too few words go in the first."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_and_reread(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
