"""From raw documents to packed training sequences: each stage is written as Parquet and read as the next one's input."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from doclake.llm import decontaminate, minmax_dedup, packing, quality
from doclake.llm.common import shared_folder, stored
from doclake.operators.joins import join_reduced

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality ranking accepts; it is learnt from the labels of the rows given."""
    ranker = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    # Each row as a whole beside its text, so that no column of its own is taken for a result.
    scored = quality.score_quality(docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), "text"), ranker)
    return scored.filter("predicted = 1").select(*(F.col(f"row.`{c}`").alias(c) for c in docs.columns))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest doc_id (five words, similarity 0.8).

    A row goes if no row of its doc_id is the one kept, so rows that share a doc_id stay or go together; of rows equal in
    doc_id and text one stays. Rows without doc_id stay, since no decision can name them.
    """
    found = stored(minmax_dedup.near_duplicates(docs, words=5, percent=80), "decisions")
    by_id = found.groupBy("doc_id").agg(F.max("kept").alias("kept"), F.count("*").alias("rows"))
    gone = by_id.filter("not kept and doc_id is not null").select("doc_id")
    left = join_reduced(docs, gone, "doc_id", "left_anti")
    repeated = stored(by_id.filter("rows > 1").select(F.col("doc_id").alias("_id")), "repeated")
    if repeated.isEmpty():
        return left
    again = left["doc_id"].eqNullSafe(repeated["_id"])
    once = left.join(repeated, again, "left_semi").dropDuplicates(["doc_id", "text"])
    return left.join(repeated, again, "left_anti").unionByName(once)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words lies in passages of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.without_contaminated(docs, benchmark)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all token pieces in training sequences of 4096 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), 4096, end_id=1)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("near_duplicates", dedup_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: A classifier and a tokenizer are not SQL; tests compare the stages with plain versions instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents`` of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        folder = shared_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
