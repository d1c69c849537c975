"""One query per operator over its whole table; the operators keep their own, wider interfaces."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from doclake.llm import (
    chat,
    decontaminate,
    fingerprints,
    html_labeller,
    licenses,
    minmax_dedup,
    packing,
    periodic_runs,
    quality,
    sql,
    token_counts,
    token_files,
    vector_codes,
    warc_archive,
)
from doclake.llm.common import shared_folder

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def all_sql() -> dict[str, str]:
    return sql.all_sql()


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_quality_ranking(spark: SparkSession, sf: str) -> DataFrame:
    """Quality of every document by a pairwise ranking learnt from labels outside the held-out third."""
    docs = table(spark, sf, "documents")
    ranker = quality.train(docs, table(spark, sf, "labels"))
    scored = quality.score_quality(docs.select("doc_id", "text"), ranker)
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query
def op2_one_permutation_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprints of every document, of its edited text, and how near they and the next document's are."""
    return fingerprints.compare_with_next(table(spark, sf, "documents"))


@query
def op3_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    """All conversations, and one full of control strings, formatted by the compiled template and read back."""
    odd = "\\### Assistant: </turn> ok"
    added = spark.createDataFrame(
        [(-7, 0, "user", odd), (-7, 1, "assistant", odd)], "conv_id long, turn long, role string, text string"
    )
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    return chat.read_back(chat.format_conversations(turns))


@query
def op4_license_paragraphs(spark: SparkSession, sf: str) -> DataFrame:
    """Licence families of every document's paragraphs, classified and confirmed by templates."""
    docs = table(spark, sf, "documents")
    return licenses.license_documents(docs, licenses.train(docs))


@query
def op5_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens of every document by the word-level vocabulary, counted per distinct pre-token."""
    return token_counts.count_tokens(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op6_minmax_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    """Near-duplicate components of whole documents: three-word shingles, similarity of 85 percent."""
    return minmax_dedup.near_duplicates(table(spark, sf, "documents"), words=3, percent=85)


@query
def op7_genetic_packing(spark: SparkSession, sf: str) -> DataFrame:
    """Every document as pieces of at most 4096 tokens, packed into sequences."""
    return packing.pack_documents(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"), 4096, end_id=1)


@query
def op8_benchmark_phrases(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that hold passages of 13 words of a benchmark item, through a positional index."""
    found = decontaminate.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"), window=13, percent=5)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


@query
def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    """The stages of ``corpus_pipeline`` over the documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf)


@query
def op9_token_files(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as byte-level ids with end id 0, written to ordered Parquet files and read back from them."""
    folder = shared_folder(spark, "token-files")
    docs = table(spark, sf, "documents")
    token_files.write_token_files(docs, folder, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    found = token_files.id_checksums(token_files.read_token_files(spark, folder))
    return found.select("doc_id", "start", "n_tokens", "ids_crc32")


@query
def op10_html_main_text(spark: SparkSession, sf: str) -> DataFrame:
    """Main text of every page, its blocks labelled by the recurrent network trained on a sample of the pages."""
    pages = table(spark, sf, "pages")
    return html_labeller.extract(pages, html_labeller.train(pages))


@query
def op11_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Runs of repeated words in every document, some of which are given a repeated ending first."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = periodic_runs.periodic_runs(periodic_runs.with_planted_repeats(docs), least=24, repeats=3)
    best = periodic_runs.strongest()
    lines = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op12_warc_archive(spark: SparkSession, sf: str) -> DataFrame:
    """Every page as a WARC record in a content-addressed archive, and what is read back from it."""
    folder = shared_folder(spark, "warc")
    warc_archive.write_archive(warc_archive.page_records(table(spark, sf, "pages")), folder)
    found = warc_archive.read_records(spark, folder)
    return found.select(
        F.col("name").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to_name").alias("refers_to")
    )


@query
def op13_vector_codes(spark: SparkSession, sf: str) -> DataFrame:
    """Codes of all vectors under codebooks learnt from all of them in whole numbers."""
    vectors = vector_codes.whole_numbers(table(spark, sf, "embeddings").select("vec_id", "embedding", "label"))
    blocks = vector_codes.hilbert_blocks(vectors, parts=4)
    books = vector_codes.learn(blocks, vector_codes.first_entries(vectors, parts=4, entries=256), rounds=4)
    return vector_codes.encode(vectors, blocks, books)
