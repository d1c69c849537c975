"""The registered queries against their SQL, and the pipeline against plain versions of its stages."""

from __future__ import annotations

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from doclake.llm import minmax_dedup, quality
from doclake.llm.queries import all_queries, all_sql
from tools.compare import TABLES, canonical

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not found")


def test_all_are_registered():
    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 14)} <= {x.split("_")[0] for x in names} and "pipeline" in names
    assert set(all_sql()) <= set(all_queries()) <= names


@pytest.mark.parametrize("name", sorted(all_sql()))
def test_against_sql(spark, name):
    duck = duckdb.connect()
    for table in TABLES.split():
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    cursor = duck.execute(all_sql()[name])
    names = [d[0] for d in cursor.description]
    order = sorted(names)
    df = all_queries()[name](spark, SF)
    assert sorted(df.columns) == order
    assert canonical(df.collect(), df.columns, order) == canonical(cursor.fetchall(), names, order)


def test_pipeline(spark):
    from tests.llm.test_texts import plain_components, plain_contamination

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    scored = quality.score_quality(docs, quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet")))
    good = [(r["doc_id"], r["text"]) for r in scored.filter("predicted = 1").collect()]
    kept = {d for d, _, c in plain_components(good, 5, 80) if d == c}
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    clean = {d for d, *_, bad in plain_contamination([x for x in good if x[0] in kept], items) if not bad}
    packed = corpus_pipeline.run(spark, SF)
    assert {r[0] for r in packed.select("doc_id").distinct().collect()} == clean
    assert [s[0] for s in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "packing"]


def test_stages_keep_columns_of_any_name(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 60")
    for c in ("_id", "_mark", "n_words", "items", "score", "predicted", "row", "mark", "node", "kept"):
        docs = docs.withColumn(c, F.concat(F.lit(c), F.col("doc_id").cast("string")))
    docs = docs.unionByName(docs.filter("doc_id = 7"))
    for stage in (corpus_pipeline.quality_stage, corpus_pipeline.dedup_stage, corpus_pipeline.decontamination_stage):
        found = stage(spark, docs, SF)
        assert found.columns == docs.columns
        for c in ("predicted", "_id", "n_words"):
            assert found.filter(F.col(c) != F.concat(F.lit(c), F.col("doc_id").cast("string"))).count() == 0
        assert found.count() > 0


def test_repeated_rows_leave_one(spark, odd_docs):
    docs = odd_docs.select("doc_id", "text")
    found = corpus_pipeline.dedup_stage(spark, docs, SF)
    assert found.filter("doc_id = 1").count() == 2  # two texts share the id; the repeated row is gone
    assert minmax_dedup.near_duplicates(docs).count() == docs.count()
