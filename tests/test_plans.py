"""The plans that have to hold at scale."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from checks import fixtures as fx
from doclake.operators import aggregates, batching, documents, flatten, incremental, summaries
from doclake.operators.joins import join_reduced
from doclake.operators.registry import dedupe_latest

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final(df) -> str:
    df.collect()
    return physical(df)


@pytest.fixture
def stored(spark, tmp_path):
    parsed = fx.parsed(spark, SF)
    flatten.flatten_elements(parsed).write.parquet(str(tmp_path / "e"))
    flatten.flatten_pages(parsed).write.parquet(str(tmp_path / "p"))
    parsed.write.parquet(str(tmp_path / "v"))
    return [spark.read.parquet(str(tmp_path / n)) for n in ("e", "p", "v")]


def test_flatten_does_not_shuffle_and_parses_once(spark):
    for df in (flatten.flatten_elements(fx.parsed(spark, SF)), flatten.flatten_pages(fx.parsed(spark, SF))):
        assert "Exchange" not in physical(df)
        assert physical(df).count("to_variant_object") == 1
        assert "PythonUDF" not in physical(df)


def test_rank_has_no_single_partition(spark):
    ranked = batching.global_rank(fx.raw(spark, SF))
    assert "SinglePartition" not in plan(ranked)


def test_incremental_join_can_shuffle(spark):
    for mode in ("parsed_hash", "registry_hash"):
        text = plan(incremental.not_yet_parsed(fx.registry(spark, SF), fx.parsed_before(spark, SF), mode=mode))
        assert "NestedLoop" not in text and "NULL_AWARE" not in text.upper().replace("-", "_")


def test_scans_read_only_what_is_needed(spark, stored):
    elements, pages, parsed = stored
    schema = physical(aggregates.type_distribution(elements))
    assert "ReadSchema: struct<element_type:string>" in schema
    lookup = physical(flatten.flatten_elements(parsed, "run_en"))
    assert "EqualTo(pipeline_run_id,run_en)" in lookup
    listed = documents.list_documents(elements, pages, fx.log(spark, SF), limit=2)
    assert "In(file_name" in physical(listed) or "EqualTo(file_name" in physical(listed)


def test_stats_read_the_elements_once(spark, stored):
    elements, pages, _ = stored
    text = physical(documents.corpus_stats(elements, pages, fx.log(spark, SF)))
    assert text.count("element_type:string") == 1


def test_summaries_give_what_elements_give(spark, stored, tmp_path):
    elements, pages, _ = stored
    log = fx.log(spark, SF)
    # A second run of some documents with other rows, NULL types, numbers and names, and pages without elements.
    extra = elements.filter("element_id < 3").withColumn("pipeline_run_id", F.lit("again"))
    odd = extra.limit(40).withColumns({"file_name": F.lit(None).cast("string"), "element_id": F.lit(None).cast("int")})
    elements = elements.unionByName(extra.withColumn("element_type", F.lit("other"))).unionByName(odd)
    pages = pages.unionByName(pages.limit(20).withColumns({"file_name": F.lit("bare"), "source_path": F.lit("bare")}))
    summaries.summarize(elements, pages).write.parquet(str(tmp_path / "s"))
    rows = spark.read.parquet(str(tmp_path / "s"))
    found = lambda df: sorted(tuple(r) for r in df.select(*[F.col(c).cast("string") for c in df.columns]).fillna("-").collect())
    for q in ("", "SRC1"):
        want = documents.documents_overview(elements, pages, log, q)
        assert found(summaries.summarized_overview(rows, log, q)) == found(want) != []
    for page in ({"limit": 7}, {"limit": 3, "offset": 5}, {"limit": 100, "q": "c_1"}):
        want = documents.list_documents(elements, pages, log, **page).collect()
        assert summaries.summarized_list(rows, log, **page).collect() == want != []
        behind = documents.list_documents(elements, pages, log, **page, after=want[0]).collect()
        assert summaries.summarized_list(rows, log, **page, after=want[0]).collect() == behind
    want = documents.corpus_stats(elements, pages, log)
    assert found(summaries.summarized_stats(rows, log)) == found(want)
    merged = {(r["metric"], r["name"]): r["value"] for r in summaries.merged_states(summaries.run_states(rows, log)).collect()}
    exact = {(r["metric"], r["name"]): r["value"] for r in want.collect()}
    assert merged.keys() == exact.keys() and all(abs(merged[k] - v) <= 0.04 * v for k, v in exact.items())
    assert all(merged[k] == v for k, v in exact.items() if k[0] in ("type", "elements", "pages"))
    # Reduced by type in the tasks that read a document, then one shuffle by document.
    text = physical(summaries.summarize(elements, pages))
    assert "Window" not in text and "Join" not in text


def test_nothing_summarized_is_zero(spark, stored):
    elements, pages, _ = stored
    none = summaries.summarize(elements.limit(0), pages.limit(0))
    log = fx.log(spark, SF).limit(0)
    zeros = [(m, "", 0) for m in ("completed", "documents", "elements", "failed", "pages")]
    for df in (summaries.summarized_stats(none, log), summaries.merged_states(summaries.run_states(none, log))):
        assert sorted(tuple(r) for r in df.collect()) == zeros
    assert summaries.summarized_list(none, log).collect() == []


@pytest.fixture
def small_thresholds(spark):
    """Shuffle joins only, and a partition counts as hot from a few kilobytes on."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in old.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


N = 60_000


def hot(spark):
    """Rows of which a third share the key "hot"."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 9000).cast("string"))
    noise = F.sha2(F.col("id").cast("string"), 256)
    return spark.range(0, N, 1, 8).select(key.alias("key"), F.col("id").cast("int").alias("n"), noise.alias("noise"))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_hot_keys_are_split(spark, small_thresholds, how):
    left = hot(spark)
    reduced = spark.range(0, 9000, 2, 8).select(F.col("id").cast("string").alias("key")).unionByName(
        spark.createDataFrame([("hot",), ("hot",)], "key string")
    ).groupBy("key").agg(F.count(F.lit(1)).alias("m"))
    joined = join_reduced(left, reduced, "key", how)
    want = left.join(F.broadcast(reduced), "key", how)
    assert joined.columns == want.columns and joined.count() == want.count()
    if how == "left_anti":  # with the hot rows kept
        joined = join_reduced(left, reduced.filter("key != 'hot'"), "key", how)
    assert "skew=true" in final(joined)


def test_hot_copies_files_and_documents_are_split(spark, small_thresholds):
    rows = hot(spark)
    registry = rows.select(
        F.col("noise").alias("staging_path"), F.col("key").alias("content_hash"), F.lit("synced").alias("sync_status"), F.lit("r1").alias("pipeline_run_id")
    )
    parsed = spark.range(0, 9000, 7, 8).select(F.sha2(F.col("id").cast("string"), 256).alias("source_path"), F.col("id").cast("string").alias("content_hash"))
    assert "skew=true" in final(incremental.not_yet_parsed(registry, parsed, "r1"))

    pages = rows.select(F.col("key").alias("file_name"), F.col("noise").alias("source_path"), F.col("n").alias("page_number"))
    assert "skew=true" in final(documents.page_neighbors(pages))

    elements = rows.select(F.col("key").alias("source_path"), "noise", F.lit("r1").alias("pipeline_run_id"))
    new = spark.createDataFrame([("1", "x", "r2"), ("1", "y", "r2")], elements.schema)
    replaced = flatten.replace_documents(elements, new)
    assert replaced.count() == elements.filter("source_path != '1'").count() + 2
    assert "skew=true" in final(replaced)
    index = elements.select("source_path", "pipeline_run_id", F.current_timestamp().alias("parsed_at"))
    assert "skew=true" in final(flatten.current_rows(elements, index))


def test_copies_are_reduced_before_the_shuffle(spark):
    text = physical(dedupe_latest(hot(spark), ["key"], ["n"]))
    assert "Window" not in text and text.count("Aggregate") == 2
    assert text.index("Exchange") < text.rindex("Aggregate")


def test_boxes_are_normalized_without_a_join(spark):
    """Page sizes come with the rows: no join, no Exchange."""
    text = physical(documents.normalize_bbox(flatten.flatten_elements(fx.parsed(spark, SF), page_sizes=True), None, 459.0, 99.0))
    assert "Join" not in text and "Exchange" not in text
