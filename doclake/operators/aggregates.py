"""Counts, distributions and rates over the tables.

Those that the pipeline reports for one run take ``run_id``, and give every run its row without it.
Each is a partial aggregate before its shuffle, so a run, source or type that holds a large share of
the rows arrives at the final step as one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from doclake.functions.payload import has_parse_errors
from doclake.operators.joins import join_reduced



def _of_run(df: DataFrame, run_id: str | None) -> DataFrame:
    return df if run_id is None else df.filter(F.col("pipeline_run_id") == run_id)


def docs_per_source(raw: DataFrame) -> DataFrame:
    """Documents per source, by name."""
    return raw.groupBy("source_name").agg(F.count(F.lit(1)).alias("documents")).orderBy("source_name")


def total_bytes(raw: DataFrame) -> DataFrame:
    """Total size in bytes, 0 if there are no documents."""
    return raw.agg(F.coalesce(F.sum("file_size_bytes"), F.lit(0)).alias("total_bytes"))


def parse_summary(parsed: DataFrame, log: DataFrame, run_id: str | None = None) -> DataFrame:
    """Per run: parsed documents, those with page errors, and failed ones."""
    done = (
        _of_run(parsed, run_id)
        .select("pipeline_run_id", has_parse_errors(F.col("parsed_output")).alias("has_errors"))
        .groupBy("pipeline_run_id")
        .agg(F.count(F.lit(1)).alias("parsed"), F.count_if("has_errors").alias("with_errors"))
    )
    failed = (
        _of_run(log, run_id).groupBy("pipeline_run_id").agg(F.count_if(F.col("status") == "failed").alias("failed"))
    )
    return done.join(failed, "pipeline_run_id", "full_outer").select(
        "pipeline_run_id",
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("parsed", "failed", "with_errors")],
    )


def row_counts(rows: DataFrame, name: str = "row_count") -> DataFrame:
    """Rows per document and run, of elements or of pages."""
    return rows.groupBy("source_path", "pipeline_run_id").agg(F.count(F.lit(1)).alias(name))


def type_distribution(elements: DataFrame, run_id: str | None = None) -> DataFrame:
    """Element rows per type, most frequent first."""
    return (
        _of_run(elements, run_id)
        .groupBy("element_type")
        .agg(F.count(F.lit(1)).alias("cnt"))
        .orderBy(F.desc("cnt"), "element_type")
    )


def distinct_docs(elements: DataFrame, run_id: str | None = None, approximate: bool = False) -> DataFrame:
    """Distinct file names per run; ``approximate`` trades exactness for a far smaller shuffle."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return _of_run(elements, run_id).groupBy("pipeline_run_id").agg(count("file_name").alias("documents"))


def status_counts(log: DataFrame, run_id: str | None = None) -> DataFrame:
    """Completed and failed log rows per run."""
    return (
        _of_run(log, run_id)
        .groupBy("pipeline_run_id")
        .agg(*[F.count_if(F.col("status") == s).alias(s) for s in ("completed", "failed")])
    )


def run_rows(rows: DataFrame, run_id: str | None = None) -> DataFrame:
    """Rows each run wrote."""
    return _of_run(rows, run_id).groupBy("pipeline_run_id").agg(F.count(F.lit(1)).alias("row_count"))


def type_counts(elements: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Element rows per file name and type, of all files or of those in ``files``."""
    if files is not None:
        elements = join_reduced(elements, files.select("file_name").distinct(), "file_name", "left_semi")
    return elements.groupBy("file_name", "element_type").agg(F.count(F.lit(1)).alias("cnt"))


def type_map(elements: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """:func:`type_counts` with one map per file, keys sorted."""
    entries = F.sort_array(F.collect_list(F.struct("element_type", "cnt")))
    return (
        type_counts(elements, files)
        .groupBy("file_name")
        .agg(F.map_from_entries(entries).alias("element_types"))
    )


def top_types(elements: DataFrame, k: int = 4) -> DataFrame:
    """The ``k`` most frequent element types of each file.

    The window runs over counts, so its groups are no larger than the set of types.
    """
    best = Window.partitionBy("file_name").orderBy(F.desc("cnt"), "element_type")
    return (
        type_counts(elements)
        .withColumn("place", F.row_number().over(best))
        .filter(F.col("place") <= k)
        .select("file_name", "place", "element_type", "cnt")
    )


def status_by_file(log: DataFrame, how: str = "max") -> DataFrame:
    """One status per file name over all runs: the alphabetically last, or the latest started."""
    if how == "max":
        status = F.max("status")
    elif how == "latest":
        status = F.max(F.struct("started_at", "pipeline_run_id", "source_path", "status"))["status"]
    else:
        raise ValueError("how must be 'max' or 'latest'")
    return log.groupBy("file_name").agg(status.alias("status"))


def files_per_status(log: DataFrame) -> DataFrame:
    """Distinct file names per status; a name found in two statuses counts in both."""
    return log.groupBy("status").agg(F.count_distinct("file_name").alias("files"))


def files_per_source(elements: DataFrame) -> DataFrame:
    """Distinct file names per source, most first."""
    return (
        elements.groupBy("source_name")
        .agg(F.count_distinct("file_name").alias("files"))
        .orderBy(F.desc("files"), "source_name")
    )


def success_rate(completed: Column, failed: Column) -> Column:
    """Completed as a percentage of completed and failed, one decimal; NULL when there are neither."""
    return F.round(100.0 * completed / F.nullif(completed + failed, F.lit(0)), 1)


def success_rates(log: DataFrame) -> DataFrame:
    """Distinct completed and failed file names, and the success rate."""
    by_status = files_per_status(log)

    def of(status: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("status") == status, F.col("files"))), F.lit(0).cast("long"))

    counts = by_status.agg(of("completed").alias("completed"), of("failed").alias("failed"))
    return counts.withColumn("success_rate", success_rate(F.col("completed"), F.col("failed")))


def share_of_max(distribution: DataFrame, count: str = "cnt") -> DataFrame:
    """Each group's count as a percentage of the largest one, which counts as at least 1."""
    largest = distribution.select(F.greatest(F.max(count), F.lit(1))).scalar()
    return distribution.withColumn("share", F.col(count) * 100.0 / largest)


def infer_page_extent(elements: DataFrame, ratio: float) -> DataFrame:
    """Size of each page from its boxes, for pages of unknown size and width-to-height ``ratio``."""
    reach = elements.groupBy("source_path", "page_id").agg(
        F.greatest(F.max("bbox_x2"), F.lit(1)).alias("max_x"), F.greatest(F.max("bbox_y2"), F.lit(1)).alias("max_y")
    )
    return (
        reach.withColumn("page_width", F.greatest(F.col("max_x").cast("double"), F.col("max_y") * F.lit(ratio)) * 1.02)
        .withColumn("page_height", F.greatest(F.col("max_y").cast("double"), F.col("page_width") / F.lit(ratio)))
        .select("source_path", "page_id", "page_width", "page_height")
    )
