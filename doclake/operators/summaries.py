"""One row per parsed document, and a few per run, from which lists and corpus statistics are read instead of element rows.

A document's summary holds its element numbers, rows per element type and page numbers, a small share of the bytes of its
elements and no text. Summaries are rows of a run like any others, so those of documents parsed again are left out with the
run's other rows, and everything read from them equals what is read from elements and pages.

A run's states go one step further: sums, and sketches of file names that merge without loss of what they are. A dashboard
over them reads a handful of rows per run. Sums are exact, numbers of files are estimates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, functions as F

from doclake.operators.aggregates import status_by_file
from doclake.operators.documents import DOCUMENT, described, of_page, pick_page, same_document, search, totals_or_zero
from doclake.schemas import DOCUMENT_SUMMARIES, RUN_STATES

#: Logarithm of the buckets of a sketch: 2^14 give a standard error of 0.8 percent.
SKETCH = 14

_KEY = ["source_name", "source_path", "file_name", "pipeline_run_id"]


def _union(sets: str) -> Column:
    return F.array_sort(F.array_distinct(F.flatten(F.collect_list(sets))))


def summarize(elements: DataFrame, pages: DataFrame) -> DataFrame:
    """A row per document and run that has element or page rows.

    All rows of a document come from one task, where they are reduced to a row per type before anything is shuffled. NULL is
    a type like any other; element and page numbers that are NULL are counted as rows, but are not numbers.
    """
    by_type = elements.groupBy(*_KEY, "element_type").agg(
        F.count(F.lit(1)).alias("cnt"), F.collect_set("element_id").alias("element_ids"), F.min("parsed_at").alias("parsed_at")
    )
    by_page = pages.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("page_rows"), F.collect_set("page_number").alias("page_numbers"))
    both = by_type.withColumn("type", F.struct("element_type", "cnt")).unionByName(by_page, allowMissingColumns=True)
    return (
        both.groupBy(*_KEY)
        .agg(
            _union("element_ids").alias("element_ids"),
            F.array_sort(F.collect_list("type")).alias("element_types"),
            _union("page_numbers").alias("page_numbers"),
            F.coalesce(F.sum("page_rows"), F.lit(0)).alias("page_rows"),
            F.min("parsed_at").alias("parsed_at"),
        )
        .select(*DOCUMENT_SUMMARIES.names)
    )


def _with_elements(summaries: DataFrame) -> DataFrame:
    return summaries.filter(F.size("element_types") > 0)


def _per_document(summaries: DataFrame) -> DataFrame:
    return summaries.groupBy(*DOCUMENT).agg(
        F.size(_union("element_ids")).cast("long").alias("total_elements"), F.min("parsed_at").cast("string").alias("parsed_at")
    )


def _types_by_file(summaries: DataFrame) -> DataFrame:
    """What :func:`doclake.operators.aggregates.type_map` gives for the elements."""
    counted = (
        summaries.select("file_name", F.inline("element_types"))
        .groupBy("file_name", "element_type")
        .agg(F.sum("cnt").alias("cnt"))
    )
    entries = F.sort_array(F.collect_list(F.struct("element_type", "cnt")))
    return counted.groupBy("file_name").agg(F.map_from_entries(entries).alias("element_types"))


def _pages_by_file(summaries: DataFrame) -> DataFrame:
    """Distinct page numbers per file name that has page rows."""
    numbers = summaries.filter("page_rows > 0").select("file_name", F.explode_outer("page_numbers").alias("page_number"))
    return numbers.groupBy("file_name").agg(F.count_distinct("page_number").alias("total_pages"))


def _described(documents: DataFrame, summaries: DataFrame, log: DataFrame, status: str) -> DataFrame:
    return described(documents, _types_by_file(summaries), _pages_by_file(summaries), status_by_file(log, status))


def summarized_overview(summaries: DataFrame, log: DataFrame, q: str = "", status: str = "max") -> DataFrame:
    """The rows of :func:`doclake.operators.documents.documents_overview`."""
    return _described(_per_document(_with_elements(search(summaries, q))), summaries, log, status)


def summarized_list(
    summaries: DataFrame,
    log: DataFrame,
    limit: int = 10,
    offset: int = 0,
    q: str = "",
    status: str = "max",
    after: Row | None = None,
) -> DataFrame:
    """The rows of :func:`doclake.operators.documents.list_documents`, with the same arguments."""
    found = _with_elements(search(summaries, q)).groupBy(*DOCUMENT).agg(F.min("parsed_at").alias("parsed_at"))
    chosen, order = pick_page(found, limit, offset, after)
    shown = of_page(summaries, chosen)
    documents = same_document(_per_document(_with_elements(shown)), chosen)
    return _described(documents, shown, of_page(log, chosen), status).orderBy(*order)


def _measures(summaries: DataFrame, log: DataFrame) -> DataFrame:
    """Rows ``(run, metric, name, value, file)``: counts that add up, and files of which distinct ones are counted."""
    file = F.struct(F.col("file_name").alias("name"))
    nothing = F.lit(None).cast("struct<name:string>")

    def row(metric: str | Column, name: Column | str, value: Column | None, counted: Column | None = None) -> Column:
        return F.struct(
            (F.lit(metric) if isinstance(metric, str) else metric).alias("metric"),
            (F.lit(name) if isinstance(name, str) else name).alias("name"),
            (F.lit(0) if value is None else value).cast("long").alias("value"),
            (nothing if counted is None else counted).alias("file"),
        )

    elements = F.aggregate("element_types", F.lit(0).cast("long"), lambda total, t: total + t["cnt"])
    has_elements = F.size("element_types") > 0
    of_document = F.array(
        row("elements", "", elements),
        row("pages", "", F.col("page_rows")),
        F.when(has_elements, row("documents", "", None, file)),
        F.when(has_elements, row("source", F.col("source_name"), None, file)),
    )
    of_types = F.transform("element_types", lambda t: row("type", t["element_type"], t["cnt"]))
    documents = summaries.select("pipeline_run_id", F.inline(F.filter(F.concat(of_document, of_types), lambda m: m.isNotNull())))
    ended = log.filter(F.col("status").isin("completed", "failed"))
    return documents.unionByName(ended.select("pipeline_run_id", F.inline(F.array(row(F.col("status"), "", None, file)))))


def summarized_stats(summaries: DataFrame, log: DataFrame) -> DataFrame:
    """The rows of :func:`doclake.operators.documents.corpus_stats`."""
    # Reduced to a row per file first, so that no metric with very many files is counted in one task.
    by_file = _measures(summaries, log).groupBy("metric", "name", "file").agg(F.sum("value").alias("value"))
    return totals_or_zero(by_file.select("metric", "name", F.when(F.col("file").isNotNull(), 1).otherwise(F.col("value")).alias("value")))


def run_states(summaries: DataFrame, log: DataFrame) -> DataFrame:
    """Per run, metric and name: a sum, or a sketch of the files counted."""
    # A sketch passes NULL and empty text over, but a missing name and an empty one count as a file each.
    counted = F.when(F.col("file").isNotNull(), F.coalesce(F.concat(F.lit("="), "file.name"), F.lit("none")))
    return (
        _measures(summaries, log)
        .withColumn("counted", counted)
        .groupBy("pipeline_run_id", "metric", "name")
        .agg(F.sum("value").alias("value"), F.hll_sketch_agg("counted", F.lit(SKETCH)).alias("sketch"))
        .select(*RUN_STATES.names)
    )


def merged_states(states: DataFrame) -> DataFrame:
    """The rows of :func:`summarized_stats` from the states of runs; numbers of files are estimates.

    ``hll_union_agg`` merges the sketches of all runs, so a file met in several counts once.
    """
    sums = ("type", "elements", "pages")
    merged = states.groupBy("metric", "name").agg(
        F.sum("value").alias("value"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("files")
    )
    value = F.when(F.col("metric").isin(*sums), F.col("value")).otherwise(F.col("files"))
    return totals_or_zero(merged.select("metric", "name", value.alias("value")))
