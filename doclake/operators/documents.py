"""The analytical queries: document lists, document and page detail, corpus statistics."""

from __future__ import annotations

from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Row, functions as F

from doclake.functions.text import matches_search, preview
from doclake.operators.aggregates import (
    infer_page_extent,
    status_by_file,
    success_rate,
    type_counts,
    type_map,
)
from doclake.operators.flatten import page_dimensions
from doclake.operators.joins import join_reduced

MAX_LIMIT = 100

DOCUMENT = ["file_name", "source_name", "source_path"]


def search(df: DataFrame, q: str, literal: bool = False) -> DataFrame:
    """Rows whose file or source name contains ``q``, case-insensitively."""
    return df.filter(matches_search(q, F.col("file_name"), F.col("source_name"), literal=literal))


def with_defaults(df: DataFrame) -> DataFrame:
    """``df`` with display defaults in place of NULL, for those columns it has."""
    # Fixed values.
    defaults = {
        "content": "",
        "bbox_x1": 0,
        "bbox_y1": 0,
        "bbox_x2": 0,
        "bbox_y2": 0,
        "bounding_box_json": "[]",
        "status": "unknown",
        "total_pages": 0,
        "image_uri": "",
        "page_width": 0,
        "page_height": 0,
        "element_count": 0,
    }
    return df.fillna({c: v for c, v in defaults.items() if c in df.columns})


def with_preview(elements: DataFrame, n: int = 200, ellipsis: bool = False) -> DataFrame:
    return elements.withColumn("preview", preview(F.col("content"), F.col("ai_description"), n, ellipsis))


def pages_by_file(pages: DataFrame) -> DataFrame:
    """Distinct page numbers per file name."""
    return pages.groupBy("file_name").agg(F.count_distinct("page_number").alias("total_pages"))


def count_documents(elements: DataFrame, q: str = "") -> DataFrame:
    """Distinct file names that match the search."""
    return search(elements, q).agg(F.count_distinct("file_name").alias("total"))


def _per_document(elements: DataFrame) -> DataFrame:
    return elements.groupBy(*DOCUMENT).agg(
        F.count_distinct("element_id").alias("total_elements"), F.min("parsed_at").cast("string").alias("parsed_at")
    )


def described(documents: DataFrame, types: DataFrame, page_totals: DataFrame, statuses: DataFrame) -> DataFrame:
    """Documents with the type counts, pages and status of their file names, a row per name each."""
    per_file = types.join(page_totals, "file_name", "left").join(statuses, "file_name", "left")
    return with_defaults(join_reduced(documents, per_file, "file_name", "left")).select(
        *DOCUMENT, "total_elements", "total_pages", "status", "parsed_at", "element_types"
    )


def _described(documents: DataFrame, elements: DataFrame, pages: DataFrame, log: DataFrame, how: str) -> DataFrame:
    return described(documents, type_map(elements), pages_by_file(pages), status_by_file(log, how))


def documents_overview(
    elements: DataFrame, pages: DataFrame, log: DataFrame, q: str = "", status: str = "max"
) -> DataFrame:
    """Every document that matches the search, as :func:`list_documents` describes it, unordered.

    Elements, pages and log are reduced to a row per document or file name before they are joined. Only
    the document side can repeat a file name, and does so in one last join, where it can be split.
    """
    return _described(_per_document(search(elements, q)), elements, pages, log, status)


def _behind(found: DataFrame, after: Row) -> Column:
    """Whether a document comes behind ``after`` in the order of :func:`list_documents`, where no time is last, no text first."""
    behind, tied = F.lit(False), F.lit(True)
    for name in ("parsed_at", "file_name", "source_path", "source_name"):
        value, column = F.lit(after[name]).cast(found.schema[name].dataType), F.col(name)
        if name == "parsed_at":
            beyond = F.lit(False) if after[name] is None else (column < value) | column.isNull()
        else:
            beyond = column.isNotNull() if after[name] is None else column > value
        behind, tied = behind | (tied & F.coalesce(beyond, F.lit(False))), tied & column.eqNullSafe(value)
    return behind


def pick_page(found: DataFrame, limit: int, offset: int, after: Row | None) -> tuple[list[Row], list[Column]]:
    """The documents of one page of ``found``, which has a row per document with ``parsed_at``, and the order of the list."""
    if not 1 <= limit <= MAX_LIMIT:
        raise ValueError(f"limit must be between 1 and {MAX_LIMIT}")
    if offset < 0:
        raise ValueError("offset must not be negative")
    order = [F.desc("parsed_at"), F.asc("file_name"), F.asc("source_path"), F.asc("source_name")]
    if after is not None:
        found = found.filter(_behind(found, after))
    return found.orderBy(*order).offset(offset).limit(limit).select(*DOCUMENT).collect(), order


def of_page(table: DataFrame, chosen: list[Row]) -> DataFrame:
    """Rows of the file names of a page, by a condition that reaches the Parquet reader."""
    names = {row["file_name"] for row in chosen}
    wanted = F.col("file_name").isin(sorted(names - {None}))
    return table.filter(wanted | F.col("file_name").isNull() if None in names else wanted)


def same_document(documents: DataFrame, chosen: list[Row]) -> DataFrame:
    """Those of the documents that are on the page, at most ``MAX_LIMIT``."""
    rows = documents.sparkSession.createDataFrame(chosen, ", ".join(f"{c} string" for c in DOCUMENT))
    same = reduce(and_, (documents[c].eqNullSafe(rows[c]) for c in DOCUMENT))
    return documents.join(F.broadcast(rows), same, "left_semi")


def list_documents(
    elements: DataFrame,
    pages: DataFrame,
    log: DataFrame,
    limit: int = 10,
    offset: int = 0,
    q: str = "",
    status: str = "max",
    after: Row | None = None,
) -> DataFrame:
    """One page of the document list, newest first, ties by name and path.

    ``after`` is the last row of the page before: the list goes on behind it. Unlike ``offset``, which sorts all rows it skips
    out of the way, this costs the same at any depth, and rows that appear meanwhile do not shift the pages.

    The page is picked from parse times alone, and its at most ``limit`` rows are fetched. Everything
    else is then read for just these file names, a condition that reaches the Parquet reader of all
    three tables and lets it skip what clustering has set apart.
    """
    found = search(elements, q).groupBy(*DOCUMENT).agg(F.min("parsed_at").alias("parsed_at"))
    chosen, order = pick_page(found, limit, offset, after)
    shown = of_page(elements, chosen)
    documents = same_document(_per_document(shown), chosen)
    return _described(documents, shown, of_page(pages, chosen), of_page(log, chosen), status).orderBy(*order)


class DocumentDetail(NamedTuple):
    """A document's header row, and its pages with their element counts."""

    header: DataFrame
    pages: DataFrame


def document_detail(
    elements: DataFrame, pages: DataFrame, log: DataFrame, file_name: str | None = None
) -> DocumentDetail:
    """A file's type counts, box rows, pages in order, status and last completion.

    Without a name, of every file, unordered. A file without elements is unknown and has no row.
    """
    if file_name is not None:
        elements, pages, log = (df.filter(F.col("file_name") == file_name) for df in (elements, pages, log))
    counted = type_counts(elements)
    entries = F.sort_array(F.collect_list(F.struct("element_type", "cnt")))
    by_file = counted.groupBy("file_name").agg(
        F.sum("cnt").alias("total_elements"), F.map_from_entries(entries).alias("element_types")
    )
    page_rows = pages.groupBy("file_name").agg(F.count(F.lit(1)).alias("total_pages"))
    logged = log.groupBy("file_name").agg(
        F.max("status").alias("status"),
        F.max("completed_at").cast("string").alias("parsed_at"),
        F.max("source_name").alias("source_name"),
        F.max("source_path").alias("source_path"),
    )
    header = with_defaults(
        by_file.join(page_rows, "file_name", "left").join(logged, "file_name", "left")
    ).select(*DOCUMENT, "total_elements", "total_pages", "status", "parsed_at", "element_types")

    known = elements.select("file_name").distinct()
    on_page = (
        elements.groupBy("file_name", F.col("page_id").alias("page_number"))
        .agg(F.count(F.lit(1)).alias("element_count"))
    )
    detail = with_defaults(
        join_reduced(
            join_reduced(pages.select("file_name", "page_number"), known, "file_name", "left_semi"),
            on_page,
            ["file_name", "page_number"],
            "left",
        )
    )
    return DocumentDetail(header, detail if file_name is None else detail.orderBy("page_number"))


class PageDetail(NamedTuple):
    """A page's header row, and the elements on it."""

    header: DataFrame
    elements: DataFrame


def page_detail(
    parsed: DataFrame,
    elements: DataFrame,
    pages: DataFrame,
    log: DataFrame,
    file_name: str | None = None,
    page: int | None = None,
) -> PageDetail:
    """A page's image, size and document path, and its elements in order.

    Without a name, of every file, unordered. An unknown page has no header row.
    """
    if file_name is not None:
        by_name = F.col("file_name") == file_name
        parsed, elements, pages, log = (df.filter(by_name) for df in (parsed, elements, pages, log))
    if page is not None:
        pages, elements = pages.filter(F.col("page_number") == page), elements.filter(F.col("page_id") == page)
    logged = log.groupBy("file_name").agg(F.max("source_path").alias("source_path"))
    sized = (
        pages.groupBy("file_name", "page_number")
        .agg(F.max("image_uri").alias("image_uri"))
        .join(page_dimensions(parsed, page=page), ["file_name", "page_number"], "left")
    )
    header = join_reduced(sized, logged, "file_name", "left").select(
        "file_name", "page_number", "image_uri", "source_path", "page_width", "page_height"
    )
    shown = elements if file_name is None else elements.orderBy("page_id", "element_id")
    shown = shown.select(
        "file_name",
        "page_id",
        "element_id",
        "element_type",
        "content",
        "ai_description",
        "bbox_x1",
        "bbox_y1",
        "bbox_x2",
        "bbox_y2",
        "bounding_box_json",
    )
    return PageDetail(with_defaults(header), with_defaults(shown))


def totals_or_zero(rows: DataFrame) -> DataFrame:
    """Sums of ``(metric, name, value)``; totals that no row contributes to are 0, not absent."""
    zero = rows.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(m) for m in ("documents", "elements", "pages", "completed", "failed")])).alias("metric"),
        F.lit("").alias("name"),
        F.lit(0).cast("long").alias("value"),
    )
    return rows.unionByName(zero).groupBy("metric", "name").agg(F.sum("value").alias("value"))


def corpus_stats(elements: DataFrame, pages: DataFrame, log: DataFrame) -> DataFrame:
    """Corpus totals and distributions as rows ``(metric, name, value)``.

    ``documents`` counts file names, ``elements`` box rows, ``pages`` page rows, ``completed`` and
    ``failed`` file names; ``type`` and ``source`` rows are the distributions.

    The elements are read once: they are reduced to a row per source, file and type, and the four
    element metrics are grouping sets over that.
    """
    reduced = elements.groupBy("source_name", "file_name", "element_type").agg(F.count(F.lit(1)).alias("cnt"))
    level = F.grouping_id("element_type", "source_name", "file_name")
    sets = reduced.groupingSets(
        [["element_type"], ["source_name", "file_name"], ["file_name"]], "element_type", "source_name", "file_name"
    ).agg(F.sum("cnt").alias("cnt"), level.alias("level"))
    by_type, by_file = F.col("level") == 0b011, F.col("level") == 0b110
    measures = F.array(
        F.struct(
            F.when(by_type, "type").when(by_file, "documents").otherwise("source").alias("metric"),
            F.when(by_type, F.col("element_type")).when(by_file, "").otherwise(F.col("source_name")).alias("name"),
            F.when(by_type, F.col("cnt")).otherwise(F.lit(1)).alias("value"),
        ),
        F.struct(
            F.when(by_type, "elements").alias("metric"), F.lit("").alias("name"), F.col("cnt").alias("value")
        ),
    )
    from_elements = sets.select(F.inline(measures)).filter(F.col("metric").isNotNull())
    from_pages = pages.agg(F.lit("pages").alias("metric"), F.lit("").alias("name"), F.count(F.lit(1)).alias("value"))
    files = log.filter(F.col("status").isin("completed", "failed")).select("status", "file_name").distinct()
    from_log = files.select(F.col("status").alias("metric"), F.lit("").alias("name"), F.lit(1).cast("long").alias("value"))
    return totals_or_zero(from_elements.unionByName(from_pages).unionByName(from_log))


def sample_elements(elements: DataFrame, run_id: str | None = None, n: int = 50) -> DataFrame:
    """The first ``n`` element rows by file, element and box, with a preview of their content."""
    rows = elements if run_id is None else elements.filter(F.col("pipeline_run_id") == run_id)
    return (
        rows.orderBy("file_name", "element_id", "bbox_index", "source_path", "pipeline_run_id")
        .limit(n)
        .select(
            "file_name",
            "element_id",
            "element_type",
            F.left("content", F.lit(200)).alias("content_preview"),
            "page_id",
            "bbox_index",
            "bbox_x1",
            "bbox_y1",
            "bbox_x2",
            "bbox_y2",
            "has_parse_errors",
        )
    )


def page_neighbors(pages: DataFrame) -> DataFrame:
    """Whether each page of a file has a previous and a next page."""
    total = pages.groupBy("file_name").agg(F.count(F.lit(1)).alias("page_rows"))
    return join_reduced(pages, total, "file_name", "inner").select(
        "file_name",
        "source_path",
        "page_number",
        (F.col("page_number") > 0).alias("has_previous"),
        (F.col("page_number") < F.col("page_rows") - 1).alias("has_next"),
    )


def normalize_bbox(
    elements: DataFrame, pages: DataFrame | None, width: float, height: float, infer: bool = False
) -> DataFrame:
    """Boxes clamped to their page and scaled to ``width`` × ``height``; empty ones are dropped.

    ``pages`` has ``source_path, page_number, page_width, page_height``. Without it the elements bring ``page_width`` and
    ``page_height`` themselves (``flatten_elements(page_sizes=True)``) and nothing is joined. A page of unknown size counts
    as having the target size, or with ``infer`` the size its boxes suggest.
    """

    def clamp(value: Column, low: Column, high: Column) -> Column:
        return F.least(F.greatest(value, low), high)

    sizes = None
    if pages is not None:
        elements = elements.drop("page_width", "page_height")
        sizes = pages.select("source_path", F.col("page_number").alias("page_id"), "page_width", "page_height")
    known = (F.col("page_width") > 0) & (F.col("page_height") > 0)
    fallback_width, fallback_height = F.lit(float(width)), F.lit(float(height))
    if infer:
        extent = infer_page_extent(elements, width / height).select(
            "source_path", "page_id", F.struct("page_width", "page_height").alias("extent")
        )
        sizes = extent if sizes is None else extent.join(sizes, ["source_path", "page_id"], "left")
        fallback_width = F.coalesce("extent.page_width", fallback_width)
        fallback_height = F.coalesce("extent.page_height", fallback_height)
    placed = elements if sizes is None else join_reduced(elements, sizes, ["source_path", "page_id"], "left")
    placed = placed.withColumn(
        "w", F.when(known, F.col("page_width").cast("double")).otherwise(fallback_width)
    ).withColumn("h", F.when(known, F.col("page_height").cast("double")).otherwise(fallback_height))
    zero = F.lit(0.0)
    placed = placed.withColumn("left", clamp(F.coalesce("bbox_x1", zero), zero, F.col("w"))).withColumn(
        "top", clamp(F.coalesce("bbox_y1", zero), zero, F.col("h"))
    )
    placed = placed.withColumn(
        "box_width", (clamp(F.coalesce("bbox_x2", zero), F.col("left"), F.col("w")) - F.col("left")) * width / F.col("w")
    ).withColumn(
        "box_height", (clamp(F.coalesce("bbox_y2", zero), F.col("top"), F.col("h")) - F.col("top")) * height / F.col("h")
    )
    return placed.filter((F.col("box_width") > 0) & (F.col("box_height") > 0)).select(
        "source_path",
        "page_id",
        "element_id",
        "bbox_index",
        (F.col("left") * width / F.col("w")).alias("box_x"),
        (F.col("top") * height / F.col("h")).alias("box_y"),
        "box_width",
        "box_height",
    )


def dashboard(stats: DataFrame) -> DataFrame:
    """One row with the totals of :func:`corpus_stats`, the success rate and both distributions as maps."""

    def total(metric: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("metric") == metric, F.col("value"))), F.lit(0).cast("long"))

    def distribution(metric: str) -> Column:
        entry = F.when(F.col("metric") == metric, F.struct("name", "value"))
        return F.map_from_entries(F.sort_array(F.collect_list(entry)))

    totals = {"total_documents": "documents", "total_pages": "pages", "total_elements": "elements"}
    return stats.agg(
        *[total(metric).alias(name) for name, metric in totals.items()],
        total("completed").alias("completed"),
        total("failed").alias("failed"),
        distribution("type").alias("element_type_distribution"),
        distribution("source").alias("source_distribution"),
    ).withColumn("success_rate", success_rate(F.col("completed"), F.col("failed")))
