"""From parse results to element, page and error rows.

Every operator but the path-matched page errors works inside one document's row, so none of them
shuffles. The error flag and the arrays are taken out of the payload before it is exploded; otherwise
each element row would drag a copy of the whole payload along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from doclake.functions.payload import ELEMENTS, ERRORS, PAGES, has_parse_errors, payload_field, payload_items, payload_size
from doclake.operators.joins import join_reduced
from doclake.schemas import DOCUMENT_ELEMENTS, DOCUMENT_PAGES

# The parts of a parse result that are read. Boxes are taken out of an element in a second step, since their text is kept as well.
_ELEMENT = ("id", "type", "content", "description", "bbox")
_BOX = ("page_id", "coord")
_PAGE = ("id", "image_uri")
_PAGE_SIZE = ("id", "width", "height")
_ERROR = ("page_id",)

_DOCUMENT = ["source_name", "source_path", "file_name", "parsed_at", "pipeline_run_id"]


def _exploded(df: DataFrame, array: Column, item: str, at: str = "_at", outer: bool = False) -> DataFrame:
    """``df`` with a row per array item, and its position.

    Written as an outer explode without its empty rows: for an inner one Catalyst adds a filter on the
    array's size below it, which computes the array, and with it perhaps the whole parse, once more.
    """
    exploded = df.select("*", F.posexplode_outer(array).alias(at, item))
    return exploded if outer else exploded.filter(F.col(at).isNotNull())


def _sizes_by_page(on_error: str) -> Column:
    """A parse result's page sizes as a map from page number; of several sizes of a page the largest."""
    sizes = F.transform(
        payload_items(F.col("parsed_output"), PAGES, *_PAGE_SIZE),
        lambda p: F.struct(*(payload_field(p[c], "int", on_error).alias(c) for c in _PAGE_SIZE)),
    )
    ordered = F.array_sort(F.filter(sizes, lambda p: p["id"].isNotNull()))
    # A page's sizes are neighbours now, the largest last: a size whose successor is of the same page goes.
    follows = F.slice(F.array_append(ordered, F.lit(None)), F.lit(2), F.size(ordered))
    pairs = F.zip_with(ordered, follows, lambda p, q: F.struct(p.alias("page"), q["id"].alias("next")))
    last = F.filter(pairs, lambda z: ~z["page"]["id"].eqNullSafe(z["next"]))
    return F.map_from_entries(
        F.transform(last, lambda z: F.struct(z["page"]["id"], F.struct(z["page"]["width"].alias("width"), z["page"]["height"].alias("height"))))
    )


def _of_run(df: DataFrame, run_id: str | None) -> DataFrame:
    return df if run_id is None else df.filter(F.col("pipeline_run_id") == run_id)


def flatten_elements(
    parsed: DataFrame, run_id: str | None = None, outer: bool = False, on_error: str = "raise", page_sizes: bool = False
) -> DataFrame:
    """One row per element and bounding box.

    An element whose box list is empty, missing, null or no list gives no row, or with ``outer`` one row
    without a box. A path that leads nowhere, since what it starts from has another shape, is NULL, whatever else the
    payload holds. A value that cannot be cast raises, or becomes NULL with ``on_error="null"``.

    With ``page_sizes`` each row has ``page_width`` and ``page_height`` of its page, as the same parse result tells them, NULL
    where it does not; of several sizes of a page the largest. They are looked up before the explodes, so the sizes
    themselves are not copied into every row.
    """

    documents = _of_run(parsed, run_id).select(
        *_DOCUMENT,
        has_parse_errors(F.col("parsed_output")).alias("has_parse_errors"),
        payload_items(F.col("parsed_output"), ELEMENTS, *_ELEMENT).alias("elements"),
        *([_sizes_by_page(on_error).alias("sizes")] if page_sizes else []),
    )
    found = payload_items(F.col("element.bbox"), "$", *_BOX)
    if page_sizes:

        def sized(element: Column) -> Column:
            boxes = F.transform(
                payload_items(element["bbox"], "$", *_BOX),
                lambda b: F.struct(
                    b["page_id"].alias("page_id"),
                    b["coord"].alias("coord"),
                    F.try_element_at("sizes", payload_field(b["page_id"], "int", on_error)).alias("size"),
                ),
            )
            return F.struct(*(element[c].alias(c) for c in _ELEMENT), boxes.alias("boxes"))

        documents = documents.withColumn("elements", F.transform("elements", sized)).drop("sizes")
        found = F.col("element.boxes")
    elements = _exploded(documents, F.col("elements"), "element").drop("elements", "_at")
    boxes = _exploded(elements, found, "box", "bbox_index", outer)
    coords = F.try_variant_get("box.coord", "$", "array<variant>")
    corners = [
        payload_field(F.get(coords, F.lit(i)), "int", on_error).alias(f"bbox_{name}") for i, name in enumerate(("x1", "y1", "x2", "y2"))
    ]
    return boxes.select(
        *_DOCUMENT,
        payload_field(F.col("element.id"), "int", on_error).alias("element_id"),
        payload_field(F.col("element.type"), "string", on_error).alias("element_type"),
        payload_field(F.col("element.content"), "string", on_error).alias("content"),
        payload_field(F.col("element.description"), "string", on_error).alias("ai_description"),
        F.to_json("element.bbox").alias("bounding_box_json"),
        payload_field(F.col("box.page_id"), "int", on_error).alias("page_id"),
        "bbox_index",
        *corners,
        "has_parse_errors",
        *([F.col(f"box.size.{c}").alias(f"page_{c}") for c in ("width", "height")] if page_sizes else []),
    ).select(*DOCUMENT_ELEMENTS.names, *(["page_width", "page_height"] if page_sizes else []))


def flatten_errors(parsed: DataFrame, run_id: str | None = None, on_error: str = "raise") -> DataFrame:
    """One row per reported page error."""
    documents = _of_run(parsed, run_id).select(
        "source_path",
        "pipeline_run_id",
        payload_items(F.col("parsed_output"), ERRORS, *_ERROR).alias("errors"),
    )
    page = payload_field(F.col("error.page_id"), "int", on_error).alias("page_id")
    return _exploded(documents, F.col("errors"), "error").select("source_path", page, "pipeline_run_id")


def flatten_pages(
    parsed: DataFrame,
    run_id: str | None = None,
    distinct_errors: bool = False,
    match: str = "document",
    on_error: str = "raise",
) -> DataFrame:
    """One row per page, repeated for each error reported on it unless ``distinct_errors``.

    ``match="document"`` looks errors up in the page's own payload and needs no shuffle. With
    ``match="path"`` they come from every result of the run for the same path, which differs only if
    a run holds several results for one path.
    """
    documents = _of_run(parsed, run_id).select(
        *_DOCUMENT,
        has_parse_errors(F.col("parsed_output")).alias("has_parse_errors"),
        F.transform(
            payload_items(F.col("parsed_output"), ERRORS, *_ERROR), lambda e: payload_field(e["page_id"], "int", on_error)
        ).alias("errors"),
        payload_items(F.col("parsed_output"), PAGES, *_PAGE).alias("pages"),
    )
    pages = _exploded(documents, F.col("pages"), "page").select(
        *_DOCUMENT,
        "has_parse_errors",
        "errors",
        payload_field(F.col("page.id"), "int", on_error).alias("page_number"),
        payload_field(F.col("page.image_uri"), "string", on_error).alias("image_uri"),
    )
    if match == "document":
        hits = F.array_size(F.filter("errors", lambda page_id: page_id == F.col("page_number")))
        pages = pages.withColumn("hits", hits)
    elif match == "path":
        key = ["source_path", "pipeline_run_id", "page_number"]
        errors = flatten_errors(parsed, run_id, on_error).withColumnRenamed("page_id", "page_number")
        pages = join_reduced(pages, errors.groupBy(*key).agg(F.count(F.lit(1)).alias("hits")), key, "left")
    else:
        raise ValueError("match must be 'document' or 'path'")
    flagged = pages.withColumn("page_has_error", F.coalesce(F.col("hits") > 0, F.lit(False)))
    if not distinct_errors:
        copies = F.sequence(F.lit(1).cast("long"), F.greatest(F.lit(1), "hits").cast("long"))
        flagged = flagged.select("*", F.explode_outer(copies).alias("_copy"))
    return flagged.select(*DOCUMENT_PAGES.names)


def payload_sizes(parsed: DataFrame, run_id: str | None = None) -> DataFrame:
    """Lengths of a document's element and page arrays; NULL where the array is missing."""
    return _of_run(parsed, run_id).select(
        "source_path",
        "pipeline_run_id",
        payload_size(F.col("parsed_output"), ELEMENTS).alias("elements_extracted"),
        payload_size(F.col("parsed_output"), PAGES).alias("pages_parsed"),
    )


def page_dimensions(
    parsed: DataFrame,
    file_name: str | None = None,
    page: int | None = None,
    key: str = "file_name",
    on_error: str = "raise",
) -> DataFrame:
    """Width and height of each page of a file, or of all, as last parsed.

    Pages are told apart by file name, as the page view does, or by ``key="source_path"``.
    """
    if file_name is not None:
        parsed = parsed.filter(F.col("file_name") == file_name)
    documents = parsed.select(
        *_DOCUMENT, payload_items(F.col("parsed_output"), PAGES, *_PAGE_SIZE).alias("pages")
    )
    sizes = _exploded(documents, F.col("pages"), "page").select(
        "file_name",
        "source_path",
        "parsed_at",
        "pipeline_run_id",
        payload_field(F.col("page.id"), "int", on_error).alias("page_number"),
        payload_field(F.col("page.width"), "int", on_error).alias("page_width"),
        payload_field(F.col("page.height"), "int", on_error).alias("page_height"),
    )
    if page is not None:
        sizes = sizes.filter(F.col("page_number") == page)
    latest = F.max(F.struct("parsed_at", "source_path", "pipeline_run_id", "page_width", "page_height"))
    return (
        sizes.groupBy(key, "page_number")
        .agg(latest.alias("latest"))
        .select(key, "page_number", "latest.page_width", "latest.page_height")
    )


def replace_documents(target: DataFrame, new: DataFrame, key: str = "source_path", documents: DataFrame | None = None) -> DataFrame:
    """``target`` with all rows of the re-processed documents replaced by ``new``.

    ``documents`` names them where a document may have no new row; by default those of ``new``.
    """
    replaced = (new if documents is None else documents).select(key).distinct()
    return join_reduced(target, replaced, key, "left_anti").select(*target.columns).unionByName(new)


def current_rows(rows: DataFrame, parsed: DataFrame) -> DataFrame:
    """Rows of each document's latest parse, where every run appended its own.

    The same result as replacing on every run, without rewriting the table.
    """
    latest = parsed.groupBy("source_path").agg(
        F.max(F.struct("parsed_at", "pipeline_run_id")).alias("latest")
    ).select("source_path", "latest.pipeline_run_id")
    return join_reduced(rows, latest, ["source_path", "pipeline_run_id"], "left_semi").select(*rows.columns)


def superseded_pairs(earlier: DataFrame, documents: DataFrame) -> DataFrame:
    """The (path, run) pairs of ``earlier`` whose document is among ``documents``: what a run that parsed those replaces."""
    paths = documents.select("source_path").distinct()
    pairs = earlier.select("source_path", "pipeline_run_id").distinct()
    return join_reduced(pairs, paths, "source_path", "left_semi")


def without_superseded(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """``rows`` without those of the superseded (path, run) pairs.

    The same rows as :func:`current_rows` leaves, at the price of the pairs alone: they number the documents parsed again.
    """
    return join_reduced(rows, pairs.distinct(), ["source_path", "pipeline_run_id"], "left_anti").select(*rows.columns)
