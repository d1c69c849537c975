"""One query per operator over the given tables; :mod:`checks.oracle` holds the SQL for each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from checks import fixtures as fx
from doclake.functions import content_hash, document_id, log_id, matches_pattern, mb, preview, strip_scheme
from doclake.functions.payload import ELEMENTS, has_parse_errors, payload_size
from doclake.operators import aggregates as agg
from doclake.operators import batching, documents, flatten, incremental, parse, registry, runlog, summaries
from doclake.operators.layout import html_element_type, html_parts
from doclake.sources import (
    assign_staging_path,
    files_from_blob_manifest,
    files_from_library_manifest,
    files_from_tree_manifest,
    load_raw,
    stage_with_isolation,
)

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

PATTERNS = {
    "any_of": "*.{pdf, docx}",
    "upper_any_of": "*.{PDF}",
    "suffix": "*.pdf",
    "prefix": "SRC1*",
    "class": "src[0-4]/*",
    "negated": "src[!0-4]*/e?/*",
    "all": "*",
}


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _text(name: str) -> Column:
    return F.col(name).cast("string").alias(name)


def _stamps(df: DataFrame) -> DataFrame:
    """Timestamps as text, so results compare alike in any session."""
    return df.select(*[_text(f.name) if f.dataType.typeName() == "timestamp" else F.col(f.name) for f in df.schema])


def _map_text(name: str) -> Column:
    entries = F.array_sort(F.map_entries(name))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ";").alias(name)


def _elements(spark: SparkSession, sf: str) -> DataFrame:
    return flatten.flatten_elements(fx.parsed(spark, sf))


def _pages(spark: SparkSession, sf: str) -> DataFrame:
    return flatten.flatten_pages(fx.parsed(spark, sf))


# Sources


@query
def src2_name_patterns(spark: SparkSession, sf: str) -> DataFrame:
    return fx.blob_manifest(spark, sf).select(
        "name", *[matches_pattern(F.col("name"), p).alias(n) for n, p in PATTERNS.items()]
    )


@query
def src3_blob_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return files_from_blob_manifest(fx.blob_manifest(spark, sf), [""], "*.{pdf,docx}", True, "docs", "acct").drop("metadata")


@query
def src3_blob_manifest_roots(spark: SparkSession, sf: str) -> DataFrame:
    """Overlapping prefixes list a file once for each."""
    prefixes = ["src1", "src1/en", "src2/en"]
    return files_from_blob_manifest(fx.blob_manifest(spark, sf), prefixes, "*", True, "docs", "acct").drop("metadata")


@query
def src3_blob_manifest_flat(spark: SparkSession, sf: str) -> DataFrame:
    prefixes = ["src1/en", "src2"]
    return files_from_blob_manifest(fx.blob_manifest(spark, sf), prefixes, "*", False, "docs", "acct").drop("metadata")


@query
def src4_tree_manifest(spark: SparkSession, sf: str) -> DataFrame:
    files = files_from_tree_manifest(fx.tree_manifest(spark, sf), ["root"], "*.{pdf,docx,pptx}")
    return files.select("original_path", "file_name", "file_size_bytes", F.col("metadata")["mime_type"].alias("mime_type"))


@query
def src4_tree_manifest_roots(spark: SparkSession, sf: str) -> DataFrame:
    """A root inside another root lists its files twice."""
    return files_from_tree_manifest(fx.tree_manifest(spark, sf), ["root", "src3", "src3-en"]).drop("metadata")


@query
def src5_library_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return files_from_library_manifest(fx.library_manifest(spark, sf), [""], "*.pdf").drop("metadata")


@query
def src5_library_manifest_folders(spark: SparkSession, sf: str) -> DataFrame:
    return files_from_library_manifest(fx.library_manifest(spark, sf), ["src1", "src1/en"], "*").drop("metadata")


@query
def src5_library_manifest_flat(spark: SparkSession, sf: str) -> DataFrame:
    return files_from_library_manifest(fx.library_manifest(spark, sf), ["", "src2/de"], "*", False).drop("metadata")


@query
def src8_strip_scheme(spark: SparkSession, sf: str) -> DataFrame:
    urls = fx.table(spark, sf, "pages").select("page_id", F.concat(F.lit("dbfs:dbfs:"), "url").alias("listed"))
    return urls.select("page_id", strip_scheme(F.col("listed")).alias("path"))


@query
def src9_staging_paths(spark: SparkSession, sf: str) -> DataFrame:
    """Every document of a source and language wants the same name."""
    listing = fx.files(spark, sf)
    wanted = listing.select("source_name", "original_path", F.concat("lang", F.lit(".txt")).alias("file_name"), "content_hash")
    name = F.when(F.col("quality") == 1, F.concat("lang", F.lit(".txt"))).otherwise(F.lit("old.txt"))
    before = listing.filter(F.col("quality").isNotNull()).select(
        "source_name", "original_path", F.concat(F.lit("/old"), "original_path").alias("staging_path"), name.alias("file_name")
    )
    return assign_staging_path(wanted, before, "/staging").select("source_name", "original_path", "staging_path", "file_name")


@query
def src10_load_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Every synced document loaded by a fetch function; what cannot be read keeps its row and says why."""
    chosen = fx.raw(spark, sf).withColumn("original_path", F.col("source_path"))
    loaded = load_raw(chosen, "run_load", "2024-03-01 00:00:00", on_unreadable="failed", fetch=fx.fetched)
    return loaded.select(
        "source_name", "source_path", "file_name", "file_size_bytes", F.length("content").cast("long").alias("bytes"),
        "content_hash", _text("ingested_at"), "pipeline_run_id", "read_error",
    )


@query
def run5_stage_with_isolation(spark: SparkSession, sf: str) -> DataFrame:
    """Every document hashed through a fetch function; each file's failure is its own."""
    return stage_with_isolation(fx.files(spark, sf), fx.fetched)


# Registry


@query
def snk5_registry_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return _stamps(registry.upsert(fx.registry(spark, sf), fx.resync(spark, sf)))


@query
def snk5_registry_log(spark: SparkSession, sf: str) -> DataFrame:
    """The same upsert as a log: a first delta, what the later sync adds to it, and both merged on reading."""
    first = fx.registry(spark, sf).withColumn("seen_only", F.lit(False))
    later = registry.registry_delta(fx.registry(spark, sf), fx.resync(spark, sf))
    deltas = first.withColumn("order", F.lit(0)).unionByName(later.withColumn("order", F.lit(1)))
    return _stamps(registry.merge_deltas(deltas))


@query
def snk6_dedupe_latest(spark: SparkSession, sf: str) -> DataFrame:
    latest = registry.dedupe_latest(fx.registry(spark, sf), ["content_hash"], ["synced_at"])
    return _stamps(latest.select("content_hash", "document_id", "source_name", "synced_at", "sync_error"))


def _french_again(spark: SparkSession, sf: str) -> DataFrame:
    """The French run repeated a day later, with the plain text layout."""
    texts = fx.table(spark, sf, "documents").filter(F.col("lang") == "fr")
    return _parse_texts(texts, F.lit("run_fr_again"), parse.text_extractor())


def _parse_texts(texts: DataFrame, run_id: Column, extractor: parse.ColumnExtractor) -> DataFrame:
    raw = texts.select(
        F.col("source").alias("source_name"),
        fx._path().alias("source_path"),
        fx._file_name().alias("file_name"),
        F.encode("text", "UTF-8").alias("content"),
        F.md5("text").alias("content_hash"),
        run_id.alias("pipeline_run_id"),
        F.lit(1).alias("batch_id"),
    )
    return parse.parse_documents(raw, extractor, parsed_at="2024-02-01 00:00:00").drop("content_hash", "batch_id")


_ROW = ["source_path", "element_id", "bbox_index", "element_type", "page_id", "pipeline_run_id"]


@query
def snk7_replace_documents(spark: SparkSession, sf: str) -> DataFrame:
    again = _french_again(spark, sf)
    new = flatten.flatten_elements(again)
    return flatten.replace_documents(_elements(spark, sf), new, documents=again).select(*_ROW)


@query
def snk7_current_rows(spark: SparkSession, sf: str) -> DataFrame:
    parsed = fx.parsed(spark, sf)
    again = _french_again(spark, sf)
    rows = flatten.flatten_elements(parsed).unionByName(flatten.flatten_elements(again))
    index = ["source_path", "parsed_at", "pipeline_run_id"]
    return flatten.current_rows(rows, parsed.select(*index).unionByName(again.select(*index))).select(*_ROW)


@query
def snk7_superseded_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Current rows by the pairs that the later run supersedes."""
    parsed = fx.parsed(spark, sf)
    again = _french_again(spark, sf)
    pairs = flatten.superseded_pairs(parsed, again)
    earlier = flatten.without_superseded(flatten.flatten_elements(parsed), pairs)
    return earlier.unionByName(flatten.flatten_elements(again)).select(*_ROW)


@query
def prj1_document_ids(spark: SparkSession, sf: str) -> DataFrame:
    listed = fx.table(spark, sf, "documents").select("doc_id", "source", fx._path().alias("path"))
    return listed.select(
        "doc_id",
        document_id(F.col("source"), F.col("path")).alias("registry_id"),
        log_id(F.col("path")).alias("log_id"),
    )


@query
def prj2_content_hash(spark: SparkSession, sf: str) -> DataFrame:
    """Each document as bytes, and once more as an unreadable file."""
    content = fx.table(spark, sf, "documents").select("doc_id", F.encode("text", "UTF-8").alias("content"))
    return content.select(
        "doc_id",
        content_hash(F.col("content")).alias("md5_hash"),
        content_hash(F.col("content"), "sha256").alias("sha256_hash"),
        content_hash(F.lit(None).cast("binary")).alias("unreadable_hash"),
    )


@query
def prj3_registry_rows(spark: SparkSession, sf: str) -> DataFrame:
    listing = fx.files(spark, sf)
    rows = registry.registry_rows(listing, fx.staged(listing), "run_1", F.to_timestamp(F.lit("2024-03-01 00:00:00")))
    return _stamps(rows)


@query
def prj4_synced_in_run(spark: SparkSession, sf: str) -> DataFrame:
    return registry.synced_in_run(fx.registry(spark, sf), "run_en").select("document_id", "staging_path", "pipeline_run_id")


@query
def prj6_open_log(spark: SparkSession, sf: str) -> DataFrame:
    return _stamps(runlog.open_log(fx.raw(spark, sf), F.to_timestamp(F.lit("2024-03-01 00:00:00"))))


# Incremental filter


@query
def jon1_not_yet_parsed_registry_hash(spark: SparkSession, sf: str) -> DataFrame:
    new = incremental.not_yet_parsed(fx.registry(spark, sf), fx.parsed_before(spark, sf), mode="registry_hash")
    return new.select("document_id", "staging_path", "content_hash", "pipeline_run_id")


@query
def jon2_not_yet_parsed_parsed_hash(spark: SparkSession, sf: str) -> DataFrame:
    new = incremental.not_yet_parsed(fx.registry(spark, sf), fx.parsed_before(spark, sf))
    return new.select("document_id", "staging_path", "content_hash", "pipeline_run_id")


@query
def jon2_one_per_content(spark: SparkSession, sf: str) -> DataFrame:
    new = incremental.not_yet_parsed(fx.registry(spark, sf), fx.parsed_before(spark, sf))
    return incremental.one_per_content(new).select("staging_path", "content_hash")


@query
def set2_distinct_hashes(spark: SparkSession, sf: str) -> DataFrame:
    return fx.registry(spark, sf).select("content_hash").filter(F.col("content_hash").isNotNull()).distinct()


@query
def set1_union_of_roots(spark: SparkSession, sf: str) -> DataFrame:
    """Listings of three kinds of source as one."""
    listings = [
        files_from_blob_manifest(fx.blob_manifest(spark, sf), [""], "*.pdf", True, "docs", "acct"),
        files_from_library_manifest(fx.library_manifest(spark, sf), [""], "*.pdf"),
        files_from_tree_manifest(fx.tree_manifest(spark, sf), ["root"], "*.pdf"),
    ]
    union = listings[0].unionByName(listings[1]).unionByName(listings[2])
    return union.select("original_path", "file_name", "file_size_bytes")


# Payload to rows


@query
def flt1_flatten_elements(spark: SparkSession, sf: str) -> DataFrame:
    return _stamps(_elements(spark, sf))


@query
def flt1_flatten_elements_outer(spark: SparkSession, sf: str) -> DataFrame:
    """Elements without a box are kept."""
    return flatten.flatten_elements(fx.parsed(spark, sf), outer=True).select(*_ROW, "bbox_x1", "bounding_box_json")


@query
def flt2_flatten_pages(spark: SparkSession, sf: str) -> DataFrame:
    return _stamps(_pages(spark, sf))


@query
def flt2_flatten_pages_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return _stamps(flatten.flatten_pages(fx.parsed(spark, sf), distinct_errors=True))


@query
def flt2_flatten_pages_by_path(spark: SparkSession, sf: str) -> DataFrame:
    return _stamps(flatten.flatten_pages(fx.parsed(spark, sf), match="path"))


@query
def flt3_flatten_errors(spark: SparkSession, sf: str) -> DataFrame:
    return flatten.flatten_errors(fx.parsed(spark, sf))


@query
def flt4_payload_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return flatten.payload_sizes(fx.parsed(spark, sf))


@query
def flt5_page_dimensions(spark: SparkSession, sf: str) -> DataFrame:
    return flatten.page_dimensions(fx.parsed(spark, sf))


def _both_modes(spark: SparkSession, sf: str, flattened: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """Strict casts over payloads of odd shapes, and lenient ones over payloads that hold values of no use as well."""
    strict = flattened(fx.mixed_parsed(spark, sf, False), "raise").withColumn("mode", F.lit("raise"))
    return strict.unionByName(flattened(fx.mixed_parsed(spark, sf, True), "null").withColumn("mode", F.lit("null")))


@query
def flt1_mixed_payloads(spark: SparkSession, sf: str) -> DataFrame:
    found = _both_modes(spark, sf, lambda parsed, mode: flatten.flatten_elements(parsed, outer=True, on_error=mode))
    corners = [f"bbox_{c}" for c in ("x1", "y1", "x2", "y2")]
    return found.select(
        "mode", "source_path", "element_id", "element_type", "content", "ai_description", "page_id", "bbox_index", *corners, "has_parse_errors"
    )


@query
def flt2_mixed_payloads(spark: SparkSession, sf: str) -> DataFrame:
    found = _both_modes(spark, sf, lambda parsed, mode: flatten.flatten_pages(parsed, on_error=mode))
    return found.select("mode", "source_path", "page_number", "image_uri", "has_parse_errors", "page_has_error")


@query
def flt3_mixed_payloads(spark: SparkSession, sf: str) -> DataFrame:
    return _both_modes(spark, sf, lambda parsed, mode: flatten.flatten_errors(parsed, on_error=mode))


# Extractors

_LAYOUT = ["source_path", "element_id", "element_type", "content", "page_id", "bbox_y1", "bbox_x2", "bounding_box_json"]


@query
def udf1_parse_documents_text(spark: SparkSession, sf: str) -> DataFrame:
    parsed = _parse_texts(fx.table(spark, sf, "documents"), F.lit("run_1"), parse.text_extractor())
    return flatten.flatten_elements(parsed).select(*_LAYOUT)


def _line_parser(too_long: int | None = None) -> Callable[[], parse.DocumentExtractor]:
    """The text layout as a Python parser, one that fails on documents of more bytes than ``too_long``."""

    def load():
        def lines_of(content, options):
            if too_long is not None and len(content) > too_long:
                raise ValueError("too long")
            elements = [
                {
                    "id": at,
                    "type": "text" if at else "title",
                    "content": line,
                    "bbox": [
                        {
                            "page_id": at // 12,
                            "coord": [50, 40 + at % 12 * 60, 50 + min(len(line), 500), 80 + at % 12 * 60],
                        }
                    ],
                }
                for at, line in enumerate(content.decode("utf-8").split("\n"))
            ]
            return {"document": {"elements": elements, "pages": []}, "error_status": []}

        return lines_of

    return load


@query
def udf1_parse_documents_python(spark: SparkSession, sf: str) -> DataFrame:
    extractor = parse.python_extractor(_line_parser(), on_error="status")
    parsed = _parse_texts(fx.table(spark, sf, "documents"), F.lit("run_1"), extractor)
    return flatten.flatten_elements(parsed).select(*_LAYOUT)


@query
def udf2_layout_from_text_sizes(spark: SparkSession, sf: str) -> DataFrame:
    parsed = _parse_texts(fx.table(spark, sf, "documents"), F.lit("run_1"), parse.text_extractor(lines_per_page=5))
    return flatten.payload_sizes(parsed)


@query
def udf3_layout_from_html(spark: SparkSession, sf: str) -> DataFrame:
    pages = fx.table(spark, sf, "pages").select(
        F.lit("web").alias("source_name"),
        F.col("url").alias("source_path"),
        F.col("page_id").cast("string").alias("file_name"),
        F.encode("html", "UTF-8").alias("content"),
        F.md5("html").alias("content_hash"),
        F.lit("run_web").alias("pipeline_run_id"),
        F.lit(1).alias("batch_id"),
    )
    parsed = parse.parse_documents(pages, parse.html_extractor(), parsed_at="2024-02-01 00:00:00")
    return flatten.flatten_elements(parsed).select("file_name", *_LAYOUT[1:])


@query
def udf3_html_parts(spark: SparkSession, sf: str) -> DataFrame:
    parts = fx.table(spark, sf, "pages").select("page_id", F.posexplode(html_parts(F.col("html"))).alias("pos", "part"))
    return parts.select("page_id", "pos", "part.tag", html_element_type(F.col("part.tag")).alias("element_type"), "part.body")


@query
def udf4_failed_documents(spark: SparkSession, sf: str) -> DataFrame:
    """A parser that fails on long documents: they get an error entry, the others their rows."""
    extractor = parse.python_extractor(_line_parser(too_long=5000), on_error="status")
    parsed = _parse_texts(fx.table(spark, sf, "documents"), F.lit("run_1"), extractor)
    sizes = flatten.payload_sizes(parsed).select("source_path", "elements_extracted")
    failed = flatten.flatten_errors(parsed).groupBy("source_path").agg(F.count(F.lit(1)).alias("errors"))
    return sizes.join(failed, "source_path", "left").select("source_path", "elements_extracted", F.coalesce("errors", F.lit(0)).alias("errors"))


@query
def udf4_bad_encoding(spark: SparkSession, sf: str) -> DataFrame:
    """Texts that end in a byte that is not UTF-8 get an error entry and keep their lines; the others are as ever."""
    texts = fx.table(spark, sf, "documents")
    content = F.encode("text", "UTF-8")
    content = F.when(F.col("doc_id") % 7 == 0, F.concat(content, F.lit(bytearray(b"\xff")))).otherwise(content)
    payload = parse.text_extractor()(content, parse.parse_options())
    parsed = texts.select(fx._path().alias("source_path"), payload.alias("parsed_output"))
    return parsed.select(
        "source_path",
        payload_size(F.col("parsed_output"), ELEMENTS).alias("elements"),
        has_parse_errors(F.col("parsed_output")).alias("has_errors"),
    )


# Ranks and batches


@query
def win1_global_rank(spark: SparkSession, sf: str) -> DataFrame:
    return batching.global_rank(fx.raw(spark, sf)).select("source_path", "file_size_bytes", "rn")


@query
def win2_round_robin_batches(spark: SparkSession, sf: str) -> DataFrame:
    return batching.assign_batches(fx.raw(spark, sf), 40).select("source_path", "file_size_bytes", "batch_id")


@query
def win3_contiguous_batches(spark: SparkSession, sf: str) -> DataFrame:
    return batching.assign_batches(fx.raw(spark, sf), 50, "contiguous").select("source_path", "file_size_bytes", "batch_id")


@query
def agg5_batch_balance(spark: SparkSession, sf: str) -> DataFrame:
    return batching.batch_balance(batching.assign_batches(fx.raw(spark, sf), 40))


@query
def win4_top_types(spark: SparkSession, sf: str) -> DataFrame:
    return agg.top_types(_elements(spark, sf), 3)


# Log


@query
def jon4_log_transition(spark: SparkSession, sf: str) -> DataFrame:
    unfinished = fx.log(spark, sf).filter(F.col("status") == "processing").select("source_path")
    changed = runlog.log_transition(
        fx.log(spark, sf), unfinished, "run_en", status=F.lit("failed"), attempt_number=F.lit(3), error_message=F.lit("it's late")
    )
    return _stamps(changed.drop("started_at"))


@query
def jon5_apply_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Array sizes first, then rows written; a document without rows keeps its array sizes."""
    parsed = fx.parsed(spark, sf)
    log = runlog.apply_counts(fx.log(spark, sf), flatten.payload_sizes(parsed), ["elements_extracted", "pages_parsed"])
    elements = agg.row_counts(flatten.flatten_elements(parsed), "elements_extracted")
    pages = agg.row_counts(flatten.flatten_pages(parsed), "pages_parsed")
    log = runlog.apply_counts(runlog.apply_counts(log, elements, ["elements_extracted"]), pages, ["pages_parsed"])
    return log.select("source_path", "status", "elements_extracted", "pages_parsed", "pipeline_run_id")


@query
def run4_fold_log(spark: SparkSession, sf: str) -> DataFrame:
    return _stamps(runlog.fold_log(fx.log_event_rows(spark, sf)))


@query
def run6_retry_stats(spark: SparkSession, sf: str) -> DataFrame:
    return runlog.retry_stats(fx.attempts(spark, sf))


# Aggregates


@query
def agg1_sync_summary(spark: SparkSession, sf: str) -> DataFrame:
    broken = fx.table(spark, sf, "pages").select(F.element_at(F.split("url", "/"), 3).alias("source_name")).distinct()
    return registry.sync_summary(fx.registry(spark, sf), broken)


@query
def agg2_ingest_summary(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.registry(spark, sf)
    return incremental.ingest_summary(rows, incremental.not_yet_parsed(rows, fx.parsed_before(spark, sf)))


@query
def agg3_docs_per_source(spark: SparkSession, sf: str) -> DataFrame:
    return agg.docs_per_source(fx.raw(spark, sf))


@query
def agg4_total_bytes(spark: SparkSession, sf: str) -> DataFrame:
    return agg.total_bytes(fx.raw(spark, sf))


@query
def prj15_megabytes(spark: SparkSession, sf: str) -> DataFrame:
    sizes = fx.raw(spark, sf).groupBy("source_name").agg(F.sum("file_size_bytes").alias("bytes"))
    return sizes.select("source_name", mb(F.col("bytes")).alias("megabytes"))


@query
def agg6_parse_summary(spark: SparkSession, sf: str) -> DataFrame:
    return agg.parse_summary(fx.parsed(spark, sf), fx.log(spark, sf))


@query
def agg7_element_rows(spark: SparkSession, sf: str) -> DataFrame:
    return agg.row_counts(_elements(spark, sf))


@query
def agg7_page_rows(spark: SparkSession, sf: str) -> DataFrame:
    return agg.row_counts(_pages(spark, sf))


@query
def agg8_type_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return agg.type_distribution(_elements(spark, sf))


@query
def agg8_type_distribution_of_run(spark: SparkSession, sf: str) -> DataFrame:
    return agg.type_distribution(_elements(spark, sf), "run_en")


@query
def agg9_distinct_docs(spark: SparkSession, sf: str) -> DataFrame:
    return agg.distinct_docs(_elements(spark, sf))


@query
def agg10_status_counts(spark: SparkSession, sf: str) -> DataFrame:
    return agg.status_counts(fx.log(spark, sf))


@query
def agg11_element_rows_per_run(spark: SparkSession, sf: str) -> DataFrame:
    return agg.run_rows(_elements(spark, sf))


@query
def agg11_page_rows_per_run(spark: SparkSession, sf: str) -> DataFrame:
    return agg.run_rows(_pages(spark, sf))


@query
def agg12_type_map(spark: SparkSession, sf: str) -> DataFrame:
    return agg.type_map(_elements(spark, sf)).select("file_name", _map_text("element_types"))


@query
def jon10_type_counts_of_files(spark: SparkSession, sf: str) -> DataFrame:
    failed = fx.log(spark, sf).filter(F.col("status") == "failed").select("file_name")
    return agg.type_counts(_elements(spark, sf), failed)


@query
def agg13_status_by_file(spark: SparkSession, sf: str) -> DataFrame:
    return agg.status_by_file(fx.log(spark, sf))


@query
def agg13_latest_status_by_file(spark: SparkSession, sf: str) -> DataFrame:
    return agg.status_by_file(fx.log(spark, sf), "latest")


@query
def agg14_files_per_status(spark: SparkSession, sf: str) -> DataFrame:
    return agg.files_per_status(fx.log(spark, sf))


@query
def agg15_files_per_source(spark: SparkSession, sf: str) -> DataFrame:
    return agg.files_per_source(_elements(spark, sf))


@query
def agg16_success_rate(spark: SparkSession, sf: str) -> DataFrame:
    return agg.success_rates(fx.log(spark, sf))


@query
def agg17_share_of_max(spark: SparkSession, sf: str) -> DataFrame:
    shares = agg.share_of_max(agg.type_distribution(_elements(spark, sf)))
    return shares.select("element_type", "cnt", F.round("share", 6).alias("share"))


@query
def agg18_page_extent(spark: SparkSession, sf: str) -> DataFrame:
    extent = agg.infer_page_extent(_elements(spark, sf), 0.75)
    return extent.select("source_path", "page_id", *[F.round(c, 6).alias(c) for c in ("page_width", "page_height")])


# Document queries


def _corpus(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return _elements(spark, sf), _pages(spark, sf), fx.log(spark, sf)


def _list_row(df: DataFrame) -> DataFrame:
    return df.withColumn("element_types", _map_text("element_types"))


@query
def qry1_documents_overview(spark: SparkSession, sf: str) -> DataFrame:
    return _list_row(documents.documents_overview(*_corpus(spark, sf)))


@query
def qry1_documents_overview_latest(spark: SparkSession, sf: str) -> DataFrame:
    return _list_row(documents.documents_overview(*_corpus(spark, sf), q="SRC1", status="latest"))


@query
def qry1_list_documents(spark: SparkSession, sf: str) -> DataFrame:
    return _list_row(documents.list_documents(*_corpus(spark, sf), limit=25))


@query
def qry1_list_documents_after(spark: SparkSession, sf: str) -> DataFrame:
    """The second page of the list, by the last row of the first."""
    corpus = _corpus(spark, sf)
    last = documents.list_documents(*corpus, limit=25).tail(1)
    return _list_row(documents.list_documents(*corpus, limit=25, after=last[0] if last else None))


@query
def qry1_list_documents_search(spark: SparkSession, sf: str) -> DataFrame:
    return _list_row(documents.list_documents(*_corpus(spark, sf), limit=10, offset=10, q="C_1%5"))


def _summaries(spark: SparkSession, sf: str) -> DataFrame:
    return summaries.summarize(_elements(spark, sf), _pages(spark, sf))


@query
def qry1_summarized_overview(spark: SparkSession, sf: str) -> DataFrame:
    """The document list from a row per document."""
    return _list_row(summaries.summarized_overview(_summaries(spark, sf), fx.log(spark, sf)))


@query
def qry1_summarized_list_search(spark: SparkSession, sf: str) -> DataFrame:
    return _list_row(summaries.summarized_list(_summaries(spark, sf), fx.log(spark, sf), limit=10, offset=10, q="C_1%5"))


@query
def qry1_count_documents(spark: SparkSession, sf: str) -> DataFrame:
    return documents.count_documents(_elements(spark, sf), "sRc_1")


@query
def prj11_search(spark: SparkSession, sf: str) -> DataFrame:
    """A wildcard search, and a literal one that the same text fails."""
    rows = fx.registry(spark, sf)
    wild = documents.search(rows, "src%_7").withColumn("how", F.lit("wildcard"))
    literal = documents.search(rows, "C_1", literal=True).withColumn("how", F.lit("literal"))
    return wild.unionByName(literal).select("how", "source_name", "file_name", "original_path")


@query
def qry2_document_headers(spark: SparkSession, sf: str) -> DataFrame:
    return _list_row(documents.document_detail(*_corpus(spark, sf)).header)


@query
def qry2_document_pages(spark: SparkSession, sf: str) -> DataFrame:
    return documents.document_detail(*_corpus(spark, sf)).pages


@query
def qry2_one_document(spark: SparkSession, sf: str) -> DataFrame:
    return _list_row(documents.document_detail(*_corpus(spark, sf), file_name="doc_7.txt").header)


@query
def qry3_one_page(spark: SparkSession, sf: str) -> DataFrame:
    return documents.page_detail(fx.parsed(spark, sf), *_corpus(spark, sf), file_name="doc_7.txt", page=0).elements


@query
def qry3_page_headers(spark: SparkSession, sf: str) -> DataFrame:
    return documents.page_detail(fx.parsed(spark, sf), *_corpus(spark, sf)).header


@query
def qry3_page_elements(spark: SparkSession, sf: str) -> DataFrame:
    return documents.page_detail(fx.parsed(spark, sf), *_corpus(spark, sf)).elements


@query
def prj12_defaults(spark: SparkSession, sf: str) -> DataFrame:
    rows = flatten.flatten_elements(fx.parsed(spark, sf), outer=True)
    return documents.with_defaults(rows).select("source_path", "element_id", "bbox_index", "content", "bbox_x1", "bbox_y2", "bounding_box_json")


@query
def prj13_preview(spark: SparkSession, sf: str) -> DataFrame:
    long, short = preview(F.col("content"), F.col("ai_description"), 300), preview(F.col("content"), F.col("ai_description"), 200, True)
    return _elements(spark, sf).select("source_path", "element_id", "bbox_index", long.alias("panel"), short.alias("tooltip"))


def _sizes(spark: SparkSession, sf: str) -> DataFrame:
    return flatten.page_dimensions(fx.parsed(spark, sf), key="source_path")


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(
        "source_path", "page_id", "element_id", "bbox_index", *[F.round(c, 6).alias(c) for c in ("box_x", "box_y", "box_width", "box_height")]
    )


@query
def prj14_normalized_boxes(spark: SparkSession, sf: str) -> DataFrame:
    elements = flatten.flatten_elements(fx.parsed(spark, sf), page_sizes=True)
    return _rounded(documents.normalize_bbox(elements, None, 459.0, 99.0))


@query
def prj14_normalized_boxes_joined(spark: SparkSession, sf: str) -> DataFrame:
    """The same boxes from elements without page sizes, which a table of pages brings."""
    return _rounded(documents.normalize_bbox(_elements(spark, sf), _sizes(spark, sf), 459.0, 99.0))


@query
def prj14_normalized_boxes_inferred(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(documents.normalize_bbox(_elements(spark, sf), _sizes(spark, sf), 459.0, 612.0, infer=True))


@query
def prj16_page_neighbors(spark: SparkSession, sf: str) -> DataFrame:
    return documents.page_neighbors(_pages(spark, sf))


@query
def qry4_corpus_stats(spark: SparkSession, sf: str) -> DataFrame:
    return documents.corpus_stats(*_corpus(spark, sf))


@query
def qry4_dashboard(spark: SparkSession, sf: str) -> DataFrame:
    row = documents.dashboard(documents.corpus_stats(*_corpus(spark, sf)))
    return row.withColumns({c: _map_text(c) for c in ("element_type_distribution", "source_distribution")})


@query
def qry4_summarized_stats(spark: SparkSession, sf: str) -> DataFrame:
    return summaries.summarized_stats(_summaries(spark, sf), fx.log(spark, sf))


@query
def qry4_merged_states(spark: SparkSession, sf: str) -> DataFrame:
    """Sums of the runs' states, and whether numbers of files, merged from sketches, are within 4 percent."""
    rows, log = _summaries(spark, sf), fx.log(spark, sf)
    merged = summaries.merged_states(summaries.run_states(rows, log))
    both = merged.withColumnRenamed("value", "merged").join(summaries.summarized_stats(rows, log), ["metric", "name"])
    return both.select("metric", "name", "value", (F.abs(F.col("merged") - F.col("value")) <= F.col("value") * 0.04).alias("near"))


@query
def ord1_newest_documents(spark: SparkSession, sf: str) -> DataFrame:
    """A deep page of the newest registered documents."""
    rows = fx.registry(spark, sf).orderBy(F.desc("synced_at"), "document_id").offset(100).limit(50)
    return _stamps(rows.select("document_id", "synced_at"))


@query
def ord2_sample_elements(spark: SparkSession, sf: str) -> DataFrame:
    return documents.sample_elements(_elements(spark, sf))


@query
def ord3_ordered_batches(spark: SparkSession, sf: str) -> DataFrame:
    rows = batching.batch_balance(batching.assign_batches(fx.raw(spark, sf), 50))
    return rows.orderBy(F.desc("total_bytes"), "batch_id")
