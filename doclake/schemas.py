"""Declared schemas of the six tables and of the listing rows every source produces."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, INT, LONG, BOOL = T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType()
TIMESTAMP, BINARY, VARIANT = T.TimestampType(), T.BinaryType(), T.VariantType()


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


DOCUMENT_REGISTRY = _schema(
    document_id=STRING,
    source_name=STRING,
    source_type=STRING,
    original_path=STRING,
    staging_path=STRING,
    file_name=STRING,
    file_size_bytes=LONG,
    content_hash=STRING,
    sync_status=STRING,
    sync_error=STRING,
    synced_at=TIMESTAMP,
    registered_at=TIMESTAMP,
    pipeline_run_id=STRING,
)

# The registry is kept as a log. A file seen again unchanged adds only its key and stamps.
REGISTRY_DELTA = T.StructType([*DOCUMENT_REGISTRY.fields, T.StructField("seen_only", BOOL)])

RAW_DOCUMENTS = _schema(
    source_name=STRING,
    source_path=STRING,
    file_name=STRING,
    file_size_bytes=LONG,
    source_modified_at=TIMESTAMP,
    content=BINARY,
    content_hash=STRING,
    ingested_at=TIMESTAMP,
    pipeline_run_id=STRING,
    batch_id=INT,
)

# ``content_hash`` is the hash the bytes had when they were parsed; the incremental filter compares
# with it, so editing a file in place is noticed.
PARSED_DOCUMENTS = _schema(
    source_name=STRING,
    source_path=STRING,
    file_name=STRING,
    parsed_output=VARIANT,
    content_hash=STRING,
    parsed_at=TIMESTAMP,
    pipeline_run_id=STRING,
    batch_id=INT,
)

DOCUMENT_ELEMENTS = _schema(
    source_name=STRING,
    source_path=STRING,
    file_name=STRING,
    element_id=INT,
    element_type=STRING,
    content=STRING,
    ai_description=STRING,
    bounding_box_json=STRING,
    page_id=INT,
    bbox_index=INT,
    bbox_x1=INT,
    bbox_y1=INT,
    bbox_x2=INT,
    bbox_y2=INT,
    has_parse_errors=BOOL,
    parsed_at=TIMESTAMP,
    pipeline_run_id=STRING,
)

DOCUMENT_PAGES = _schema(
    source_name=STRING,
    source_path=STRING,
    file_name=STRING,
    page_number=INT,
    image_uri=STRING,
    has_parse_errors=BOOL,
    page_has_error=BOOL,
    parsed_at=TIMESTAMP,
    pipeline_run_id=STRING,
)

PROCESSING_LOG = _schema(
    document_id=STRING,
    source_name=STRING,
    source_path=STRING,
    file_name=STRING,
    status=STRING,
    batch_id=INT,
    attempt_number=INT,
    error_message=STRING,
    elements_extracted=INT,
    pages_parsed=INT,
    parse_duration_ms=LONG,
    started_at=TIMESTAMP,
    completed_at=TIMESTAMP,
    pipeline_run_id=STRING,
)

# The log is kept as events: the same columns plus an order; see operators.runlog.fold_log.
LOG_EVENTS = T.StructType([*PROCESSING_LOG.fields, T.StructField("seq", LONG)])

# One row per document and run: see operators.summaries.
DOCUMENT_SUMMARIES = _schema(
    source_name=STRING,
    source_path=STRING,
    file_name=STRING,
    element_ids=T.ArrayType(INT),
    element_types=T.ArrayType(_schema(element_type=STRING, cnt=LONG)),
    page_numbers=T.ArrayType(INT),
    page_rows=LONG,
    parsed_at=TIMESTAMP,
    pipeline_run_id=STRING,
)

# What a run adds to corpus statistics: a sum, or a sketch of file names.
RUN_STATES = _schema(pipeline_run_id=STRING, metric=STRING, name=STRING, value=LONG, sketch=BINARY)

# One row per attempt at a batch.
BATCH_ATTEMPTS = _schema(
    pipeline_run_id=STRING,
    batch_id=INT,
    attempt_number=INT,
    outcome=STRING,
    documents=LONG,
    duration_ms=LONG,
    error_message=STRING,
    started_at=TIMESTAMP,
    completed_at=TIMESTAMP,
)

# What a source lists.
FILE_REFS = T.StructType(
    [
        T.StructField("original_path", STRING),
        T.StructField("file_name", STRING),
        T.StructField("file_size_bytes", LONG),
        T.StructField("metadata", T.MapType(STRING, STRING)),
    ]
)

# What staging yields for a listed file: where it is now and its hash, or why it failed.
STAGED_FILES = _schema(
    source_name=STRING,
    original_path=STRING,
    staging_path=STRING,
    file_name=STRING,
    file_size_bytes=LONG,
    content_hash=STRING,
    sync_error=STRING,
)

TABLES = {
    "document_registry": DOCUMENT_REGISTRY,
    "raw_documents": RAW_DOCUMENTS,
    "parsed_documents": PARSED_DOCUMENTS,
    "document_elements": DOCUMENT_ELEMENTS,
    "document_pages": DOCUMENT_PAGES,
    "processing_log": LOG_EVENTS,
    "batch_attempts": BATCH_ATTEMPTS,
}
