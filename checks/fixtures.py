"""The operators' input tables, derived from the given tables by plain expressions (see FIXTURES.md).

Every derivation keeps all rows and whole texts. Joins happen on narrow columns; texts are hashed,
measured or laid out in the scan that reads them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from doclake.operators.layout import bound, box, payload
from doclake.schemas import LOG_EVENTS, PROCESSING_LOG

LINES_PER_PAGE = 12
LONG_LINE = 1000
EPOCH = 1_704_067_200  # 2024-01-01


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _path() -> Column:
    return F.concat(F.lit("/"), "source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt"))


def _file_name() -> Column:
    return F.concat(F.lit("doc_"), F.expr("doc_id div 2").cast("string"), F.lit(".txt"))


def _run() -> Column:
    return F.concat(F.lit("run_"), "lang")


def _at(seconds: str) -> Column:
    return F.timestamp_seconds(F.lit(EPOCH) + F.expr(seconds))


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing of every document with its hash, size and label."""
    documents = table(spark, sf_dir, "documents").select(
        "doc_id",
        "lang",
        F.col("source").alias("source_name"),
        F.element_at(
            F.array(*[F.lit(t) for t in ("volume", "sharepoint", "google_drive", "adls")]),
            (F.col("doc_id") % 4 + 1).cast("int"),
        ).alias("source_type"),
        _path().alias("original_path"),
        _file_name().alias("file_name"),
        F.octet_length("text").cast("long").alias("file_size_bytes"),
        F.md5("text").alias("content_hash"),
        _run().alias("pipeline_run_id"),
        _at("doc_id div 10").alias("synced_at"),
    )
    return documents.join(_labels(spark, sf_dir), "doc_id", "left")


def staged(listing: DataFrame) -> DataFrame:
    """Staging results: toxic documents could not be read."""
    failed = F.coalesce(F.col("toxic") == 1, F.lit(False))
    return listing.select(
        "source_name",
        "original_path",
        F.when(~failed, F.col("original_path")).alias("staging_path"),
        "file_name",
        "file_size_bytes",
        F.when(~failed, F.col("content_hash")).alias("content_hash"),
        F.when(failed, F.repeat(F.lit("unreadable "), F.lit(200))).alias("sync_error"),
    )


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry after every document was synced once, one run per language."""
    listing = files(spark, sf_dir)
    failed = F.coalesce(F.col("toxic") == 1, F.lit(False))
    return listing.select(
        F.md5(F.concat("source_name", F.lit(":"), "original_path")).alias("document_id"),
        "source_name",
        "source_type",
        "original_path",
        F.when(~failed, F.col("original_path")).alias("staging_path"),
        "file_name",
        "file_size_bytes",
        F.when(~failed, F.col("content_hash")).alias("content_hash"),
        F.when(failed, "failed").otherwise("synced").alias("sync_status"),
        F.when(failed, "unreadable").alias("sync_error"),
        "synced_at",
        F.col("synced_at").alias("registered_at"),
        "pipeline_run_id",
    )


def resync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later sync: the labelled documents again, and the web pages as new documents."""
    again = (
        files(spark, sf_dir)
        .filter(F.col("quality").isNotNull())
        .select(
            "source_name",
            F.lit("volume").alias("source_type"),
            "original_path",
            F.concat(F.lit("renamed_"), "file_name").alias("file_name"),
            (F.col("file_size_bytes") + 1).alias("file_size_bytes"),
            F.md5(F.concat("content_hash", F.lit("2"))).alias("content_hash"),
            (F.col("quality") == 0).alias("failed"),
        )
    )
    pages = table(spark, sf_dir, "pages").select(
        F.lit("web").alias("source_name"),
        F.lit("adls").alias("source_type"),
        F.col("url").alias("original_path"),
        F.concat(F.lit("page_"), F.col("page_id").cast("string"), F.lit(".html")).alias("file_name"),
        F.octet_length("html").cast("long").alias("file_size_bytes"),
        F.md5("html").alias("content_hash"),
        F.lit(False).alias("failed"),
    )
    failed = F.col("failed")
    return again.unionByName(pages).select(
        F.md5(F.concat("source_name", F.lit(":"), "original_path")).alias("document_id"),
        "source_name",
        "source_type",
        "original_path",
        F.when(~failed, F.col("original_path")).alias("staging_path"),
        "file_name",
        "file_size_bytes",
        F.when(~failed, F.col("content_hash")).alias("content_hash"),
        F.when(failed, "failed").otherwise("synced").alias("sync_status"),
        F.when(failed, "gone").alias("sync_error"),
        F.timestamp_seconds(F.lit(EPOCH + 86_400)).alias("synced_at"),
        F.timestamp_seconds(F.lit(EPOCH + 86_400)).alias("registered_at"),
        F.lit("run_resync").alias("pipeline_run_id"),
    )


def parsed_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an earlier run has parsed: the labelled documents, with the hash they had then."""
    labelled = files(spark, sf_dir).filter(F.col("quality").isNotNull())
    # Low-quality documents have been edited since.
    edited = F.md5(F.concat("content_hash", F.lit("1")))
    return labelled.select(
        F.col("original_path").alias("source_path"),
        F.when(F.col("quality") == 0, edited).otherwise(F.col("content_hash")).alias("content_hash"),
    )


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata of the loaded documents: the synced ones."""
    return registry(spark, sf_dir).filter(F.col("sync_status") == "synced").select(
        "source_name", F.col("staging_path").alias("source_path"), "file_name", "file_size_bytes", "pipeline_run_id"
    )


def layout(text: Column, doc_id: Column) -> Column:
    """A parse result with every shape a flatten step meets: no, one and two boxes, figures without
    content, several errors on a page."""

    def page_of(at: Column) -> Column:
        return F.floor(at / LINES_PER_PAGE).cast("int")

    def element(line: Column, at: Column) -> Column:
        row = at % LINES_PER_PAGE
        figure = at % 11 == 10
        right = 50 + F.least(F.length(line), F.lit(500))
        own = box(page_of(at), F.lit(50), 40 + row * 60, right, 80 + row * 60)
        following = box(page_of(at) + 1, F.lit(50), F.lit(40), right, F.lit(80))
        no_box = F.array().cast("array<struct<page_id:int,coord:array<int>>>")
        return F.struct(
            at.alias("id"),
            F.when(at == 0, "title").when(figure, "figure").when(at % 7 == 6, "table").otherwise("text").alias("type"),
            F.when(~figure, line).alias("content"),
            F.when(figure, F.left(line, F.lit(40))).alias("description"),
            F.when(at % 13 == 12, no_box).when(at % 9 == 8, F.array(own, following)).otherwise(F.array(own)).alias("bbox"),
        )

    def page(p: Column) -> Column:
        image = F.concat(F.lit("/img/"), doc_id.cast("string"), F.lit("/"), p.cast("string"), F.lit(".png"))
        return F.struct(
            p.alias("id"), image.alias("image_uri"), F.lit(612).alias("width"), F.lit(792).alias("height")
        )

    def document(lines: Column) -> Column:
        long_lines = F.transform(lines, lambda x, i: F.when(F.length(x) > LONG_LINE, page_of(i)))
        errors = F.transform(F.array_compact(long_lines), lambda p: F.struct(p.alias("page_id")))
        pages = F.transform(F.sequence(F.lit(0), page_of(F.size(lines) - 1)), page)
        return payload(F.transform(lines, element), pages, errors)

    return bound(F.split(text, "\n"), document)


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document parsed, one run per language."""
    return table(spark, sf_dir, "documents").select(
        F.col("source").alias("source_name"),
        _path().alias("source_path"),
        _file_name().alias("file_name"),
        layout(F.col("text"), F.col("doc_id")).alias("parsed_output"),
        _at("doc_id div 10").alias("parsed_at"),
        _run().alias("pipeline_run_id"),
    )


def _status() -> Column:
    return (
        F.when(F.col("toxic") == 1, "processing").when(F.col("quality") == 0, "failed").otherwise("completed")
    )


def _narrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return documents.join(_labels(spark, sf_dir), "doc_id", "left")


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log after the parse runs: low-quality documents failed, toxic ones are still processing."""
    done = F.col("status") != "processing"
    return (
        _narrow(spark, sf_dir)
        .withColumn("status", _status())
        .select(
            F.md5(_path()).alias("document_id"),
            F.col("source").alias("source_name"),
            _path().alias("source_path"),
            _file_name().alias("file_name"),
            "status",
            F.expr("cast(doc_id div 40 + 1 as int)").alias("batch_id"),
            F.when(done, 1).otherwise(0).alias("attempt_number"),
            F.when(F.col("status") == "failed", "no text").alias("error_message"),
            F.when(F.col("status") == "completed", 7).alias("elements_extracted"),
            F.when(F.col("status") == "completed", 1).alias("pages_parsed"),
            F.when(F.col("status") == "completed", F.col("n_chars")).alias("parse_duration_ms"),
            _at("doc_id div 10").alias("started_at"),
            F.when(done, _at("doc_id div 10 + 60")).alias("completed_at"),
            _run().alias("pipeline_run_id"),
        )
        .select(*[F.col(f.name).cast(f.dataType) for f in PROCESSING_LOG.fields])
    )


def log_event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events behind :func:`log`: queued, processing, and the end if it was reached."""
    documents = _narrow(spark, sf_dir).withColumn("end", _status())
    events = documents.withColumn("seq", F.explode(F.sequence(F.lit(1), F.when(F.col("end") == "processing", 2).otherwise(3))))

    def on(seq: int, value: Column) -> Column:
        return F.when(F.col("seq") == seq, value)

    done = F.col("seq") == 3
    return events.select(
        F.md5(_path()).alias("document_id"),
        F.col("source").alias("source_name"),
        _path().alias("source_path"),
        _file_name().alias("file_name"),
        F.when(done, F.col("end")).when(F.col("seq") == 2, "processing").otherwise("queued").alias("status"),
        on(2, F.expr("cast(doc_id div 40 + 1 as int)")).alias("batch_id"),
        F.when(done, 1).when(F.col("seq") == 1, 0).alias("attempt_number"),
        F.when(done & (F.col("end") == "failed"), "no text").alias("error_message"),
        F.lit(None).alias("elements_extracted"),
        F.lit(None).alias("pages_parsed"),
        F.when(done & (F.col("end") == "completed"), F.col("n_chars")).alias("parse_duration_ms"),
        F.when(~done, _at("doc_id div 10 + seq")).alias("started_at"),
        F.when(done, _at("doc_id div 10 + 60")).alias("completed_at"),
        _run().alias("pipeline_run_id"),
        "seq",
    ).select(*[F.col(f.name).cast(f.dataType) for f in LOG_EVENTS.fields])


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch attempts: a batch fails once for each toxic document in it, and has three attempts."""
    batches = (
        _narrow(spark, sf_dir)
        .groupBy(_run().alias("pipeline_run_id"), F.expr("cast(doc_id div 40 + 1 as int)").alias("batch_id"))
        .agg(F.count(F.lit(1)).alias("documents"), F.count_if(F.col("toxic") == 1).alias("toxic"))
    )
    tries = F.explode(F.sequence(F.lit(1), F.least(F.col("toxic") + 1, F.lit(3)).cast("int")))
    return batches.withColumn("attempt_number", tries).withColumn(
        "outcome", F.when(F.col("attempt_number") <= F.col("toxic"), "failed").otherwise("completed")
    )


def blob_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An object-store inventory; very short documents count as empty objects."""
    ending = F.element_at(F.array(*[F.lit(e) for e in ("pdf", "PDF", "docx", "txt")]), (F.col("doc_id") % 4 + 1).cast("int"))
    return table(spark, sf_dir, "documents").select(
        F.concat("source", F.lit("/"), "lang", F.lit("/"), F.col("doc_id").cast("string"), F.lit("."), ending).alias("name"),
        F.when(F.col("n_chars") < 50, 0).otherwise(F.col("n_chars")).alias("size"),
    )


# One file type per remainder, so allowed, exportable and unsupported ones all occur.
TREE_MIME_TYPES = [
    "application/pdf",
    "application/vnd.google-apps.document",
    "image/png",
    "application/vnd.google-apps.presentation",
    "application/zip",
]


def tree_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder tree: root, a folder per source, one per language in it, and the files."""
    documents = table(spark, sf_dir, "documents")
    folder = F.lit("application/vnd.google-apps.folder")
    no_size = F.lit(None).cast("long")
    sources = documents.select("source").distinct().select(
        F.col("source").alias("id"), F.lit("root").alias("parent"), F.col("source").alias("name"), folder.alias("mime"), no_size.alias("size")
    )
    langs = documents.select("source", "lang").distinct().select(
        F.concat("source", F.lit("-"), "lang").alias("id"), F.col("source").alias("parent"), F.col("lang").alias("name"), folder.alias("mime"), no_size.alias("size")
    )
    mime = F.element_at(F.array(*[F.lit(m) for m in TREE_MIME_TYPES]), (F.col("doc_id") % 5 + 1).cast("int"))
    ending = F.when(F.col("doc_id") % 2 == 0, ".docx").otherwise("")
    leaves = documents.select(
        F.concat(F.lit("f"), F.col("doc_id").cast("string")).alias("id"),
        F.concat("source", F.lit("-"), "lang").alias("parent"),
        F.concat(F.lit("Doc "), F.col("doc_id").cast("string"), ending).alias("name"),
        mime.alias("mime"),
        F.when(~F.contains(mime, F.lit("google-apps")), F.col("n_chars")).alias("size"),
    )
    return sources.unionByName(langs).unionByName(leaves)


def library_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document library: a folder per source and per language in it; French files lie at the root."""
    documents = table(spark, sf_dir, "documents")
    no_size = F.lit(None).cast("long")
    sources = documents.select("source").distinct().select(
        F.lit("").alias("parent_path"), F.col("source").alias("name"), F.lit("folder").alias("kind"), no_size.alias("size")
    )
    langs = documents.select("source", "lang").distinct().select(
        F.col("source").alias("parent_path"), F.col("lang").alias("name"), F.lit("folder").alias("kind"), no_size.alias("size")
    )
    nested = F.concat("source", F.lit("/"), "lang")
    leaves = documents.select(
        F.when(F.col("lang") == "fr", "").otherwise(nested).alias("parent_path"),
        F.concat("source", F.lit("_"), F.col("doc_id").cast("string"), F.lit(".PDF")).alias("name"),
        F.lit("file").alias("kind"),
        F.col("n_chars").alias("size"),
    )
    return sources.unionByName(langs).unionByName(leaves)


def mixed_parsed(spark: SparkSession, sf_dir: str, bad_casts: bool) -> DataFrame:
    """Every document with a payload of odd shapes: items that are no objects, boxes and corners of other kinds, numbers as text,
    error lists that are none; with ``bad_casts`` also values that are no numbers."""
    number = F.col("doc_id").cast("string")
    whole = F.struct(
        F.lit("7").alias("id"),
        F.lit(3).alias("type"),
        F.col("text").alias("content"),
        F.array(F.struct(F.lit("2").alias("page_id"), F.array(F.lit(1), F.lit(2), F.col("doc_id"), F.lit(4)).alias("coord"))).alias("bbox"),
    )
    odd_id = F.when(F.lit(bad_casts) & (F.col("doc_id") % 3 == 0), '"abc"').otherwise("2.7")
    elements = F.concat(
        F.lit("["),
        F.to_json(whole),
        F.lit(', "loose", 17, null, [1], {"id": 5, "type": {"a": 1}, "bbox": {"page_id": 1}}, {"id": 8, "bbox": "none"}, {"id": '),
        odd_id,
        F.lit(', "description": [1, 2], "bbox": ["x", {"page_id": 0, "coord": "flat"}, {"coord": [9, "8", null]}, null]}]'),
    )
    pages = F.concat(F.lit('[{"id": 0, "image_uri": '), number, F.lit('}, "p", {"id": "1", "image_uri": {"u": 1}}, {"image_uri": "z"}]'))
    errors = F.when(F.col("doc_id") % 4 == 0, '"broken"').when(F.col("doc_id") % 4 == 1, '{"page_id": 0}').otherwise(
        F.concat(F.lit('[{"page_id": 0}, "late", {"page_id": "1"}, {"page_id": '), odd_id, F.lit("}]"))
    )
    text = F.concat(
        F.lit('{"document": {"elements": '), elements, F.lit(', "pages": '), pages, F.lit('}, "error_status": '), errors, F.lit("}")
    )
    return table(spark, sf_dir, "documents").select(
        F.col("source").alias("source_name"),
        _path().alias("source_path"),
        _file_name().alias("file_name"),
        F.parse_json(text).alias("parsed_output"),
        _at("doc_id div 10").alias("parsed_at"),
        _run().alias("pipeline_run_id"),
    )


def fetched(path: str) -> bytes:
    """Bytes of a listed file, made of its path; paths that end in 7.txt cannot be read."""
    if path.endswith("7.txt"):
        raise OSError("gone")
    return f"content of {path}".encode()
