"""The parse step: a pluggable extractor applied to raw documents as a Spark job."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from doclake.operators.layout import layout_from_html, layout_from_text
from doclake.schemas import PARSED_DOCUMENTS

ERROR_LENGTH = 1000
# Results of a Python extractor leave its worker once they are this many characters together; few are ever held.
PIECE_LENGTH = 1_000_000

# Bytes and options in, parse result (VARIANT) out.
ColumnExtractor = Callable[[Column, Column], Column]
# One document in, the parse result as a dictionary out.
DocumentExtractor = Callable[[bytes, Mapping[str, str]], dict]


def parse_options(
    version: str = "2.0", description_types: str = "*", image_dir: str | None = None, run_id: str | None = None
) -> Column:
    """The option map of a parse; page images go to a folder per run, if they are wanted at all."""
    options = {"version": version, "descriptionElementTypes": description_types}
    if image_dir is not None:
        options["imageOutputPath"] = "/".join([image_dir.rstrip("/"), *([run_id] if run_id else []), ""])
    return F.create_map(*[F.lit(x) for item in options.items() for x in item])


def _decoded(content: Column) -> tuple[Column, Column]:
    """Text of the bytes, with replacement signs where they are not UTF-8, and the errors that come of it."""
    text = content.cast("string")
    wrong = F.array(F.struct(F.lit(None).cast("int").alias("page_id"), F.lit("not valid UTF-8").alias("error_message")))
    errors = F.when(F.is_valid_utf8(text), F.filter(wrong, lambda e: F.lit(False))).otherwise(wrong)
    return F.make_valid_utf8(text), errors


def text_extractor(lines_per_page: int = 12) -> ColumnExtractor:
    """Extractor for UTF-8 text; other bytes are replaced and give an error entry, the document alone is touched."""

    def extract(content: Column, options: Column) -> Column:
        text, errors = _decoded(content)
        return layout_from_text(text, lines_per_page, errors)

    return extract


def html_extractor(parts_per_page: int = 12) -> ColumnExtractor:
    """Extractor for UTF-8 HTML; other bytes as for text."""

    def extract(content: Column, options: Column) -> Column:
        html, errors = _decoded(content)
        return layout_from_html(html, parts_per_page, errors)

    return extract


def python_extractor(load: Callable[[], DocumentExtractor], on_error: str = "raise") -> ColumnExtractor:
    """Extractor for models that need Python, called on Arrow batches.

    ``load`` runs once per worker process and returns the function that parses one document. With
    ``on_error="status"`` a document that fails yields no elements and one error entry with the
    message, and the rest of the batch goes on; with ``"raise"`` it fails the batch. Beside Spark's batches
    a worker holds one document and a piece of results.
    """
    if on_error not in ("raise", "status"):
        raise ValueError("on_error must be 'raise' or 'status'")

    def pieces(contents: pa.Array, options: pa.Array, parsed: Callable[[bytes | None, list | None], tuple]) -> Iterator[list[tuple]]:
        """What ``parsed`` gives for each document of a batch, one after the other, handed on in lists of bounded length."""
        piece, length = [], 0
        for content, chosen in zip(contents, options):
            piece.append(parsed(content.as_py(), chosen.as_py()))
            length += sum(len(text) for text in piece[-1] if text)
            if length >= PIECE_LENGTH:
                yield piece
                piece, length = [], 0
        if piece:
            yield piece

    @F.arrow_udf("string")
    def extract(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        parse = load()

        def parsed(content, chosen):
            try:
                return (json.dumps(parse(content, dict(chosen)), allow_nan=on_error == "raise"),)
            except Exception as error:
                if on_error == "raise":
                    raise
                failure = {"page_id": None, "error_message": str(error)[:ERROR_LENGTH]}
                return (json.dumps({"document": {"elements": [], "pages": []}, "error_status": [failure]}),)

        for contents, options in batches:
            for piece in pieces(contents, options, parsed):
                yield pa.array([result for result, in piece], pa.string())

    @F.arrow_udf("result string, error string")
    def attempt(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        parse = load()

        def parsed(content, chosen):
            try:
                return json.dumps(parse(content, dict(chosen))), None
            except Exception as error:
                return None, str(error)[:ERROR_LENGTH] or type(error).__name__

        for contents, options in batches:
            for piece in pieces(contents, options, parsed):
                columns = [pa.array(column, pa.string()) for column in zip(*piece)]
                yield pa.StructArray.from_arrays(columns, names=["result", "error"])

    if on_error == "raise":
        raising = lambda content, options: F.parse_json(extract(content, options))
        raising.attempt = attempt
        return raising
    # A result that is no valid VARIANT (too large, say) is that document's failure alone.
    failed = json.dumps({"document": {"elements": [], "pages": []}, "error_status": [{"page_id": None, "error_message": "result cannot be stored"}]})
    return lambda content, options: F.coalesce(F.try_parse_json(extract(content, options)), F.parse_json(F.lit(failed)))


def parse_documents(
    raw: DataFrame, extractor: ColumnExtractor, options: Column | None = None, parsed_at: str | None = None
) -> DataFrame:
    """One parse result per raw document. The bytes go no further than this step."""
    now = F.current_timestamp() if parsed_at is None else F.to_timestamp(F.lit(parsed_at))
    chosen = parse_options() if options is None else options
    return raw.select(
        "source_name",
        "source_path",
        "file_name",
        extractor(F.col("content"), chosen).alias("parsed_output"),
        "content_hash",
        now.alias("parsed_at"),
        "pipeline_run_id",
        "batch_id",
    ).select(*PARSED_DOCUMENTS.names)


def attempt_documents(
    raw: DataFrame, extractor: ColumnExtractor, options: Column | None = None, parsed_at: str | None = None
) -> DataFrame:
    """:func:`parse_documents` with each document's own failure: its message in ``parse_error``, and no result.

    A Python extractor that raises fails its document alone, so the job goes on. What a column extractor raises, and a worker
    that dies, still fail the job; :func:`doclake.plans.waves.run_waves` then looks for the batch that does it.
    """
    attempt = getattr(extractor, "attempt", None)
    if attempt is None:
        return parse_documents(raw, extractor, options, parsed_at).withColumn("parse_error", F.lit(None).cast("string"))
    now = F.current_timestamp() if parsed_at is None else F.to_timestamp(F.lit(parsed_at))
    chosen = parse_options() if options is None else options
    tried = raw.withColumn("_tried", attempt(F.col("content"), chosen)).drop("content")
    tried = tried.withColumn("parsed_output", F.try_parse_json("_tried.result")).withColumn("parsed_at", now)
    error = F.when(F.col("parsed_output").isNull(), F.coalesce("_tried.error", F.lit("result cannot be stored")))
    return tried.select(*PARSED_DOCUMENTS.names, error.alias("parse_error"))
