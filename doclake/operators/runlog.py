"""The processing log, kept as events.

A status change is an appended row holding only what changed, so no run rewrites another's rows; the
state of a document in a run is, column by column, the last value set.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from doclake.functions.identity import log_id
from doclake.schemas import LOG_EVENTS, PROCESSING_LOG

ERROR_LENGTH = 1000
_KEY = ["source_path", "pipeline_run_id"]


def _as_schema(df: DataFrame, schema, **values: Column) -> DataFrame:
    return df.select(
        *[
            values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def _of_document(**changes: Column) -> dict[str, Column]:
    return {
        "document_id": log_id(F.col("source_path")),
        "source_name": F.col("source_name"),
        "source_path": F.col("source_path"),
        "file_name": F.col("file_name"),
        "pipeline_run_id": F.col("pipeline_run_id"),
        **changes,
    }


def open_log(raw: DataFrame, started_at: Column | None = None) -> DataFrame:
    """Log rows of newly loaded documents: queued, attempt 0, no counts."""
    started = F.current_timestamp() if started_at is None else started_at
    opened = _of_document(status=F.lit("queued"), attempt_number=F.lit(0), started_at=started)
    return _as_schema(raw, PROCESSING_LOG, **opened)


def log_events(documents: DataFrame, seq: int | Column, **changes: Column) -> DataFrame:
    """Events setting the columns ``changes`` for ``documents``; ``seq`` orders events of a run."""
    order = F.lit(seq) if isinstance(seq, int) else seq
    if "error_message" in changes:
        changes["error_message"] = F.left(changes["error_message"], F.lit(ERROR_LENGTH))
    return _as_schema(documents, LOG_EVENTS, **_of_document(**changes), seq=order)


def fold_log(events: DataFrame) -> DataFrame:
    """The log as it stands after ``events``: one row per document and run."""
    folded = [
        F.max_by(name, F.when(F.col(name).isNotNull(), F.col("seq"))).alias(name)
        for name in PROCESSING_LOG.names
        if name not in _KEY
    ]
    return events.groupBy(*_KEY).agg(*folded).select(*PROCESSING_LOG.names)


def log_transition(log: DataFrame, documents: DataFrame, run_id: str, **changes: Column) -> DataFrame:
    """``log`` with ``changes`` set on the rows of ``documents`` in the run."""
    keys = documents.select("source_path").distinct()
    keys = keys.withColumn("pipeline_run_id", F.lit(run_id)).withColumn("_hit", F.lit(True))
    marked = log.join(keys, _KEY, "left")
    return marked.select(
        *[
            F.when(F.col("_hit"), changes[f.name].cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name)
            if f.name in changes
            else F.col(f.name)
            for f in PROCESSING_LOG.fields
        ]
    )


def apply_counts(log: DataFrame, counts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``log`` with the columns of ``counts`` set where a document and run have a row there.

    ``counts`` has ``source_path, pipeline_run_id`` and the columns, one row per document and run; a
    document without one keeps what it had.
    """
    new = counts.select(*_KEY, F.struct(*columns).alias("_new"))
    return log.join(new, _KEY, "left").select(
        *[
            F.when(F.col("_new").isNotNull(), F.col(f"_new.{f.name}").cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name)
            if f.name in columns
            else F.col(f.name)
            for f in PROCESSING_LOG.fields
        ]
    )


def retry_stats(attempts: DataFrame) -> DataFrame:
    """Per run: completed and failed batches, documents of the completed ones, and failed attempts."""
    batches = attempts.groupBy("pipeline_run_id", "batch_id").agg(
        F.max(F.col("outcome") == "completed").alias("done"),
        F.max("documents").alias("documents"),
        F.count_if(F.col("outcome") == "failed").alias("failures"),
    )
    return batches.groupBy("pipeline_run_id").agg(
        F.count_if("done").alias("batches_completed"),
        F.count_if(~F.col("done")).alias("batches_failed"),
        F.coalesce(F.sum(F.when(F.col("done"), F.col("documents"))), F.lit(0)).alias("documents"),
        F.coalesce(F.sum("failures"), F.lit(0)).alias("retries"),
    )
