"""Parsing all batches of a run in waves: one job for an attempt at all batches that are left, whatever their number.

The batch is the unit of failure: it is done if all its documents are. A document that fails leaves its message in its row, and
the wave's outcomes are one aggregate over what was written. A job that fails as a whole is cut in two by batch numbers until
the batch that does it stands alone, so jobs grow with the batches that break them, not with all.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, functions as F

from doclake import schemas
from doclake.operators.commits import MOST_LEFT_OUT, Run
from doclake.operators.parse import ColumnExtractor, attempt_documents
from doclake.operators.runlog import ERROR_LENGTH

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Waves:
    """How to go about it. ``batches_per_job`` None: all batches that are left in one job."""

    max_retries: int = 3
    delay_seconds: float = 10.0
    batches_per_job: int | None = None
    sleep: Callable[[float], None] = time.sleep


def _rows_of(raw: DataFrame, failed: DataFrame | None) -> DataFrame:
    """The documents of the batches that are left: of all, or of those in ``failed (batch_id)``."""
    if failed is None:
        return raw
    few = [r[0] for r in failed.limit(MOST_LEFT_OUT + 1).collect()]
    if len(few) <= MOST_LEFT_OUT:
        return raw.filter(F.col("batch_id").isin(*few))
    return raw.join(failed, "batch_id", "left_semi")


def run_waves(run: Run, raw: DataFrame, extractor: ColumnExtractor, options: Column, how: Waves) -> DataFrame:
    """Parse ``raw`` in up to ``max_retries`` waves into the run's parsed documents; returns all attempts at batches.

    The pause doubles from one wave to the next; batches whose attempts are used up are left failed and leave no rows. An
    attempt's times are those of its wave. Per wave and range of batches, one folder of parsed rows and one of attempts.
    """
    if how.max_retries < 1 or (how.batches_per_job or 1) < 1:
        raise ValueError("max_retries and batches_per_job must be at least 1")
    last = raw.agg(F.max("batch_id")).first()[0] or 0
    failed: DataFrame | None = None
    for attempt in range(1, how.max_retries + 1):
        left = _rows_of(raw, failed)
        step = how.batches_per_job or max(last, 1)
        for low in range(1, last + 1, step):
            _wave(run, left, extractor, options, attempt, low, min(low + step - 1, last))
        tried = run.read("batch_attempts").filter((F.col("attempt_number") == attempt) & (F.col("outcome") == "failed"))
        failed = tried.select("batch_id")
        if failed.isEmpty():
            break
        if attempt < how.max_retries:
            how.sleep(how.delay_seconds * 2 ** (attempt - 1))
    return run.read("batch_attempts")


def _wave(
    run: Run, left: DataFrame, extractor: ColumnExtractor, options: Column, attempt: int, low: int, high: int
) -> None:
    """One job over the batches from ``low`` to ``high`` that are left, halved as often as it breaks."""
    started = datetime.now(timezone.utc)
    step = f"wave-{attempt}-{low}-{high}"
    within = left.filter(F.col("batch_id").between(low, high))
    try:
        written = run.write(attempt_documents(within, extractor, options), "parsed_documents", step)
        rows = run.stored(written)
        error = F.max(F.left("parse_error", F.lit(ERROR_LENGTH))).alias("error_message")
        outcomes = rows.groupBy("batch_id").agg(F.count(F.lit(1)).alias("documents"), error)
    except Exception as failure:
        if low < high:
            middle = (low + high) // 2
            log.warning("batches %d to %d failed together; trying them in halves", low, high)
            _wave(run, left, extractor, options, attempt, low, middle)
            _wave(run, left, extractor, options, attempt, middle + 1, high)
            return
        text = str(failure)[:ERROR_LENGTH] or type(failure).__name__
        outcomes = within.groupBy("batch_id").agg(F.count(F.lit(1)).alias("documents"), F.lit(text).alias("error_message"))
        written = None
    ended = datetime.now(timezone.utc)
    ok = F.col("error_message").isNull()
    attempts = outcomes.select(
        F.lit(run.run_id).alias("pipeline_run_id"),
        "batch_id",
        F.lit(attempt).alias("attempt_number"),
        F.when(ok, "completed").otherwise("failed").alias("outcome"),
        "documents",
        F.lit((ended - started) // timedelta(milliseconds=1)).cast("long").alias("duration_ms"),
        "error_message",
        F.lit(started).alias("started_at"),
        F.lit(ended).alias("completed_at"),
    )
    run.write(attempts.select(*[F.col(f.name).cast(f.dataType) for f in schemas.BATCH_ATTEMPTS]), "batch_attempts", step)
    if written is not None:
        of_step = run.read("batch_attempts").filter(
            (F.col("attempt_number") == attempt) & F.col("batch_id").between(low, high) & (F.col("outcome") == "failed")
        )
        run.leave_out(written, of_step.select("batch_id"))


def last_attempts(attempts: DataFrame) -> DataFrame:
    """Per batch its last attempt (``last``) and when the first one started."""
    return attempts.groupBy("batch_id").agg(
        F.max(F.struct("attempt_number", "outcome", "duration_ms", "error_message", "completed_at")).alias("last"),
        F.min("started_at").alias("first_started"),
    )
