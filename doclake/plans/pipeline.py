"""One run over all sources, stage by stage, every row stamped with the run.

Each stage reads tables and writes tables. What a run has written counts from its commits on: one when the
registry has its files, one when documents are loaded and queued, one when all that was parsed from them is in
place, so a run that is cut short leaves the state of its last commit, and can be started again with its run id.
Documents are loaded in the order of their file names, and all steps after that are narrow, a file to a task,
so the files of every table hold short ranges of names without any shuffle of contents. The driver holds only the list
of sources, the folders a commit names and one row of counts per stage.
"""

from __future__ import annotations

import logging
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from datetime import datetime, timedelta, timezone
from functools import reduce
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from doclake import schemas
from doclake.operators import commits, tables
from doclake.operators.aggregates import row_counts
from doclake.operators.batching import assign_batches
from doclake.operators.commits import Run
from doclake.operators.flatten import flatten_elements, flatten_pages, payload_sizes
from doclake.operators.incremental import not_yet_parsed, one_per_content
from doclake.operators.parse import ColumnExtractor, parse_options, text_extractor
from doclake.operators.registry import dedupe_latest, registry_delta, registry_rows, sync_summary
from doclake.operators.runlog import ERROR_LENGTH, fold_log, log_events
from doclake.operators.summaries import merged_states, run_states, summarize, summarized_stats
from doclake.plans.waves import Waves, last_attempts, run_waves
from doclake.session import durable
from doclake.sources import assign_staging_path, load_raw, read_source, stage_with_isolation
from doclake.sources.files import Fetch

log = logging.getLogger(__name__)

# Order of a document's log events within a run.
QUEUED, PROCESSING, FINISHED, SIZES, ROW_COUNTS = range(1, 6)


@dataclass
class PipelineParams:
    """What a run needs: where the tables are, what to list, and how to parse.

    Each source is a mapping as :func:`doclake.sources.read_source` takes it, with a ``name``. With
    ``image_dir`` page images go to a folder per run below it. A file that can no longer be read at ingest is failed
    in the log with the reason; ``on_unreadable="skip"`` leaves its document queued, ``"fail"`` ends the run. Give a
    ``fetch`` to sources whose listed paths cannot be opened as files. The batch size is the unit of
    failure and retry. All batches are parsed in one job, or ``parallel_batches`` at a time, where a model behind
    the extractor wants it. The registry log is compacted when it outgrows ``compact_share`` of the registry.
    """

    root: str
    sources: Sequence[Mapping[str, Any]]
    extractor: ColumnExtractor = field(default_factory=text_extractor)
    options: Column | None = None
    batch_size: int = 50
    max_retries: int = 3
    retry_delay_seconds: float = 10.0
    batching: str = "round_robin"
    incremental: str = "parsed_hash"
    dedupe_content: bool = False
    staging_base: str | None = None
    on_error: str = "raise"
    bytes_per_task: int = 256 * 1024 * 1024
    parallel_batches: int | None = None
    image_dir: str | None = None
    on_unreadable: str = "failed"
    compact_share: float = 0.5

    def __post_init__(self) -> None:
        if self.max_retries < 1:
            raise ValueError("max_retries must be at least 1")
        if self.batch_size < 1:
            raise ValueError("batch_size must be at least 1")
        if not self.sources:
            raise ValueError("at least one source is needed")


@dataclass
class RunSummary:
    """Counts of a run."""

    run_id: str
    listed: int = 0
    synced: int = 0
    failed_to_sync: int = 0
    to_process: int = 0
    unreadable: int = 0
    batches: int = 0
    batches_failed: int = 0
    retries: int = 0
    parsed: int = 0
    elements: int = 0
    pages: int = 0


def _listing(spark: SparkSession, source: Mapping[str, Any]) -> DataFrame:
    name = source.get("name", "unknown")
    return read_source(spark, source).select(
        F.lit(name).alias("source_name"),
        F.lit(source.get("type", "volume")).alias("source_type"),
        "original_path",
        "file_name",
        "file_size_bytes",
    )


def _stage(files: DataFrame, registry: DataFrame, source: Mapping[str, Any], params: PipelineParams) -> DataFrame:
    """Hash the files of a source; those not read in place also get a staging path."""
    fetch: Fetch | None = source.get("fetch")
    in_place = source.get("type", "volume") == "volume"
    unreadable = "empty_hash" if in_place else "fail"
    hashed = stage_with_isolation(files, fetch, unreadable, bytes_per_task=params.bytes_per_task)
    if in_place or params.staging_base is None:
        return hashed
    known = registry.filter(F.col("staging_path").isNotNull()).select(
        "source_name",
        "original_path",
        "staging_path",
        F.element_at(F.split("staging_path", "/"), -1).alias("file_name"),
    )
    # Stored, because both halves are needed and each would read every file again.
    hashed = durable(hashed)
    unreadable_files = hashed.filter(F.col("sync_error").isNotNull())
    readable = hashed.filter(F.col("sync_error").isNull()).drop("staging_path")
    return assign_staging_path(readable, known, params.staging_base).unionByName(unreadable_files)


def _file_per_task(spark: SparkSession) -> SparkSession:
    """A session with the same settings in which a scan puts no two files into one task, so that the files a narrow step
    writes hold the same ranges of names as those it reads."""
    other = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and other.conf.isModifiable(key):
            other.conf.set(key, value)
    other.conf.set("spark.sql.files.openCostInBytes", spark.conf.get("spark.sql.files.maxPartitionBytes"))
    return other


def _write_events(run: Run, events: DataFrame, step: str) -> None:
    """Log events of one step, narrow rows, in the order of file names."""
    run.write(events.repartitionByRange("file_name", "source_path").sortWithinPartitions("file_name"), "processing_log", step)


def sync(run: Run, params: PipelineParams) -> DataFrame:
    """List and hash every source and add the result to the registry; returns the sync summary.

    A source that cannot be opened or listed counts as one failure and leaves the others alone.
    """
    spark = run.spark
    registry = commits.read_registry(spark, params.root)
    rows, broken = [], []
    for source in params.sources:
        name = source.get("name", "unknown")
        try:
            files = durable(
                dedupe_latest(_listing(spark, source), ["source_name", "original_path"], ["file_size_bytes"])
            )
        except Exception:
            log.exception("source %s could not be listed", name)
            broken.append((name,))
            continue
        rows.append(durable(registry_rows(files, _stage(files, registry, source, params), run.run_id)))
    failures = spark.createDataFrame(broken, "source_name string")
    if not rows:
        return sync_summary(spark.createDataFrame([], schemas.DOCUMENT_REGISTRY), failures)
    found = reduce(DataFrame.unionByName, rows)
    # Two sources of one name that list the same file would give its key twice. A repeated run replaces its own rows.
    unique = dedupe_latest(found, ["document_id"], ["sync_status"])
    others = commits.read_registry(spark, params.root, without_run=run.run_id)
    delta = run.write(registry_delta(others, unique), "document_registry")
    run.put(replace(delta, rows=run.stored(delta).filter(~F.col("seen_only")).count()))
    run.commit()
    commits.compact_registry(spark, params.root, params.compact_share)
    return sync_summary(found, failures)


def ingest(run: Run, params: PipelineParams) -> int:
    """Load the documents that still need parsing, and open their log; returns their number.

    Ranking and batching see metadata only. The bytes are read by the tasks that write them. From the commit of this
    stage on, nothing of an earlier attempt of the run is left in any table, and raw documents are those of this run.
    """
    spark, run_id = run.spark, run.run_id
    run.clear("document_registry")
    registry = commits.read_registry(spark, params.root)
    # A repeated run must not take its own first attempt for earlier work.
    earlier = commits.read_table(spark, params.root, "parsed_documents", without_run=run_id)
    new = not_yet_parsed(
        registry, earlier.select("source_path", "content_hash", "parsed_at", "pipeline_run_id"), run_id, params.incremental
    )
    if params.dedupe_content:
        new = one_per_content(new)
    chosen = new.select(
        "source_name", F.col("staging_path").alias("source_path"), "file_name", "file_size_bytes", "original_path"
    )
    batched = durable(assign_batches(chosen, params.batch_size, params.batching))
    count = batched.count()
    fetches = {s.get("name", "unknown"): s["fetch"] for s in params.sources if "fetch" in s}
    parts = [(batched.filter(~F.col("source_name").isin(*fetches)) if fetches else batched, None)]
    parts += [(batched.filter(F.col("source_name") == name), fetch) for name, fetch in fetches.items()]
    loads = [
        load_raw(part, run_id, on_unreadable=params.on_unreadable, fetch=fetch, bytes_per_task=params.bytes_per_task)
        for part, fetch in parts
    ]
    raw = reduce(DataFrame.unionByName, loads) if count else spark.createDataFrame([], schemas.RAW_DOCUMENTS)
    if "read_error" not in raw.columns:
        raw = raw.withColumn("read_error", F.lit(None).cast("string"))
    run.write(raw, "raw_documents")
    opened = log_events(
        batched.withColumn("pipeline_run_id", F.lit(run_id)),
        QUEUED,
        status=F.lit("queued"),
        attempt_number=F.lit(0),
        started_at=F.current_timestamp(),
    )
    _write_events(run, opened, "queued")
    failed = log_events(
        commits.unreadable(run),
        FINISHED,
        status=F.lit("failed"),
        batch_id=F.col("batch_id"),
        error_message=F.col("read_error"),
        completed_at=F.current_timestamp(),
    )
    _write_events(run, failed, "unreadable")
    run.commit()
    return count


def read_log(spark: SparkSession, root: str, file_names: Sequence[str] | None = None) -> DataFrame:
    """The processing log as it stands, of all documents or those of some file names."""
    return fold_log(commits.read_table(spark, root, "processing_log", file_names))


def read_current(
    spark: SparkSession, root: str, name: str, file_names: Sequence[str] | None = None, page: int | None = None
) -> DataFrame:
    """Element or page rows of each document's latest parse, of all documents or those of some file names and a page."""
    return commits.read_current(spark, root, name, file_names, page)


def read_stats(spark: SparkSession, root: str, approximate: bool = False) -> DataFrame:
    """Corpus statistics ``(metric, name, value)`` as :func:`doclake.operators.documents.corpus_stats` gives them.

    They are read from a row per document, or with ``approximate`` from the few rows that each run keeps of its own: sums are
    exact then, numbers of files are estimates (0.8 percent standard error). Runs of which rows were superseded, or that were
    cut short after loading, are counted from their documents' rows.
    """
    current, log = read_current(spark, root, commits.SUMMARIES), read_log(spark, root)
    if not approximate:
        return summarized_stats(current, log)
    stored, stale = commits.runs_with_states(spark, root)
    states = commits.read_table(spark, root, commits.STATES)
    of_log, run = F.col("metric").isin("completed", "failed"), F.col("pipeline_run_id")
    kept = states.filter(of_log | ~run.isin(*stale)) if stale else states
    rest = current.filter(run.isin(*stale) | ~run.isin(*stored)) if stored else current
    return merged_states(kept.unionByName(run_states(rest, log.filter(~run.isin(*stored)) if stored else log)))


def open_file(spark: SparkSession, root: str, file_name: str, page: int | None = None) -> dict[str, DataFrame]:
    """What document and page views of one file name read: ``parsed``, ``elements``, ``pages`` and ``log``.

    Only files that can hold the name (and page) by their statistics are opened; see :func:`doclake.operators.commits.files_holding`.
    """
    return {
        "parsed": read_current(spark, root, "parsed_documents", [file_name]),
        "elements": read_current(spark, root, "document_elements", [file_name], page),
        "pages": read_current(spark, root, "document_pages", [file_name], page),
        "log": read_log(spark, root, [file_name]),
    }


class Attempt(NamedTuple):
    """One attempt at a batch."""

    batch_id: int
    attempt_number: int
    outcome: str
    started_at: datetime
    completed_at: datetime
    error_message: str | None

    @property
    def duration_ms(self) -> int:
        return (self.completed_at - self.started_at) // timedelta(milliseconds=1)


def run_batches(
    batches: Sequence[int],
    write_batch: Callable[[int], None],
    max_retries: int = 3,
    delay_seconds: float = 10.0,
    sleep: Callable[[float], None] = time.sleep,
    parallel: int = 1,
) -> list[Attempt]:
    """Run ``write_batch`` for each batch, in order, up to ``max_retries`` times each.

    The pause doubles from one attempt at a batch to the next; a batch whose attempts are used up is
    left failed and the rest go on. With ``parallel`` above 1 that many batches are under way at a
    time, each a Spark job of its own, so the end of one does not leave the cluster idle.
    """
    if max_retries < 1 or parallel < 1:
        raise ValueError("max_retries and parallel must be at least 1")

    def run(batch: int) -> list[Attempt]:
        attempts: list[Attempt] = []
        for attempt in range(1, max_retries + 1):
            started = datetime.now(timezone.utc)
            try:
                write_batch(batch)
                error = None
            except Exception as failure:
                error = str(failure)[:ERROR_LENGTH] or type(failure).__name__
            ended = datetime.now(timezone.utc)
            attempts.append(Attempt(batch, attempt, "failed" if error else "completed", started, ended, error))
            if not error:
                break
            if attempt < max_retries:
                sleep(delay_seconds * 2 ** (attempt - 1))
        return attempts

    with ThreadPoolExecutor(parallel) as pool:
        return [attempt for attempts in pool.map(run, batches) for attempt in attempts]


def parse(run: Run, params: PipelineParams) -> DataFrame:
    """Parse the loaded batches and log each document's way; returns the batch attempts.

    Attempts are few rows, one per batch and try; the documents of a batch find their outcome by a join on the batch
    number, not by an update each.
    """
    raw = run.read("raw_documents", _file_per_task(run.spark))
    documents = raw.select("source_name", "source_path", "file_name", "pipeline_run_id", "batch_id")
    started = log_events(
        documents, PROCESSING, status=F.lit("processing"), batch_id=F.col("batch_id"), started_at=F.current_timestamp()
    )
    _write_events(run, started, "processing")
    options = parse_options(image_dir=params.image_dir, run_id=run.run_id) if params.options is None else params.options
    how = Waves(params.max_retries, params.retry_delay_seconds, params.parallel_batches)
    attempts = run_waves(run, raw, params.extractor, options, how)
    ok = F.col("last.outcome") == "completed"
    finished = log_events(
        documents.join(last_attempts(attempts), "batch_id"),
        FINISHED,
        status=F.col("last.outcome"),
        attempt_number=F.col("last.attempt_number"),
        error_message=F.when(~ok, F.col("last.error_message")),
        parse_duration_ms=F.when(ok, F.col("last.duration_ms")),
        started_at=F.col("first_started"),
        completed_at=F.col("last.completed_at"),
    )
    _write_events(run, finished, "finished")
    return attempts


def flatten(run: Run, params: PipelineParams) -> None:
    """Write the run's element and page rows, log their counts, and name the rows of earlier runs they supersede."""
    parsed = run.read("parsed_documents", _file_per_task(run.spark))
    run.write(flatten_elements(parsed, on_error=params.on_error), "document_elements")
    run.write(flatten_pages(parsed, on_error=params.on_error), "document_pages")
    summaries = summarize(run.read("document_elements"), run.read("document_pages"))
    run.write(summaries.repartitionByRange("file_name", "source_path").sortWithinPartitions("file_name"), commits.SUMMARIES)
    written = [
        row_counts(run.read(table), name)
        for table, name in (("document_elements", "elements_extracted"), ("document_pages", "pages_parsed"))
    ]
    index = parsed.select("source_name", "source_path", "file_name", "pipeline_run_id")
    sizes = log_events(
        index.join(payload_sizes(parsed), ["source_path", "pipeline_run_id"]),
        SIZES,
        elements_extracted=F.col("elements_extracted"),
        pages_parsed=F.col("pages_parsed"),
    )
    key = ["source_path", "pipeline_run_id"]
    counted = log_events(
        index.join(written[0], key, "left").join(written[1], key, "left"),
        ROW_COUNTS,
        elements_extracted=F.col("elements_extracted"),
        pages_parsed=F.col("pages_parsed"),
    )
    _write_events(run, sizes, "sizes")
    _write_events(run, counted, "row_counts")
    run.supersede(commits.read_table(run.spark, params.root, "parsed_documents", without_run=run.run_id), parsed)


def run_pipeline(spark: SparkSession, params: PipelineParams, run_id: str | None = None) -> RunSummary:
    """Sync, ingest, parse and flatten; stages with nothing to do are skipped.

    Parsing and flattening are committed together: until then the documents are queued and come up again in any run.
    """
    summary = RunSummary(tables.checked_run_id(run_id or str(uuid.uuid4())))
    run = Run(spark, params.root, summary.run_id)
    total = sync(run, params).filter(F.col("source_name").isNull()).first()
    if total is not None:
        summary.listed, summary.synced, summary.failed_to_sync = total["listed"], total["synced"], total["failed"]
    summary.to_process = ingest(run, params)
    if summary.to_process == 0:
        return summary
    summary.unreadable = commits.unreadable(run).count()
    attempts = parse(run, params)
    outcomes = attempts.agg(
        F.count_distinct("batch_id").alias("batches"),
        F.count_if(F.col("outcome") == "completed").alias("completed"),
        F.count_if(F.col("outcome") == "failed").alias("retries"),
        F.coalesce(F.sum(F.when(F.col("outcome") == "completed", F.col("documents"))), F.lit(0)).alias("parsed"),
    ).first()
    summary.batches, summary.retries, summary.parsed = outcomes["batches"], outcomes["retries"], outcomes["parsed"]
    summary.batches_failed = outcomes["batches"] - outcomes["completed"]
    if summary.parsed:
        flatten(run, params)
        summary.elements, summary.pages = (run.read(name).count() for name in ("document_elements", "document_pages"))
    run.write(run_states(run.read(commits.SUMMARIES), fold_log(run.read("processing_log"))).coalesce(1), commits.STATES)
    run.commit()
    return summary
