"""Directory listings, and reads of file bytes on the executors."""

from __future__ import annotations

import hashlib
import itertools
import os
import re
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from doclake import schemas
from doclake.functions.patterns import matches_pattern
from doclake.session import durable

Fetch = Callable[[str], bytes]

ERROR_LENGTH = 1000
_ENTRIES_PER_BATCH = 10_000
_FLUSH_BYTES = 64 * 1024 * 1024


def _mounted(path: str) -> str:
    """A path as the executors open it: without the scheme of a mounted file system."""
    return re.sub(r"^(dbfs|file):/*", "/", path)


def _filesystem(path: str):
    """The file system of a path, and the path within it; a path without ``://`` is a mounted one."""
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def _scan(folder: str) -> Iterator[tuple[str, str, int, bool]]:
    """Path, name, size and kind of what is directly in a folder; nothing if it cannot be opened.

    An entry that is gone by the time it is looked at is left out alone; a listing that breaks off in the middle is an
    error, never a part of the folder.
    """
    if "://" not in folder:
        try:
            entries = os.scandir(folder)
        except OSError:
            return
        with entries:
            for entry in entries:
                try:
                    is_folder = entry.is_dir(follow_symlinks=False)
                    size = 0 if is_folder else entry.stat().st_size
                    wanted = is_folder or entry.is_file()
                except OSError:
                    continue
                if wanted:
                    yield entry.path, entry.name, size, is_folder
        return
    try:
        store, inner = _filesystem(folder)
        found = store.get_file_info(fs.FileSelector(inner))
    except OSError:
        return
    base = folder[: len(folder) - len(inner)]
    for info in found:
        if info.type in (fs.FileType.File, fs.FileType.Directory):
            yield base + info.path, info.base_name, info.size or 0, info.type == fs.FileType.Directory


def _scan_folders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["original_path", "file_name", "file_size_bytes", "is_folder"]
    types = [pa.string(), pa.string(), pa.int64(), pa.bool_()]

    def batch_of(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types)], names)

    for batch in batches:
        entries = itertools.chain.from_iterable(map(_scan, batch.column(0).to_pylist()))
        while found := list(itertools.islice(entries, _ENTRIES_PER_BATCH)):
            yield batch_of(found)


def list_files(
    spark: SparkSession, roots: Sequence[str], pattern: str = "*", recursive: bool = True
) -> DataFrame:
    """Files under directories, once for each root; a folder that cannot be read gives no rows.

    Spark's own binary-file reader keeps its file index on the driver and leaves out empty files, so
    the folders are read on the executors instead: one job per level of the tree, each folder of the
    level a row, the entries found stored before the next level starts.
    """
    tasks = spark.sparkContext.defaultParallelism
    folders = spark.createDataFrame([(_mounted(r),) for r in roots], "folder string")
    found = spark.createDataFrame([], schemas.FILE_REFS).drop("metadata")
    schema = "original_path string, file_name string, file_size_bytes long, is_folder boolean"
    while not folders.isEmpty():
        entries = durable(folders.repartition(tasks, "folder").mapInArrow(_scan_folders, schema))
        found = found.unionByName(entries.filter(~F.col("is_folder")).drop("is_folder"))
        if not recursive:
            break
        folders = entries.filter("is_folder").select(F.col("original_path").alias("folder"))
    return found.filter(matches_pattern(F.col("file_name"), pattern)).withColumn(
        "metadata", F.create_map().cast("map<string,string>")
    )


def fetch_file(path: str) -> bytes:
    """Bytes of a file on any file system Arrow knows."""
    store, inner = _filesystem(_mounted(path))
    with store.open_input_stream(inner, compression=None) as stream:
        return stream.read()


def _modified_at(path: str):
    store, inner = _filesystem(_mounted(path))
    return store.get_file_info(inner).mtime


def _spread(df: DataFrame, path: str, bytes_per_task: int) -> DataFrame:
    """Rows dealt over enough tasks that each reads about ``bytes_per_task``.

    The number is explicit because runtime re-planning would judge these rows by their own few bytes
    and merge them into one task. Documents to be loaded are dealt by ranges of file name, so that
    files written by these tasks, and by narrow steps after them, each hold a short range of names.
    """
    total = df.agg(F.coalesce(F.sum("file_size_bytes"), F.lit(0))).first()[0]
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-int(total) // bytes_per_task))
    if "batch_id" in df.columns:
        return df.repartitionByRange(tasks, "file_name", path).sortWithinPartitions("file_name", path)
    return df.repartition(tasks, path)


def read_bytes(
    df: DataFrame,
    path: str = "original_path",
    fetch: Fetch | None = None,
    keep_content: bool = True,
    bytes_per_task: int = 256 * 1024 * 1024,
) -> DataFrame:
    """Read the file each row points to, in the task that holds the row.

    Adds ``content`` (unless only the hash is wanted), ``modified_at``, ``bytes_read``, ``read_hash``
    and ``read_error``: a file that cannot be read fills ``read_error`` and leaves the others NULL.
    ``fetch`` replaces the plain file read, for stores with an access method of their own. Bytes go
    to Spark in batches of bounded size, whatever the number of files.
    """
    fetch = fetch or fetch_file
    added = [
        T.StructField("modified_at", T.TimestampType()),
        T.StructField("bytes_read", T.LongType()),
        T.StructField("read_hash", T.StringType()),
        T.StructField("read_error", T.StringType()),
    ]
    if keep_content:
        added.append(T.StructField("content", T.BinaryType()))
    schema = T.StructType([*df.schema.fields, *added])
    timestamped = fetch is fetch_file

    def read_one(file_path: str) -> dict:
        row = dict.fromkeys([f.name for f in added])
        try:
            content = fetch(file_path)
            row["bytes_read"] = len(content)
            row["read_hash"] = hashlib.md5(content).hexdigest()
            if timestamped:
                row["modified_at"] = _modified_at(file_path)
            if keep_content:
                row["content"] = content
        except Exception as error:
            row["read_error"] = str(error)[:ERROR_LENGTH] or type(error).__name__
        return row

    def with_bytes(batch: pa.RecordBatch, rows: list[dict]) -> pa.RecordBatch:
        columns = list(batch.columns)
        arrow_types = {
            "modified_at": pa.timestamp("us", tz="UTC"),
            "bytes_read": pa.int64(),
            "read_hash": pa.string(),
            "read_error": pa.string(),
            "content": pa.binary(),
        }
        for field in added:
            columns.append(pa.array([r[field.name] for r in rows], arrow_types[field.name]))
        return pa.RecordBatch.from_arrays(columns, [*batch.schema.names, *[f.name for f in added]])

    def read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, rows, held = 0, [], 0
            for at, file_path in enumerate(batch.column(path).to_pylist()):
                rows.append(read_one(file_path))
                held += len(rows[-1].get("content") or b"")
                if held >= _FLUSH_BYTES:
                    yield with_bytes(batch.slice(start, len(rows)), rows)
                    start, rows, held = at + 1, [], 0
            if rows:
                yield with_bytes(batch.slice(start, len(rows)), rows)

    return _spread(df, path, bytes_per_task).mapInArrow(read_batches, schema)


def stage_with_isolation(
    files: DataFrame, fetch: Fetch | None = None, unreadable: str = "fail", **spread: int
) -> DataFrame:
    """Hash every listed file on the executors, keeping each file's failure to itself.

    ``files`` carries ``staging_path`` (the original path where files are read in place). A file that
    cannot be read gets ``sync_error``; with ``unreadable="empty_hash"`` it counts as staged with an
    empty hash instead, as files read in place do.
    """
    if unreadable not in ("fail", "empty_hash"):
        raise ValueError("unreadable must be 'fail' or 'empty_hash'")
    if "staging_path" not in files.columns:
        files = files.withColumn("staging_path", F.col("original_path"))
    listed = files.select("source_name", "original_path", "staging_path", "file_name", "file_size_bytes")
    read = read_bytes(listed, "original_path", fetch, keep_content=False, **spread)
    error = F.col("read_error") if unreadable == "fail" else F.lit(None).cast("string")
    return read.select(
        "source_name",
        "original_path",
        F.when(error.isNull(), F.col("staging_path")).alias("staging_path"),
        "file_name",
        F.coalesce("bytes_read", "file_size_bytes").alias("file_size_bytes"),
        F.when(error.isNull(), F.coalesce("read_hash", F.lit(""))).alias("content_hash"),
        error.alias("sync_error"),
    )


def load_raw(
    to_process: DataFrame,
    run_id: str,
    ingested_at: str | None = None,
    on_unreadable: str = "fail",
    fetch: Fetch | None = None,
    **spread: int,
) -> DataFrame:
    """Rows of ``raw_documents``: the chosen files with their bytes.

    ``to_process`` is metadata only, so nothing heavier than a path is shuffled: ``source_path`` as
    recorded, ``original_path`` to read. The recorded size stays that of the registry. A file that has
    become unreadable fails the job, is left out with ``on_unreadable="skip"``, or stays without content and
    hash, and with its ``read_error`` in a column more, with ``"failed"``. Empty files are kept.
    """
    if on_unreadable not in ("fail", "skip", "failed"):
        raise ValueError("on_unreadable must be 'fail', 'skip' or 'failed'")
    read = read_bytes(to_process, "original_path", fetch, keep_content=True, **spread)
    if on_unreadable == "failed":
        pass
    elif on_unreadable == "skip":
        read = read.filter(F.col("read_error").isNull())
    else:
        failure = F.raise_error(F.concat_ws(": ", "original_path", "read_error")).cast("binary")
        read = read.withColumn("content", F.when(F.col("read_error").isNull(), F.col("content")).otherwise(failure))
    now = F.current_timestamp() if ingested_at is None else F.to_timestamp(F.lit(ingested_at))
    batch = F.col("batch_id") if "batch_id" in to_process.columns else F.lit(None).cast("int")
    return read.select(
        "source_name",
        "source_path",
        "file_name",
        "file_size_bytes",
        F.col("modified_at").alias("source_modified_at"),
        "content",
        F.col("read_hash").alias("content_hash"),
        now.alias("ingested_at"),
        F.lit(run_id).alias("pipeline_run_id"),
        batch.alias("batch_id"),
        *(["read_error"] if on_unreadable == "failed" else []),
    )
