"""Stored intermediate tables, column choice and batch slicing shared by the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession

from doclake.session import ensure_checkpoint_dir


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name below the checkpoint folder that the driver and all executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: cuts lineage, keeps column sizes known."""
    folder = shared_folder(df.sparkSession, name)
    df.write.options(**options).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the text of ``column`` in one piece is about ``most`` bytes, a single row at least."""
    for batch in batches:
        start, size = 0, 0
        for i, n in enumerate(pa.compute.binary_length(batch[column]).fill_null(0).to_pylist()):
            if size and size + n > most:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        if start < batch.num_rows:
            yield batch.slice(start)
