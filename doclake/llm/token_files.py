"""Token ids in Parquet list columns: ordered files that are read selectively, by document or by column.

Ids are encoded once and lie in ascending document order over the files. Each row holds one document: where it starts,
how many ids it has, and the ids as a list column with delta (or dictionary) encoding. Row groups and pages are kept
small enough that the column and offset indexes of a file lead a reader to the pages of the documents asked for.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from doclake.llm.common import slices
from doclake.llm.tokens import encoder

SCHEMA = T.StructType(
    [
        T.StructField("part", T.IntegerType()),
        T.StructField("place", T.LongType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
    ]
)


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int | None,
    encoding: str = "delta",
    row_group_bytes: int = 16 << 20,
    page_bytes: int = 64 << 10,
) -> None:
    """Encode ``docs (doc_id, text)`` by the tokenizer file and write them to ``folder`` in ascending document order.

    A null text is empty; ``end_id``, unless None, closes every document. Rows without a doc_id come first; rows of
    one doc_id are ordered by their text, and repeated rows are all written. Other columns are left out. An empty table
    gives files without rows. ``part`` numbers the files in order and ``place`` counts the ids of the documents before in
    the same file, so a document's place in the corpus needs the sizes of the parts alone. Tasks write through Spark's
    commit protocol: a lost executor's files are written anew.
    """
    if encoding not in ("delta", "dictionary"):
        raise ValueError("encoding is delta or dictionary")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, place = encoder(tokenizer), TaskContext.get().partitionId(), 0
        for batch in slices(batches, "text"):
            ids, counts = coder.encode(batch["text"])
            if end_id is not None:
                ids = np.insert(ids.astype(np.int32), np.cumsum(counts), end_id)
                counts = counts + 1
            ends = np.cumsum(counts)
            lists = pa.ListArray.from_arrays(np.concatenate([[0], ends]).astype(np.int32), pa.array(ids.astype(np.int32, copy=False)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(counts), part, np.int32)),
                    pa.array(place + ends - counts),
                    batch["doc_id"],
                    pa.array(counts),
                    lists,
                ],
                names=SCHEMA.names,
            )
            place += int(ends[-1])

    options = {
        "compression": "zstd",
        "parquet.writer.version": "PARQUET_2_0",
        "parquet.block.size": row_group_bytes,
        "parquet.page.size": page_bytes,
        "parquet.enable.dictionary": "false",
        "parquet.enable.dictionary#ids.list.element": str(encoding == "dictionary").lower(),
    }
    (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
        .repartitionByRange(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), "text")
        .mapInArrow(encode, SCHEMA)
        .write.options(**options)
        .parquet(folder)
    )


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Rows ``(doc_id, start, n_tokens, ids)``: ``start`` counts the ids of all documents before in the corpus.

    Filters on ``doc_id`` and the choice of columns reach the files. What is broadcast is one row per part.
    """
    rows = spark.read.schema(SCHEMA).parquet(folder)
    sizes = rows.groupBy("part").agg(F.sum("n_tokens").alias("size")).collect()  # one row per file
    starts, total = [], 0
    for part, size in sorted(sizes):
        starts.append((part, total))
        total += size
    base = spark.createDataFrame(starts, "part int, base long")
    return rows.join(F.broadcast(base), "part").select(
        "doc_id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "ids"
    )


def id_checksums(tokens: DataFrame, width: str = "<u4") -> DataFrame:
    """``tokens`` with ``ids`` replaced by their number ``n_tokens`` and unsigned ``ids_crc32``, read in Arrow batches."""
    kept = [c for c in tokens.columns if c not in ("ids", "n_tokens")]
    schema = T.StructType(
        [tokens.schema[c] for c in kept] + [T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())]
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["ids"]
            flat = np.asarray(lists.values).astype(width, copy=False)
            at = np.asarray(lists.offsets)
            crc = [zlib.crc32(flat[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in kept), pa.array(np.diff(at).astype(np.int64)), pa.array(crc, pa.int64())],
                names=schema.names,
            )

    return tokens.select(*kept, "ids").mapInArrow(digest, schema)
