"""Global ranks and balanced batches without gathering the rows in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from doclake.session import durable

# monotonically_increasing_id puts the partition above this bit and the row's place in it below.
_ROW_BITS = 33


def largest_first() -> list[Column]:
    """The batching order: size descending, then path."""
    return [F.desc("file_size_bytes"), F.asc("source_path")]


def _ranked(df: DataFrame, order: Sequence[Column], name: str) -> tuple[DataFrame, int]:
    placed = durable(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    part = F.shiftright("_place", _ROW_BITS)
    # One row per non-empty partition, so never more than the number of shuffle partitions.
    counts = sorted(tuple(r) for r in placed.groupBy(part.alias("part")).count().collect())
    offsets, total = [], 0
    for index, count in counts:
        offsets.append((index, total))
        total += count
    starts = df.sparkSession.createDataFrame(offsets, "_part long, _start long")
    within = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    ranked = placed.join(F.broadcast(starts), part == F.col("_part")).withColumn(
        name, F.col("_start") + within + 1
    )
    return ranked.drop("_place", "_part", "_start"), total


def global_rank(df: DataFrame, order_by: Sequence[Column] | None = None, name: str = "rn") -> DataFrame:
    """1-based rank of every row in ``order_by``, which should order the rows fully.

    The rows are range-partitioned and sorted once; a rank is the number of rows in earlier partitions
    plus the place in the own one. A value that very many rows share is split by the later order
    columns. The placed rows are stored between the two passes, since a range sample taken again
    might place them differently. Runs jobs when called; pass metadata, not file contents.
    """
    return _ranked(df, order_by or largest_first(), name)[0]


def assign_batches(raw: DataFrame, batch_size: int, how: str = "round_robin") -> DataFrame:
    """Add ``batch_id``, from 1, to the documents.

    ``round_robin`` deals the documents, largest first, over ``ceil(count / batch_size)`` batches so
    each has its share of large ones; ``contiguous`` cuts the same order every ``batch_size`` rows.
    """
    if batch_size < 1:
        raise ValueError("batch_size must be at least 1")
    ranked, total = _ranked(raw, largest_first(), "_rn")
    before = F.col("_rn") - 1
    if how == "round_robin":
        batch = before % F.lit(max(1, -(-total // batch_size)))
    elif how == "contiguous":
        batch = F.floor(before / batch_size)
    else:
        raise ValueError("how must be 'round_robin' or 'contiguous'")
    return ranked.withColumn("batch_id", (batch + 1).cast("int")).drop("_rn")


def batch_balance(raw: DataFrame) -> DataFrame:
    """Documents and bytes per batch, in batch order."""
    return (
        raw.groupBy("batch_id")
        .agg(F.count(F.lit(1)).alias("documents"), F.sum("file_size_bytes").alias("total_bytes"))
        .orderBy("batch_id")
    )
