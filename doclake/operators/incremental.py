"""Which synced documents still need parsing."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from doclake.operators.joins import join_reduced
from doclake.operators.registry import synced_in_run


def not_yet_parsed(
    registry: DataFrame, parsed: DataFrame, run_id: str | None = None, mode: str = "parsed_hash"
) -> DataFrame:
    """Synced documents of the run whose content has not been parsed.

    ``parsed_hash`` compares a document parsed before with the hash it had at its latest parse, so a file
    edited in place comes up again, and once more when it is put back; a document never parsed is new
    unless its content was parsed under another path. The empty hash of an unreadable file equals
    nothing. ``registry_hash``
    compares with the hash the registry holds now for the parsed paths, so such a file is skipped.

    An anti join on equality, not NOT IN: the latter would have to broadcast every known hash. The
    known hashes are reduced to one row each first, so when one hash covers a large share of the
    candidates, only their side of the join has a hot key, and that can be split.
    """
    candidates = synced_in_run(registry, run_id)
    if mode == "registry_hash":
        paths = parsed.select(F.col("source_path").alias("staging_path"))
        known = registry.join(paths, "staging_path", "left_semi").select("content_hash")
    elif mode == "parsed_hash":
        when = [c for c in ("parsed_at", "pipeline_run_id") if c in parsed.columns]
        latest = parsed.groupBy(F.col("source_path").alias("staging_path")).agg(
            F.max(F.struct(*when, "content_hash")).alias("latest")
        )
        candidates = join_reduced(candidates, latest, "staging_path", "left")
        known = parsed.select("content_hash").filter(F.col("content_hash") != "")
    else:
        raise ValueError("mode must be 'parsed_hash' or 'registry_hash'")
    known = known.filter(F.col("content_hash").isNotNull()).distinct()
    if mode == "registry_hash":
        return join_reduced(candidates, known, "content_hash", "left_anti").select(*registry.columns)
    marked = join_reduced(candidates, known.withColumn("known", F.lit(True)), "content_hash", "left")
    readable = F.coalesce(F.col("content_hash") != "", F.lit(False))
    as_before = readable & F.col("content_hash").eqNullSafe(F.col("latest.content_hash"))
    seen = F.when(F.col("latest").isNotNull(), as_before).otherwise(F.coalesce("known", F.lit(False)))
    return marked.filter(~seen).select(*registry.columns)


def one_per_content(to_process: DataFrame) -> DataFrame:
    """Of several new documents with the same content, keep the one with the least path.

    The empty hash stands for unreadable files, which are all kept. The kept path of each content is
    a partial aggregate, and joined by path, so copies of one content never gather in a task.
    """
    first = to_process.groupBy("content_hash").agg(F.min("staging_path").alias("staging_path"))
    keepers = first.select("staging_path", F.lit(True).alias("_keep"))
    kept = to_process.join(keepers, "staging_path", "left").filter(F.col("_keep") | (F.col("content_hash") == ""))
    return kept.select(*to_process.columns)


def ingest_summary(registry: DataFrame, to_process: DataFrame, run_id: str | None = None) -> DataFrame:
    """Per run: documents synced, skipped as already parsed, and left to process."""
    synced = synced_in_run(registry, run_id).groupBy("pipeline_run_id").agg(F.count(F.lit(1)).alias("synced"))
    left = to_process.groupBy("pipeline_run_id").agg(F.count(F.lit(1)).alias("to_process"))
    to_do = F.coalesce("to_process", F.lit(0).cast("long"))
    return synced.join(left, "pipeline_run_id", "left").select(
        "pipeline_run_id",
        "synced",
        (F.col("synced") - to_do).alias("already_parsed"),
        to_do.alias("to_process"),
    )
