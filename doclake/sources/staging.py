"""Where a listed file is staged."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def assign_staging_path(files: DataFrame, staged: DataFrame, base: str) -> DataFrame:
    """Add ``staging_path`` under ``base/source`` and the final ``file_name`` to listed files.

    ``files`` has ``source_name, original_path, file_name, content_hash``; ``staged`` is what is
    staged already, ``source_name, original_path, staging_path, file_name``. A file staged before
    keeps its path. A new one takes its plain name if no other file of the source holds it, in the
    order of original paths; the rest become ``stem_<first 8 of the hash>.ext``, and where that is held
    too (copies of one file), ``stem_<first 8 of the hash>_<first 8 of the md5 of the original path>.ext``.

    The holder of each name is one partial aggregate, and the joins match single files (source and
    original path), so a name that very many files share never gathers in one task.
    """
    new = files.select("source_name", "file_name", F.lit(1).alias("turn"), "original_path")
    held = staged.select("source_name", "file_name", F.lit(0).alias("turn"), "original_path")
    holders = (
        held.unionByName(new)
        .groupBy("source_name", "file_name")
        .agg(F.min(F.struct("turn", "original_path")).alias("first"))
        .select("source_name", "file_name", "first.original_path", F.lit(True).alias("holds_name"))
    )
    before = staged.groupBy("source_name", "original_path").agg(
        F.max(F.struct("staging_path", "file_name")).alias("before")
    )
    key = ["source_name", "original_path"]

    # The ending is the last dot and what follows it; dots that lead the name belong to the stem.
    name = F.col("file_name")
    ending = F.regexp_extract(name, r"(?s)\A\.*[^.].*?(\.[^.]*)\z", 1)
    stem = F.left(name, F.length(name) - F.length(ending))
    hashed = F.concat(stem, F.lit("_"), F.substring("content_hash", 1, 8), ending)
    plain_or_hashed = F.when(F.col("holds_name"), name).otherwise(hashed)
    folder = F.concat(F.lit(base.rstrip("/") + "/"), F.col("source_name"), F.lit("/"))
    apart = F.concat(stem, F.lit("_"), F.substring("content_hash", 1, 8), F.lit("_"), F.substring(F.md5("original_path"), 1, 8), ending)
    named = (
        files.join(holders, [*key, "file_name"], "left")
        .join(before, key, "left")
        .withColumn("candidate", F.coalesce("before.file_name", plain_or_hashed))
    )
    # The same once more for the names given: who of those that want one may have it.
    wanted = named.select("source_name", F.col("candidate").alias("file_name"), F.when(F.col("before").isNull(), 1).otherwise(0).alias("turn"), "original_path")
    takers = (
        held.unionByName(wanted)
        .groupBy("source_name", "file_name")
        .agg(F.min(F.struct("turn", "original_path")).alias("first"))
        .select("source_name", F.col("file_name").alias("candidate"), "first.original_path", F.lit(True).alias("takes_name"))
    )
    final = F.when(F.col("before").isNotNull() | F.col("takes_name"), F.col("candidate")).otherwise(apart)
    return (
        named.join(takers, [*key, "candidate"], "left")
        .withColumn("file_name", final)
        .withColumn("staging_path", F.coalesce(F.col("before.staging_path"), F.concat(folder, "file_name")))
        .select(*files.columns, "staging_path")
    )
