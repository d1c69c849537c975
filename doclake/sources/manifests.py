"""Listings held as manifest tables: object stores, folder trees and document libraries.

A manifest is one scan however many roots are asked for: each row is matched against the given list
of roots and repeated once per match, so overlapping roots list a file as often as separate scans
would, and the combined root condition still reaches the Parquet reader.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from doclake.functions.patterns import matches_pattern
from doclake.session import durable

# The file types a folder tree offers, and the native documents it exports with the
# ending they get.
SUPPORTED_MIME_TYPES = [
    "application/pdf",
    "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    "application/msword",
    "application/vnd.openxmlformats-officedocument.presentationml.presentation",
    "application/vnd.ms-powerpoint",
    "image/jpeg",
    "image/png",
]
EXPORT_ENDINGS = {
    "application/vnd.google-apps.document": ".docx",
    "application/vnd.google-apps.presentation": ".pptx",
}
FOLDER_MIME_TYPE = "application/vnd.google-apps.folder"


def _metadata(**values: Column) -> Column:
    return F.create_map(*[part for k, v in values.items() for part in (F.lit(k), v)])


def _per_root(df: DataFrame, roots: Sequence[str], under: Callable[[Column], Column]) -> DataFrame:
    """Rows of ``df`` once for each root for which ``under(root)`` holds, with that ``root``."""
    any_root = reduce(lambda found, r: found | under(F.lit(r)), dict.fromkeys(roots), F.lit(False))
    listed = F.array(*[F.lit(r) for r in roots]).cast("array<string>")
    return df.filter(any_root).withColumn("root", F.explode_outer(F.filter(listed, under)))


def _slashes(path: Column) -> Column:
    return F.size(F.split(path, "/")) - 1


def files_from_blob_manifest(
    manifest: DataFrame,
    prefixes: Sequence[str] = ("",),
    pattern: str = "*",
    recursive: bool = True,
    container: str = "",
    account: str = "",
) -> DataFrame:
    """Files of an object-store inventory ``(name, size)`` under the prefixes, empty objects left out.

    Without ``recursive``, a name may have no more slashes than its prefix.
    """
    roots = [f"{p}/" if p else "" for p in prefixes]
    under = _per_root(manifest.filter(F.col("size") != 0), roots, lambda r: F.startswith(F.col("name"), r))
    if not recursive:
        under = under.filter(_slashes(F.col("name")) <= _slashes(F.col("root")))
    base = f"abfss://{container}@{account}.dfs.core.windows.net/"
    return (
        under.withColumn("file_name", F.element_at(F.split("name", "/"), -1))
        .filter(matches_pattern(F.col("file_name"), pattern))
        .select(
            F.concat(F.lit(base), "name").alias("original_path"),
            "file_name",
            F.col("size").cast("long").alias("file_size_bytes"),
            _metadata(blob_name=F.col("name")).alias("metadata"),
        )
    )


def folder_closure(folders: DataFrame, root_ids: Sequence[str]) -> DataFrame:
    """All folders at or below each root, as ``(id)`` rows; a folder reached twice appears twice.

    ``folders`` is ``(id, parent)``. One join per level of the tree, each level stored before the
    next: the work is that of the folders reached, and the number of jobs that of the depth. A tree may
    be as deep as it has folders; one that seems deeper runs in a circle, which is an error.
    """
    spark = folders.sparkSession
    edges = folders.select("id", "parent")
    level = spark.createDataFrame([(r,) for r in root_ids], "id string")
    levels = [level]
    deepest = edges.select("id").distinct().count()
    for _ in range(deepest + 1):
        parents = level.select(F.col("id").alias("parent"))
        level = durable(edges.join(parents, "parent").select("id"))
        if level.isEmpty():
            return reduce(DataFrame.unionByName, levels)
        levels.append(level)
    raise ValueError("the folders form a cycle")


def files_from_tree_manifest(
    manifest: DataFrame, root_ids: Sequence[str], pattern: str = "*", recursive: bool = True
) -> DataFrame:
    """Files of a folder tree ``(id, parent, name, mime, size)`` under the root folders.

    Exportable documents get their export ending unless they have it; unsupported types are left out.
    """
    if recursive:
        is_folder = F.col("mime") == FOLDER_MIME_TYPE
        parents = folder_closure(manifest.filter(is_folder), root_ids)
    else:
        parents = manifest.sparkSession.createDataFrame([(r,) for r in root_ids], "id string")
    # The only repeats in this join are folders reached more than once; a folder holding a large
    # share of all files is a hot key on the file side, which runtime re-planning splits.
    files = manifest.filter(F.col("mime").isin(*SUPPORTED_MIME_TYPES, *EXPORT_ENDINGS)).join(
        parents.select(F.col("id").alias("parent")), "parent"
    )
    ending = F.element_at(F.create_map(*[F.lit(x) for kv in EXPORT_ENDINGS.items() for x in kv]), F.col("mime"))
    return (
        files.withColumn("ending", F.coalesce(ending, F.lit("")))
        .withColumn(
            "file_name",
            F.when(F.endswith("name", "ending"), F.col("name")).otherwise(F.concat("name", "ending")),
        )
        .filter(matches_pattern(F.col("file_name"), pattern))
        .select(
            F.concat(F.lit("gdrive://"), "id").alias("original_path"),
            "file_name",
            F.coalesce(F.col("size").cast("long"), F.lit(0).cast("long")).alias("file_size_bytes"),
            _metadata(file_id=F.col("id"), mime_type=F.col("mime")).alias("metadata"),
        )
    )


def files_from_library_manifest(
    manifest: DataFrame, folders: Sequence[str] = ("",), pattern: str = "*", recursive: bool = True
) -> DataFrame:
    """Files of a document library ``(parent_path, name, kind, size)`` in the folders.

    Paths spell the tree out, so "below a folder" is a prefix condition and needs no traversal. The
    path of a file is ``folder/name``, hence ``/name`` for a file at the root of the library.
    """
    parent = F.col("parent_path")

    def inside(root: Column) -> Column:
        if not recursive:
            return parent == root
        return (root == "") | (parent == root) | F.startswith(parent, F.concat(root, F.lit("/")))

    path = F.concat(parent, F.lit("/"), F.col("name"))
    return (
        _per_root(manifest.filter(F.col("kind") == "file"), folders, inside)
        .filter(matches_pattern(F.col("name"), pattern))
        .select(
            path.alias("original_path"),
            F.col("name").alias("file_name"),
            F.coalesce(F.col("size").cast("long"), F.lit(0).cast("long")).alias("file_size_bytes"),
            _metadata(sp_path=path).alias("metadata"),
        )
    )
