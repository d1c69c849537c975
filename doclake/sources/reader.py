"""Choosing a reader by source type."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from doclake.sources.files import list_files
from doclake.sources.manifests import (
    files_from_blob_manifest,
    files_from_library_manifest,
    files_from_tree_manifest,
)
from doclake.sources.roots import resolve_roots

Reader = Callable[[SparkSession, Mapping[str, Any]], DataFrame]


def _manifest(spark: SparkSession, source: Mapping[str, Any]) -> DataFrame:
    manifest = source["manifest"]
    if isinstance(manifest, DataFrame):
        return manifest
    return spark.read.parquet(manifest) if "/" in manifest else spark.table(manifest)


def _names(source: Mapping[str, Any]) -> dict[str, Any]:
    return {"pattern": source.get("file_pattern", "*"), "recursive": source.get("recursive", True)}


def _volume(spark: SparkSession, source: Mapping[str, Any]) -> DataFrame:
    return list_files(spark, resolve_roots(source.get("paths"), source.get("path")), **_names(source))


def _blobs(spark: SparkSession, source: Mapping[str, Any]) -> DataFrame:
    return files_from_blob_manifest(
        _manifest(spark, source),
        resolve_roots(source.get("prefixes"), source.get("prefix"), [""], strip="/"),
        container=source.get("container", ""),
        account=source.get("storage_account", ""),
        **_names(source),
    )


def _library(spark: SparkSession, source: Mapping[str, Any]) -> DataFrame:
    return files_from_library_manifest(
        _manifest(spark, source),
        resolve_roots(source.get("folders"), source.get("folder"), [""], strip="/"),
        **_names(source),
    )


def _tree(spark: SparkSession, source: Mapping[str, Any]) -> DataFrame:
    roots = resolve_roots(source.get("folder_ids"), source.get("folder_id"))
    return files_from_tree_manifest(_manifest(spark, source), roots, **_names(source))


_READERS: dict[str, Reader] = {
    "volume": _volume,
    "adls": _blobs,
    "sharepoint": _library,
    "google_drive": _tree,
}


def supported_types() -> list[str]:
    """The source types a reader is known for."""
    return sorted(_READERS)


def register_source(kind: str, reader: Reader) -> None:
    """Add a reader, for example one over a Python data source of your own."""
    _READERS[kind] = reader


def read_source(spark: SparkSession, source: Mapping[str, Any]) -> DataFrame:
    """List a source described by ``source``; its ``type`` picks the reader, ``volume`` by default."""
    kind = source.get("type", "volume")
    if kind not in _READERS:
        raise ValueError(f"unknown source type {kind!r}; known types: {', '.join(supported_types())}")
    return _READERS[kind](spark, source)
