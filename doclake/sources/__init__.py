"""Sources: listings of files as DataFrames, staging names, and byte reads on executors."""

from doclake.sources.files import list_files, load_raw, read_bytes, stage_with_isolation
from doclake.sources.manifests import (
    files_from_blob_manifest,
    files_from_library_manifest,
    files_from_tree_manifest,
    folder_closure,
)
from doclake.sources.reader import read_source, register_source, supported_types
from doclake.sources.roots import resolve_roots
from doclake.sources.staging import assign_staging_path

__all__ = [
    "assign_staging_path",
    "files_from_blob_manifest",
    "files_from_library_manifest",
    "files_from_tree_manifest",
    "folder_closure",
    "list_files",
    "load_raw",
    "read_bytes",
    "read_source",
    "register_source",
    "resolve_roots",
    "stage_with_isolation",
    "supported_types",
]
