"""Row identities: registry id, log id, content hash, listed path."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F


def document_id(source_name: Column, original_path: Column) -> Column:
    """Registry id of a file: md5 of ``source:path``."""
    return F.md5(F.concat(source_name, F.lit(":"), original_path))


def log_id(source_path: Column) -> Column:
    """Log id of a document: md5 of its path alone, so it never equals a registry id."""
    return F.md5(source_path)


def content_hash(content: Column, algo: str = "md5") -> Column:
    """Hex hash of the bytes; the empty string where there are none to read."""
    if algo == "md5":
        digest = F.md5(content)
    elif algo == "sha256":
        digest = F.sha2(content, 256)
    else:
        raise ValueError(f"unknown hash {algo!r}; use md5 or sha256")
    return F.coalesce(digest, F.lit(""))


def strip_scheme(path: Column, scheme: str = "dbfs") -> Column:
    """Drop one leading ``scheme:`` from a path."""
    return F.regexp_replace(path, "^" + re.escape(scheme) + ":", "")
