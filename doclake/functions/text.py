"""Search predicate, content preview and size conversion."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

BYTES_PER_MB = 1024 * 1024


def matches_search(q: str, *columns: Column, literal: bool = False) -> Column:
    """Case-insensitive substring search over any of ``columns``; a blank ``q`` keeps every row.

    ``%`` and ``_`` in ``q`` act as wildcards unless ``literal``.
    """
    if not q.strip():
        return F.lit(True)
    needle = F.lower(F.lit(q if literal else f"%{q}%"))
    hits = [F.contains(F.lower(c), needle) if literal else F.like(F.lower(c), needle) for c in columns]
    return reduce(lambda a, b: a | b, hits)


def preview(content: Column, description: Column, n: int = 200, ellipsis: bool = False) -> Column:
    """First ``n`` characters of the content, else of the description, else "No content"."""
    text = F.coalesce(
        F.nullif(F.substring(content, 1, n), F.lit("")),
        F.nullif(F.substring(description, 1, n), F.lit("")),
        F.lit("No content"),
    )
    if not ellipsis:
        return text
    return F.concat(text, F.when(F.length(content) > n, F.lit("...")).otherwise(F.lit("")))


def mb(size_bytes: Column) -> Column:
    """Bytes as megabytes."""
    return size_bytes / F.lit(float(BYTES_PER_MB))
