"""Reading the self-describing parse result (VARIANT)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

ELEMENTS = "$.document.elements"
PAGES = "$.document.pages"
ERRORS = "$.error_status"


def payload_size(value: Column, path: str) -> Column:
    """Length of the array at ``path``; NULL where it is missing or not an array.

    Items are read as empty structs, so that none of their content is copied.
    """
    return F.array_size(F.try_variant_get(value, path, "array<struct<>>"))


def payload_items(value: Column, path: str, *fields: str) -> Column:
    """The array at ``path`` with its items cut into ``fields``, each still of any kind; NULL where there is no array.

    One extraction whatever the fields. An item that is no object has none of them and is NULL, a missing field is NULL;
    :func:`payload_field` then casts the fields that are wanted.
    """
    return F.try_variant_get(value, path, f"array<struct<{','.join(f'{f}:variant' for f in fields)}>>")


def payload_field(value: Column, kind: str, on_error: str = "raise") -> Column:
    """A field as ``kind``. A value that cannot be cast raises, or becomes NULL with ``on_error="null"``."""
    if on_error not in ("raise", "null"):
        raise ValueError("on_error must be 'raise' or 'null'")
    return (F.variant_get if on_error == "raise" else F.try_variant_get)(value, "$", kind)


def has_parse_errors(parsed_output: Column) -> Column:
    """True where the document lists at least one error."""
    return F.coalesce(payload_size(parsed_output, ERRORS) > 0, F.lit(False))
