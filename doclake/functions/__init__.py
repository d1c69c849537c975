"""Column functions: built-in Spark expressions only, so they stay inside generated code."""

from doclake.functions.identity import content_hash, document_id, log_id, strip_scheme
from doclake.functions.patterns import matches_pattern
from doclake.functions.payload import has_parse_errors, payload_items, payload_size
from doclake.functions.text import matches_search, mb, preview

__all__ = [
    "content_hash",
    "document_id",
    "has_parse_errors",
    "log_id",
    "matches_pattern",
    "matches_search",
    "mb",
    "payload_items",
    "payload_size",
    "preview",
    "strip_scheme",
]
