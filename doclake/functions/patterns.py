"""File-name patterns as Spark predicates."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# A character set, whose first member may be a closing bracket, or any one character.
_TOKEN = re.compile(r"\[!?+\]?+[^\]]*\]|.", re.DOTALL)
_RANGE = re.compile(r"(.)-(.)", re.DOTALL)


def _regex_of(token: str) -> str:
    if token == "*":
        return ".*"
    if token == "?":
        return "."
    if len(token) > 1:
        negated = token.startswith("[!")
        members = token[2 if negated else 1 : -1]
        # A range that runs backwards holds nothing.
        members = _RANGE.sub(lambda r: r[0] if r[1] <= r[2] else "", members)
        if not members:
            return "." if negated else "(?!)"
        return ("[^" if negated else "[") + re.sub(r"([\\\[\]^&])", r"\\\1", members) + "]"
    return re.sub(r"([^\w\s])", r"\\\1", token)


def glob_regex(pattern: str) -> str:
    """A shell glob as an anchored Java regular expression."""
    return r"(?s)\A" + "".join(_regex_of(t) for t in _TOKEN.findall(pattern)) + r"\z"


def matches_pattern(name: Column, pattern: str) -> Column:
    """Whether a file name fits ``pattern``, letting suffix patterns push down to the scan.

    ``*.{a,b}`` means the lower-cased name ends with ``.a`` or ``.b``; the listed endings keep their
    case, so an upper-case one matches nothing. Any other pattern is a shell glob, with both sides
    lower-cased.
    """
    lowered = F.lower(name)
    if pattern.startswith("*.{") and pattern.endswith("}"):
        found = F.lit(False)
        for ending in pattern[3:-1].split(","):
            found = found | lowered.endswith("." + ending.strip())
        return found
    pattern = pattern.lower()
    if pattern == "*":
        return name.isNotNull()
    if pattern.startswith("*") and not re.search(r"[*?\[]", pattern[1:]):
        return lowered.endswith(pattern[1:])
    return lowered.rlike(glob_regex(pattern))
