"""Joining rows that may share a hot key with a side reduced to one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

_HASH = "_key_hash"


def join_reduced(left: DataFrame, reduced: DataFrame, on: str | Sequence[str], how: str) -> DataFrame:
    """``left`` joined with ``reduced``, which was aggregated by ``on``; inner, left, semi or anti.

    A key that a large share of ``left`` has would fill one task. Runtime re-planning splits such a
    task, but only where both sides of the join come straight from a shuffle of their own, and a side
    just aggregated by the join key does not. Joining on a hash of the key as well as on the key makes
    Spark shuffle the reduced side for the join, at the price of moving its few rows once more.
    """
    keys = [on] if isinstance(on, str) else list(on)
    hashed = F.xxhash64(*keys)
    return left.withColumn(_HASH, hashed).join(reduced.withColumn(_HASH, hashed), [*keys, _HASH], how).drop(_HASH)
