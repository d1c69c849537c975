"""Sets of word shingles as hashed numbers, for the operators that compare texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit number for each one (the finisher of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: pa.Array) -> Iterator[np.ndarray]:
    """For each text the hashes of its words in order: A-Z in lower case, cut at ASCII white space. Null is empty."""
    trimmed = pc.ascii_trim_whitespace(pc.ascii_lower(texts.fill_null("")))
    lists = pc.ascii_split_whitespace(trimmed)
    coded = lists.flatten().dictionary_encode()
    distinct = coded.dictionary.to_pylist()
    table = np.fromiter(map(xxhash.xxh3_64_intdigest, distinct), np.uint64, len(distinct))
    flat = table[coded.indices.to_numpy(zero_copy_only=False)] if len(distinct) else np.zeros(0, np.uint64)
    at = lists.offsets.to_numpy()
    empty = pc.equal(trimmed, "").to_numpy(zero_copy_only=False)
    for i in range(len(texts)):
        yield flat[:0] if empty[i] else flat[at[i] : at[i + 1]]


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the ``size`` words from each place; of the whole sequence if it is shorter."""
    n = len(words)
    if not n:
        return words
    size = min(size, n)
    found, factor = np.full(n - size + 1, np.uint64(size)), np.uint64(1)
    for i in range(size):
        found += words[i : n - size + 1 + i] * factor
        factor = np.uint64(int(factor) * int(_ODD) % (1 << 64))
    return mix(found)


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """The distinct ones of :func:`shingle_hashes`, sorted."""
    return np.unique(shingle_hashes(words, size))
