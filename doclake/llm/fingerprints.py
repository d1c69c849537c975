"""Document fingerprints by one-permutation MinHash with optimal densification and packed low-order bits.

Every word shingle is hashed once; the high bits name its bin, and each bin keeps its smallest hash. An empty bin takes the
value of the first non-empty one in a pseudo-random order of its own, the same for all documents, which keeps the share
of agreeing bins an unbiased estimate of the similarity even of short texts. A fingerprint stores the ``bits`` low bits of each
bin; two different values agree on those by chance one time in ``2 ** bits``, which the estimate corrects for.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, functions as F

from doclake.llm.common import slices
from doclake.llm.shingles import mix, shingle_hashes, word_hashes


@dataclass(frozen=True)
class Fingerprinter:
    """``bins`` (a power of two) of ``bits`` (1, 2, 4 or 8) low bits each, over shingles of ``words`` words."""

    bins: int = 512
    bits: int = 4
    words: int = 5

    def bin_values(self, words: np.ndarray) -> np.ndarray | None:
        """The low bits of each bin for the word hashes of a text; None without words."""
        if not len(words):
            return None
        hashes = np.sort(shingle_hashes(words, self.words))
        shift = np.uint64(64 - (self.bins.bit_length() - 1))
        first = np.searchsorted(hashes, np.arange(self.bins, dtype=np.uint64) << shift)
        smallest = hashes[np.minimum(first, len(hashes) - 1)]
        full = (smallest >> shift) == np.arange(self.bins, dtype=np.uint64)
        values = (mix(smallest) & np.uint64((1 << self.bits) - 1)).astype(np.uint8)
        empty, attempt = np.flatnonzero(~full), 0
        while len(empty):
            donor = _donors(self.bins, attempt)[empty]
            found = full[donor]
            values[empty[found]] = values[donor[found]]
            empty, attempt = empty[~found], attempt + 1
        return values

    def packed(self, values: np.ndarray | None) -> str:
        """Hexadecimal, bins in order; empty for a text without words."""
        if values is None:
            return ""
        per_byte = 8 // self.bits
        weights = np.uint8(1) << (np.arange(per_byte, dtype=np.uint8)[::-1] * np.uint8(self.bits))
        return (values.reshape(-1, per_byte) * weights).sum(axis=1, dtype=np.uint8).tobytes().hex()

    def likeness(self, a: np.ndarray | None, b: np.ndarray | None) -> float:
        """Estimated Jaccard similarity, 0 to 1, chance agreement of low bits taken out. Two texts without words are alike."""
        if a is None or b is None:
            return float(a is None and b is None)
        chance = 2.0**-self.bits
        return float(np.clip((np.mean(a == b) - chance) / (1 - chance), 0.0, 1.0))

    def unpacked(self, text: str) -> np.ndarray | None:
        """The bins of a stored fingerprint."""
        if not text:
            return None
        raw = np.frombuffer(bytes.fromhex(text), np.uint8)
        per_byte = 8 // self.bits
        shifts = np.arange(per_byte, dtype=np.uint8)[::-1] * np.uint8(self.bits)
        return ((raw[:, None] >> shifts) & np.uint8((1 << self.bits) - 1)).reshape(-1)


@cache
def _donors(bins: int, attempt: int) -> np.ndarray:
    """For each bin the one it asks at this attempt."""
    return (mix(np.arange(bins, dtype=np.uint64) + np.uint64((attempt + 1) * bins)) % np.uint64(bins)).astype(np.int64)


def fingerprints(docs: DataFrame, method: Fingerprinter = Fingerprinter()) -> DataFrame:
    """``docs`` with ``fingerprint``: packed low bits in hexadecimal, equal for equal texts, empty for a text without words.

    A null text has none. All rows and columns stay (an own column ``fingerprint`` is replaced).
    """

    @F.pandas_udf("string")
    def sign(texts):
        import pandas as pd

        return pd.Series([method.packed(method.bin_values(w)) for w in word_hashes(pa.Array.from_pandas(texts, type=pa.string()))])

    return docs.withColumn("fingerprint", sign(F.coalesce(F.col("text"), F.lit(""))))


_EDITED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, "
    "near_next double"
)


def compare_with_next(docs: DataFrame, method: Fingerprinter = Fingerprinter(), parts: int | None = None) -> DataFrame:
    """Each document's fingerprint beside those of its edited text and of the next document, in descending doc_id.

    The edited text has its last ``n_chars // 2`` code points replaced by the first as many, or all, of the next document;
    after the last comes the first. A null text is empty. Rows without doc_id come last, rows that share one are ordered by
    a hash of their text, then the text; a single row is its own next one. Other columns are left out.

    Rows are dealt out once, by ranges of doc_id, and sorted there; the first row of a range (found from the ids alone) is also
    sent to the range before, whose last row needs it. A task holds two texts at a time.
    """
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rank = F.coalesce(F.col("doc_id").cast("double"), F.lit(-1e300)).alias("rank")
    points = docs.select(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)] or [0.5], 10_000)).first()[0]
    splits = [-float("inf"), *sorted({float(p) for p in points or [0]}), float("inf")]
    ranged = Bucketizer(splits=splits, inputCol="rank", outputCol="range")
    ids = ranged.transform(docs.select("doc_id", rank)).groupBy("range").agg(F.max("doc_id").alias("top")).orderBy("range")
    tops = ids.collect()  # one row per range
    sends = [(r["range"], r["top"], tops[(i + 1) % len(tops)]["range"]) for i, r in enumerate(tops)]
    edges = spark.createDataFrame(sends, "range double, top long, before double")
    # A range's first row is the last one the range above it needs; ranges run upward, documents downward.
    dealt = ranged.transform(docs.withColumn("rank", rank)).join(F.broadcast(edges), "range")
    copies = F.array(F.struct(F.col("range").alias("target"), F.lit(False).alias("edge")))
    both = F.concat(copies, F.array(F.struct(F.col("before").alias("target"), F.lit(True).alias("edge"))))
    dealt = dealt.select("doc_id", "text", F.explode(F.when(F.col("doc_id").eqNullSafe(F.col("top")), both).otherwise(copies)).alias("to"))
    dealt = dealt.select(F.col("to.target").cast("int").alias("target"), F.col("to.edge").alias("edge"), "doc_id", "text")
    order = [F.col("target"), F.col("edge"), F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), F.col("text")]
    placed = dealt.repartitionById(len(splits) - 1, F.col("target")).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row before: target, doc_id, text, bins
        done = None  # the target whose edge row has been used
        for batch in slices(batches, "text"):
            rows, pairs = [], []
            columns = [batch[c].to_pylist() for c in ("target", "edge", "doc_id", "text")]
            for target, edge, doc_id, text, words in zip(*columns, word_hashes(batch["text"]), strict=True):
                if edge and done == target:
                    continue
                here = (target, doc_id, text, method.bin_values(words))
                if held is not None and held[0] == target:
                    pairs.append((held, here))
                done = target if edge else done
                held = None if edge else here
            edited = []
            for (_, _, text, _), (_, _, following, _) in pairs:
                half = len(text) // 2
                edited.append(text[: len(text) - half] + following[:half])
            for (one, other), text, words in zip(pairs, edited, word_hashes(pa.array(edited, pa.string())), strict=True):
                values = method.bin_values(words)
                rows.append(
                    (
                        one[1],
                        len(one[2]),
                        hashlib.sha256(text.encode()).hexdigest(),
                        method.packed(one[3]),
                        method.packed(values),
                        method.likeness(one[3], values),
                        method.likeness(one[3], other[3]),
                    )
                )
            if rows:
                types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
                names = [c.split()[0] for c in _EDITED.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    return placed.mapInArrow(run, _EDITED)
