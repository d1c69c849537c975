"""Near-duplicate documents by min-max hashing, confirmed on full shingle sets.

Each permutation of the shingles gives two values of a signature, its smallest and its largest shingle, so half the
hash evaluations of plain MinHash serve the same number of values; the two hardly depend on each other, which lowers the
variance of the share that agrees. Bands of such values put texts that may be alike into buckets.

Equal sets are one class, whatever their number. In a bucket every class is compared with the one class that meets
the most others (the hub), not with all. What that leaves apart is finished exactly: in a bucket that still holds several
components, the classes outside its largest component are compared with all of the bucket, in blocks inside a task; the
classes of the largest component are never compared among themselves, and only links are ever emitted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from doclake.llm.common import slices, stored
from doclake.llm.components import component_labels
from doclake.llm.shingles import mix, shingle_set, word_hashes
from doclake.operators.joins import join_reduced

_CHUNK = 64  # classes compared with one hub per unit of work
_BLOCK, _BLOCK_SHINGLES = 1024, 500_000  # classes, and their shingles, that a task compares others with at once
_ROWS = 256  # classes of a bucket that a task compares with a block


def banding(percent: int, miss: float = 1e-6, most: int = 96) -> tuple[int, int]:
    """``(bands, permutations per band)``: the most selective bands that miss a link at the threshold that rarely."""
    for rows in range(most, 0, -1):
        bands = math.ceil(math.log(miss) / math.log1p(-((percent / 100) ** (2 * rows)))) if percent < 100 else 1
        if bands * rows <= most:
            return bands, rows
    return most, 1


def min_max_signature(shingles: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """``2 x permutations``: the smallest and the largest value of the shingles under each permutation."""
    low = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(len(factors), np.uint64)
    for i in range(0, len(shingles), 1024):
        values = factors[:, None] * shingles[None, i : i + 1024]
        np.minimum(low, values.min(axis=1), out=low)
        np.maximum(high, values.max(axis=1), out=high)
    return np.stack([low, high])


def _factors(n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)) | np.uint64(1)


def _digest(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def _signed(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """``(doc_id, mark, n_shingles, node, bands)``: the node is a digest of the shingle set, null for an empty one."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = _factors(bands * rows)
        salts = mix(np.arange(1, 2 * bands * rows + 1, dtype=np.uint64)).reshape(2, bands, rows) | np.uint64(1)
        for batch in slices(batches, "text"):
            sizes, nodes, keys = [], [], []
            for words in word_hashes(batch["text"]):
                found = shingle_set(words, size)
                sizes.append(len(found))
                nodes.append(_digest(found) if len(found) else None)
                if len(found):
                    values = min_max_signature(found, factors).reshape(2, bands, rows)
                    keys.append(mix((mix(values) * salts).sum(axis=(0, 2), dtype=np.uint64)).view(np.int64))
                else:
                    keys.append(np.zeros(bands, np.int64))
            flat = pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64))
            lists = pa.ListArray.from_arrays(np.arange(len(keys) + 1, dtype=np.int32) * bands, flat)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["mark"], pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary()), lists],
                names=["doc_id", "mark", "n_shingles", "node", "bands"],
            )

    return docs.mapInArrow(sign, "doc_id long, mark long, n_shingles long, node binary, bands array<long>")


def _near_sizes(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _confirmed(texts: DataFrame, units: DataFrame, size: int, percent: int) -> DataFrame:
    """Links ``(a, b)`` of classes whose full sets are alike, among ``units (unit, part, role, node, label)``.

    In each ``(unit, part)`` the classes of role 1 are compared with those of role 0, which come first and are few; pairs
    of one label are passed over. Rows are streamed, so a unit of any number of classes holds its role 0 in memory alone.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, base = None, None
        held: list[tuple] = []
        for batch in slices(batches, "text"):
            left, right = [], []
            columns = [batch[c].to_pylist() for c in ("unit", "part", "role", "node", "label")]
            for unit, part, role, node, label, words in zip(*columns, word_hashes(batch["text"]), strict=True):
                found = shingle_set(words, size)
                if _digest(found) != node:  # another text under the same doc_id
                    continue
                if at != (unit, part):
                    at, base, held = (unit, part), None, []
                if role == 0:
                    held.append((node, label, found))
                    base = None
                elif held:
                    base = base or _Sets([x[2] for x in held])
                    common = base.common(found)
                    for i in np.flatnonzero(100 * common >= percent * (base.sizes + len(found) - common)):
                        if held[i][0] != node and (label is None or held[i][1] != label):
                            left.append(node)
                            right.append(held[i][0])
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.binary()), pa.array(right, pa.binary())], names=["a", "b"])

    dealt = texts.join(units.hint("merge"), "node").select("unit", "part", "role", "node", "label", "text")
    placed = dealt.repartition("unit", "part").sortWithinPartitions("unit", "part", "role")
    return placed.mapInArrow(compare, "a binary, b binary")


class _Sets:
    """Several sets in one sorted array, to count what each has in common with another set."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        flat = np.concatenate(sets)
        order = np.argsort(flat, kind="stable")
        self.values, self.owners = flat[order], np.repeat(np.arange(len(sets)), self.sizes)[order]

    def common(self, other: np.ndarray) -> np.ndarray:
        first = np.searchsorted(self.values, other, "left")
        number = np.searchsorted(self.values, other, "right") - first
        ends = np.cumsum(number)
        places = np.repeat(first - (ends - number), number) + np.arange(int(ends[-1]) if len(ends) else 0)
        return np.bincount(self.owners[places], minlength=len(self.sizes))


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, miss: float = 1e-6) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` of each row of ``docs (doc_id, text)``.

    Two texts are linked if ``100 * common shingles >= percent * all shingles`` of their sets of ``words``-word
    shingles (words: A-Z in lower case, cut at ASCII white space; a shorter text is one shingle). ``component_id`` is the
    smallest doc_id reachable over links, ``kept`` marks the row that has it. ``miss`` bounds the chance that the bands
    put a pair at the threshold into no common bucket.

    A null or blank text is linked with nothing: it has 0 shingles and its own doc_id as component. Rows may share a
    doc_id, each goes by its own text; a null doc_id counts only if the whole component has no other, and such rows are
    kept when their component is null. Repeated rows stay, marked alike. Other columns are left out.
    """
    bands, rows = banding(percent, miss)
    # A row is known by its id and a hash of its text, so that many texts under one id, or under none, stay apart.
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), "text")
    signed = stored(_signed(docs, words, bands, rows), "signed")
    classes = stored(
        signed.filter("node is not null").groupBy("node").agg(
            F.min("doc_id").alias("first_doc"),
            F.min_by("mark", F.coalesce("doc_id", F.lit((1 << 63) - 1))).alias("first_mark"),
            F.first("n_shingles").alias("n"),
            F.first("bands").alias("bands"),
        ),
        "classes",
    )
    keyed = classes.select("node", "n", F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    met = stored(join_reduced(keyed, shared, "key", "inner"), "buckets")
    reach = met.groupBy("node").agg(F.sum("size").alias("reach"))
    hubs = met.join(reach, "node").groupBy("key").agg(F.max_by(F.struct("node", "n"), F.struct("reach", "node")).alias("hub"))
    stars = (
        join_reduced(met, hubs, "key", "inner")
        .filter((F.col("node") != F.col("hub.node")) & _near_sizes(F.col("n"), F.col("hub.n"), percent))
        .select(F.col("node").alias("a"), F.col("hub.node").alias("hub"))
        .distinct()
    )
    stars = stored(stars, "stars")
    # The texts that meet any other, fetched once; a side that may be small or large is joined alike at every size.
    known = met.select("node").distinct().join(classes.select("node", "first_doc", "first_mark"), "node").hint("merge")
    of_class = docs["doc_id"].eqNullSafe(known["first_doc"]) & (docs["mark"] == known["first_mark"])
    texts = stored(docs.join(known, of_class).select("node", "text"), "texts")
    no_label = F.lit(None).cast("binary").alias("label")
    parts = stars.groupBy("hub").agg(F.ceil(F.count("*") / _CHUNK).alias("parts"))
    dealt = stars.join(parts, "hub").withColumn("part", F.expr("pmod(xxhash64(a), parts)"))
    hub_rows = dealt.select(F.col("hub").alias("unit"), "part", F.lit(0).alias("role"), F.col("hub").alias("node"), no_label).distinct()
    star_rows = dealt.select(F.col("hub").alias("unit"), "part", F.lit(1).alias("role"), F.col("a").alias("node"), no_label)
    links = stored(_confirmed(texts, hub_rows.union(star_rows), words, percent), "links")
    labels = component_labels(links)

    # What the hubs left apart: buckets that hold several components.
    placed = met.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    per_label = placed.groupBy("key", "label").agg(F.count("*").alias("here"), F.sum("n").alias("shingles"))
    divided = per_label.groupBy("key").agg(
        F.max_by("label", F.struct("here", "label")).alias("main"),
        F.sum("here").alias("rows"),
        (F.sum("here") - F.max("here")).alias("outer"),
        (F.sum("shingles") - F.max_by("shingles", F.struct("here", "label"))).alias("weight"),
    ).filter("outer > 0")
    # The classes outside the main component are cut into blocks, the whole bucket is dealt over chunks; each block meets
    # each chunk in a task of its own, so neither many strays nor a stray in a very large bucket fill one task.
    blocks = F.greatest(F.ceil(F.col("outer") / _BLOCK), F.ceil(F.col("weight") / _BLOCK_SHINGLES)).cast("int")
    chunks = F.ceil(F.col("rows") / _ROWS).cast("int")
    open_ = join_reduced(placed, divided, "key", "inner")
    open_ = stored(open_.select(F.col("key").alias("unit"), "node", "label", "main", blocks.alias("blocks"), chunks.alias("chunks")), "divided")
    each_block, each_chunk = (F.explode(F.sequence(F.lit(0), F.col(c) - 1)).alias("at") for c in ("blocks", "chunks"))
    inner = open_.select("unit", "chunks", "node", "label", each_block)
    inner = inner.select("unit", F.expr("at * chunks + pmod(xxhash64(node), chunks)").alias("part"), F.lit(1).alias("role"), "node", "label")
    outer = open_.filter("label <> main").select("unit", "blocks", "chunks", "node", "label", each_chunk)
    outer = outer.select("unit", F.expr("pmod(xxhash64(node), blocks) * chunks + at").alias("part"), F.lit(0).alias("role"), "node", "label")
    late = stored(_confirmed(texts, outer.union(inner), words, percent), "links")
    if not late.isEmpty():
        labels = component_labels(links.union(late))

    # Copies of one text and texts of one component may be a large share of all rows.
    named = join_reduced(signed.select("doc_id", "n_shingles", "node"), labels, "node", "left")
    named = named.withColumn("label", F.coalesce("label", "node"))
    lowest = (
        classes.join(labels, "node", "left")
        .groupBy(F.coalesce("label", "node").alias("label"))
        .agg(F.min("first_doc").alias("lowest"))
    )
    found = join_reduced(named, lowest, "label", "left")
    found = found.withColumn("component_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("lowest")))
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
