"""Token sequences packed by a grouping genetic algorithm, distributed as islands.

Documents become pieces of at most ``capacity`` tokens, pieces are dealt evenly into blocks of bounded size, and each block
is packed by several islands. An island evolves a small population of packings whose genes are whole bins: crossover puts
well-filled bins of one parent into the other, drops the bins that then hold a piece twice, and best-fits the displaced
pieces. Between two epochs the best packing of each island migrates to the next island of its block; the best of all islands
wins. Then the loosest bins of every block are opened and their pieces packed again together in new blocks, so what
one block wastes others fill. An island that reaches the lower bound for its pieces stops there.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from doclake.llm.common import slices, stored
from doclake.llm.tokens import encoder

Bins = list[list[int]]


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int | None, capacity: int) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, part, place)``: a row per piece of at most ``capacity`` ids.

    ``part`` and ``place`` number the rows as they were made, so that rows alike in all else can be dealt apart.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, place = encoder(tokenizer), TaskContext.get().partitionId(), 0
        for batch in slices(batches, "text"):
            ids, counts = coder.encode(batch["text"])
            ids = ids.astype("<u4")
            if end_id is not None:
                ids = np.insert(ids, np.cumsum(counts), end_id)
                counts = counts + 1
            ends = np.cumsum(counts)
            rows = []
            for doc, end, n in zip(batch["doc_id"].to_pylist(), ends.tolist(), counts.tolist(), strict=True):
                for k, start in enumerate(range(0, max(n, 1), capacity)):
                    size = min(capacity, n - start)
                    at = end - n + start
                    rows.append((doc, k, start, size, zlib.crc32(ids[at : at + size]), part, place + len(rows)))
            place += len(rows)
            columns = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], names=_NAMES)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, place long"
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return docs.mapInArrow(cut, schema)


_NAMES = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "place"]
_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """No packing has fewer bins: by the sum, and by pieces too large to share a bin."""
    best = math.ceil(int(sizes.sum()) / capacity)
    for small in np.unique(np.linspace(0, capacity // 2, 17).astype(int)):
        alone = int((sizes > capacity - small).sum())
        half = sizes[(sizes <= capacity - small) & (2 * sizes > capacity)]
        rest = int(sizes[(2 * sizes <= capacity) & (sizes >= small)].sum()) - (len(half) * capacity - int(half.sum()))
        best = max(best, alone + len(half) + max(0, math.ceil(rest / capacity)))
    return max(best, 1 if len(sizes) else 0)


def best_fit(bins: Bins, items: list[int], sizes: list[int], capacity: int) -> None:
    """Adds each item, in the order given, to the fullest bin it fits in, or to a new one."""
    by_room: dict[int, list[int]] = {}
    rooms = 0  # bit r: some bin has room for exactly r
    for b, held in enumerate(bins):
        room = capacity - sum(sizes[i] for i in held)
        by_room.setdefault(room, []).append(b)
        rooms |= 1 << room
    for i in items:
        size = sizes[i]
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
            bins[b].append(i)
        else:
            room, b = capacity, len(bins)
            bins.append([i])
        room -= size
        by_room.setdefault(room, []).append(b)
        rooms |= 1 << room


def crossover(one: Bins, other: Bins, sizes: list[int], capacity: int, rng: np.random.Generator) -> Bins:
    """``one`` with about half of the well-filled bins of ``other`` in place of its own holders of those pieces."""
    fill = [sum(sizes[i] for i in b) for b in other]
    line = np.median(fill)
    chosen = [b for b, f, r in zip(other, fill, rng.random(len(other)), strict=True) if f >= line and r < 0.5]
    taken = {i for b in chosen for i in b}
    child, displaced = [list(b) for b in chosen], []
    for b in one:
        if taken.isdisjoint(b):
            child.append(list(b))
        else:
            displaced += [i for i in b if i not in taken]
    displaced.sort(key=lambda i: -sizes[i])
    best_fit(child, displaced, sizes, capacity)
    return child


def mutated(bins: Bins, sizes: list[int], capacity: int, rng: np.random.Generator) -> Bins:
    """The loosest bins and a few others opened, and their pieces best-fitted largest first."""
    fill = np.array([sum(sizes[i] for i in b) for b in bins])
    opened = set(np.argsort(fill, kind="stable")[:3].tolist()) | set(rng.integers(0, len(bins), 3).tolist())
    items = sorted((i for b in opened for i in bins[b]), key=lambda i: -sizes[i])
    rest = [list(b) for k, b in enumerate(bins) if k not in opened]
    best_fit(rest, items, sizes, capacity)
    return rest


def _rank(bins: Bins, sizes: list[int], capacity: int) -> tuple[int, float]:
    """Fewer bins first, then the less even fill, which leaves more room in few bins."""
    return len(bins), -sum((sum(sizes[i] for i in b) / capacity) ** 2 for b in bins)


def evolve(sizes: np.ndarray, capacity: int, seed: int, generations: int, population: int, migrant: Bins | None = None) -> Bins:
    """One island's best packing of ``sizes``; stops at the lower bound. ``migrant`` joins the first population."""
    least, plain = lower_bound(sizes, capacity), sizes.tolist()
    if migrant is not None and len(migrant) <= least:
        return migrant
    rng = np.random.default_rng(seed)
    people: list[Bins] = [] if migrant is None else [migrant]
    for k in range(population):
        noise = np.zeros(len(sizes)) if k == 0 and migrant is None else rng.random(len(sizes)) * capacity / 16
        bins: Bins = []
        best_fit(bins, np.argsort(-(sizes + noise), kind="stable").tolist(), plain, capacity)
        if len(bins) <= least:
            return bins
        people.append(bins)
    people.sort(key=lambda b: _rank(b, plain, capacity))
    for _ in range(generations):
        a, b = rng.choice(min(len(people), 3), 2, replace=False) if len(people) > 1 else (0, 0)
        child = mutated(crossover(people[a], people[b], plain, capacity, rng), plain, capacity, rng)
        if len(child) <= least:
            return child
        people.append(child)
        people.sort(key=lambda b: _rank(b, plain, capacity))
        people.pop()
    return people[0]


def _flat(bins: Bins, n: int) -> list[int]:
    out = [0] * n
    for b, held in enumerate(bins):
        for i in held:
            out[i] = b
    return out


def _unflat(flat: np.ndarray) -> Bins:
    bins: Bins = [[] for _ in range(int(flat.max()) + 1 if len(flat) else 0)]
    for i, b in enumerate(flat.tolist()):
        bins[b].append(i)
    return bins


def _packed(pieces: DataFrame, blocks: int, level: int, capacity: int, islands: int, generations: int, population: int) -> DataFrame:
    """``pieces`` with ``sequence_id``, ``offset`` and ``fill`` (tokens in the sequence), packed in ``blocks`` blocks."""
    names = [c for c in pieces.columns if c not in ("part", "place")]
    block = F.pmod(F.xxhash64("part", "place", F.lit(level)), F.lit(blocks))
    held = stored(
        pieces.groupBy(block.alias("block")).agg(F.sort_array(F.collect_list(F.struct("length", *[c for c in pieces.columns if c != "length"]))).alias("items")),
        "blocks",
    )
    lengths = held.select("block", F.col("items.length").alias("sizes"))
    start = lengths.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(islands - 1)))).withColumn("migrant", F.lit(None).cast("array<int>"))

    def epoch(number: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in range(batch.num_rows):
                    block, sizes, island, migrant = (batch[c][row] for c in ("block", "sizes", "island", "migrant"))
                    values = np.asarray(sizes.values)
                    guest = _unflat(np.asarray(migrant.values)) if migrant.is_valid else None
                    seed = (block.as_py() * 64 + island.as_py()) * 2 + number
                    bins = evolve(values, capacity, seed, generations, population, guest)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([block.as_py()], pa.int64()),
                            pa.array([island.as_py()], pa.int32()),
                            pa.array([len(bins)], pa.int32()),
                            pa.array([_flat(bins, len(values))], pa.list_(pa.int32())),
                        ],
                        names=["block", "island", "bins", "flat"],
                    )

        return run

    schema = "block long, island int, bins int, flat array<int>"
    first = stored(start.repartition("block", "island").mapInArrow(epoch(0), schema), "epoch")
    guests = first.select("block", F.expr(f"(island + 1) % {islands}").alias("island"), F.col("flat").alias("migrant"))
    second = guests.join(lengths, "block").select("block", "sizes", "island", "migrant").repartition("block", "island").mapInArrow(epoch(1), schema)
    best = second.groupBy("block").agg(F.min_by("flat", F.struct("bins", "island")).alias("flat"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                sizes, flat = np.asarray(batch["sizes"][row].values), np.asarray(batch["flat"][row].values)
                order = np.argsort(flat, kind="stable")
                ends = np.cumsum(sizes[order])
                fill = np.bincount(flat, weights=sizes).astype(np.int64)
                offset = np.empty(len(flat), np.int64)
                offset[order] = ends - sizes[order] - (np.cumsum(fill) - fill)[flat[order]]
                rank = np.empty(len(fill), np.int64)
                rank[np.argsort(fill, kind="stable")] = np.arange(len(fill))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["block"].slice(row, 1),
                        *(pa.array([x.tolist()], pa.list_(pa.int64())) for x in (flat, offset, fill[flat], rank[flat])),
                    ],
                    names=["block", "bin", "offset", "fill", "rank"],
                )

    lists = ", ".join(f"{c} array<long>" for c in ("bin", "offset", "fill", "rank"))
    placed = best.join(lengths, "block").select("block", "sizes", "flat").mapInArrow(place, f"block long, {lists}")
    each = held.join(placed, "block").select("block", F.explode(F.arrays_zip("items", "bin", "offset", "fill", "rank")).alias("x"))
    number = F.shiftleft(F.lit(level).cast("long"), 56).bitwiseOR(F.shiftleft(F.col("block"), 16)).bitwiseOR(F.col("x.bin"))
    return each.select(
        *(F.col(f"x.items.{c}").alias(c) for c in [*names, "part", "place"]),
        number.alias("sequence_id"),
        F.col("x.offset").alias("offset"),
        F.col("x.fill").alias("fill"),
        F.col("x.rank").alias("rank"),
    )


def pack_pieces(
    pieces: DataFrame, capacity: int, block: int = 8192, islands: int = 2, generations: int = 6, population: int = 3, loose: int = 6, levels: int = 3
) -> DataFrame:
    """``pieces (length, part, place, ...)`` with ``sequence_id`` and ``offset``: gapless from 0 in each sequence.

    Each piece is in exactly one sequence and none is over ``capacity``; a piece must not be longer. ``block`` bounds the
    pieces packed together (up to the spread of a hash), whatever their number in all; ``loose`` bins of each block that
    are not full are packed again in the next of ``levels`` levels, while there is more than one block.
    """
    count = pieces.count()
    done: list[DataFrame] = []
    for level in range(levels):
        blocks = max(1, math.ceil(count / block))
        found = stored(_packed(pieces, blocks, level, capacity, islands, generations, population), "packed")
        if blocks == 1 or level == levels - 1:
            done.append(found)
            break
        again = (F.col("rank") < loose) & (F.col("fill") < capacity)
        done.append(found.filter(~again))
        pieces = stored(found.filter(again).drop("sequence_id", "offset", "fill", "rank"), "loose")
        count = pieces.count()
        if not count:
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.drop("fill", "rank", "part", "place")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int | None = 1) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)``: each document's pieces and their places.

    A document is its ids by the tokenizer file, then ``end_id`` unless None; only one longer than ``capacity`` is cut,
    its last piece may be shorter. A null text is empty; without an end id it is one piece of length 0. Rows that share
    a doc_id, null included, and repeated rows are packed each; other columns are left out. An empty table gives no rows.
    """
    pieces = stored(token_pieces(docs, tokenizer, end_id, capacity), "pieces")
    return pack_pieces(pieces, capacity)
