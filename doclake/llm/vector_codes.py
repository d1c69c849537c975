"""Codes of vectors by product quantization in whole numbers, over Hilbert-sorted blocks with boxes.

Vectors are cut into parts, and each part position has a codebook learnt by rounds of assigning every part to its nearest entry
and moving entries to the floor of their parts' mean. All numbers are whole, so results depend on neither the order nor the
spread of rows. The parts of each position are sorted along a Hilbert curve and stored in flat blocks, each with the
box around its parts and their sum. A round measures entries against boxes first: an entry whose least distance to a box
exceeds another entry's greatest distance is nearest to nothing inside, so a block is compared with a short list only, and
one with a list of a single entry goes to it as a whole, by its stored sum.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from doclake.llm.common import stored
from doclake.operators.joins import join_reduced

#: Components from here on would leave the range of exact sums and distances.
LARGEST = 65_536.0
_BLOCKS = "part int, width int, rows array<long>, flat array<int>, low array<int>, high array<int>, sums array<long>"


def whole_numbers(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """``vectors (vec_id, embedding, label)`` as ``row, vec_id, label, numbers``: each component x as floor(scale * x).

    Rows whose vector is null, or holds nulls, NaN or infinite components, go. ``row`` is a number of each row kept; the table
    is stored, so it stays that row's. Components of 65,536 or more in size are an error, as are vectors of several lengths.
    Other columns are left out.
    """
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    small = lambda x: F.when(F.abs(x) < LARGEST, F.floor(x.cast("double") * scale).cast("int"))
    error = F.raise_error("a component of a vector is too large").cast("int")
    numbers = F.transform("embedding", lambda x: F.coalesce(small(x), error))
    kept = vectors.filter(F.col("embedding").isNotNull() & F.forall("embedding", finite))
    return stored(
        kept.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", numbers.alias("numbers")), "vectors"
    )


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places along the Hilbert curve of ``cells`` (points by axes, ``bits`` bits each; at most 63 bits together).

    Skilling's transform: undo the excess work of each level, Gray-code the axes, then interleave their bits.
    """
    axes = cells.T.astype(np.int64).copy()
    for level in range(bits - 1, 0, -1):
        one, rest = 1 << level, (1 << level) - 1
        for axis in axes:
            inside = (axis & one) == 0
            swap = np.where(inside, (axes[0] ^ axis) & rest, 0)
            axes[0] ^= np.where(inside, swap, rest)
            axis ^= swap
    for i in range(1, len(axes)):
        axes[i] ^= axes[i - 1]
    turn = np.zeros(axes.shape[1], np.int64)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(axes[-1] & (1 << level), (1 << level) - 1, 0)
    axes ^= turn
    keys = np.zeros(axes.shape[1], np.int64)
    for level in range(bits - 1, -1, -1):
        for axis in axes:
            keys = (keys << 1) | ((axis >> level) & 1)
    return keys


def hilbert_blocks(vectors: DataFrame, parts: int = 4, most: int = 256) -> DataFrame:
    """The parts of ``vectors (row, numbers)`` in stored blocks of at most ``most``, sorted along a Hilbert curve by position.

    Curves have up to 8 bits for each of the leading components, 63 together; cells are measured in standard deviations
    around the mean. They decide how tight boxes are, not results. Equal parts are dealt by row as well, so that one vector
    that a third of all rows share fills many tasks. No vectors make no blocks.
    """
    sizes = F.size("numbers")
    total = F.aggregate("numbers", F.lit(0.0), lambda a, x: a + x)
    squares = F.aggregate("numbers", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    least, greatest, count, mean, square = vectors.agg(
        F.min(sizes), F.max(sizes), F.sum(sizes), F.sum(total), F.sum(squares)
    ).first()
    if least != greatest or (least or 0) % parts:
        raise ValueError(f"vectors need one length that is a multiple of {parts}")
    width = (greatest or 0) // parts
    if not width:
        return vectors.sparkSession.createDataFrame([], _BLOCKS)
    mean /= count
    step = max((square / count - mean * mean) ** 0.5, 1.0)
    axes = min(width, 63)
    bits = min(8, 63 // axes)
    cells = 1 << bits

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = np.asarray(batch["numbers"].flatten()).reshape(batch.num_rows * parts, width)
            scaled = np.floor((flat[:, :axes] - mean) / step * (cells / 4) + cells / 2)
            keys = hilbert_keys(np.clip(scaled, 0, cells - 1), bits)
            at = np.arange(len(flat) + 1, dtype=np.int32) * width
            part = np.tile(np.arange(parts, dtype=np.int32), batch.num_rows)
            row = np.repeat(np.asarray(batch["row"]), parts)
            piece = pa.ListArray.from_arrays(pa.array(at), pa.array(flat.reshape(-1)))
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(keys), pa.array(row), piece], names=["part", "key", "row", "piece"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row, piece = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros((0, width), np.int32)
        for batch in batches:
            part = np.concatenate([part, np.asarray(batch["part"])])
            row = np.concatenate([row, np.asarray(batch["row"])])
            piece = np.concatenate([piece, np.asarray(batch["piece"].flatten()).reshape(-1, width)])
            starts = _starts(part)
            done = starts[-1] if len(starts) else 0  # the last block may still grow
            if done:
                yield _block_rows(part[:done], row[:done], piece[:done], starts[:-1])
                part, row, piece = part[done:], row[done:], piece[done:]
        if len(part):
            yield _block_rows(part, row, piece, _starts(part))

    def _starts(part: np.ndarray) -> np.ndarray:
        """Where blocks start: at each change of part, and every ``most`` rows from there."""
        change = np.flatnonzero(np.diff(part, prepend=-1))
        since = np.arange(len(part)) - np.repeat(change, np.diff(np.append(change, len(part))))
        return np.flatnonzero(since % most == 0)

    def _block_rows(part: np.ndarray, row: np.ndarray, piece: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
        ends = np.append(starts, len(part)).astype(np.int32)
        boxes = np.arange(len(starts) + 1, dtype=np.int32) * width
        wide = piece.astype(np.int64)
        lists = [
            (ends, row),
            (ends * width, piece.reshape(-1)),
            (boxes, np.minimum.reduceat(piece, starts).reshape(-1)),
            (boxes, np.maximum.reduceat(piece, starts).reshape(-1)),
            (boxes, np.add.reduceat(wide, starts).reshape(-1)),
        ]
        columns = [pa.array(part[starts]), pa.array(np.full(len(starts), width, np.int32))]
        columns += [pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values)) for at, values in lists]
        return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _BLOCKS.split(", ")])

    cuts = vectors.select("row", "numbers").mapInArrow(cut, "part int, key long, row long, piece array<int>")
    dealt = cuts.repartitionByRange("part", "key", "row").sortWithinPartitions("part", "key", "row")
    return stored(dealt.mapInArrow(pack, _BLOCKS), "blocks")


def first_entries(vectors: DataFrame, parts: int = 4, entries: int = 256) -> np.ndarray:
    """Codebooks (part, entry, component) made of the ``entries`` vectors of smallest vec_id, fewer if there are fewer.

    Vectors without vec_id come last; of vectors that share one, the smaller components come first.
    """
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "numbers").limit(entries).select("numbers").collect()
    rows = np.array([r[0] for r in first], np.int64).reshape(len(first), -1 if first and first[0][0] else 0)
    return rows.reshape(len(first), parts, rows.shape[1] // parts).transpose(1, 0, 2)


def nearest(blocks: pa.RecordBatch, books: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray | int]]:
    """For each block ``(place, part, short list, pieces, entry of each)``, a single entry for a block that goes as a whole.

    Distances are whole numbers below 2 ** 53 in float64, where sums and products of such are exact, or in int64 beyond.
    """
    width = books.shape[2]
    low, high = (np.asarray(blocks[c].flatten(), np.int64).reshape(-1, width) for c in ("low", "high"))
    part = np.asarray(blocks["part"])
    flat, at = np.asarray(blocks["flat"].flatten()), np.asarray(blocks["flat"].offsets)
    at = at - at[0]
    reach = 2 * max(np.abs(books).max(initial=0), np.abs(low).max(initial=0), np.abs(high).max(initial=0))
    kind = np.float64 if int(reach) ** 2 * max(width, 1) < 2**53 else np.int64
    exact, norms = books.astype(kind), (books.astype(kind) ** 2).sum(axis=2)
    for begin in range(0, len(part), 32):
        here = slice(begin, begin + 32)
        book = exact[part[here]]  # block, entry, component
        under, over = low[here, None].astype(kind), high[here, None].astype(kind)
        inside = ((book - np.clip(book, under, over)) ** 2).sum(axis=2)
        beyond = (np.maximum(np.abs(book - under), np.abs(book - over)) ** 2).sum(axis=2)
        short = inside <= beyond.min(axis=1, keepdims=True)
        for i, chosen in enumerate(short, begin):
            listed = np.flatnonzero(chosen)
            pieces = flat[at[i] : at[i + 1]].reshape(-1, width).astype(kind)
            if len(listed) == 1:
                yield i, part[i], listed, pieces, int(listed[0])
                continue
            distance = norms[part[i], listed] - 2 * (pieces @ exact[part[i], listed].T)
            yield i, part[i], listed, pieces, listed[distance.argmin(axis=1)]  # the first of equal ones


def learn(blocks: DataFrame, books: np.ndarray, rounds: int = 4) -> np.ndarray:
    """``books`` after ``rounds`` rounds over all blocks; an entry without parts stays.

    A task sends one row per entry it has parts for; the driver gets one row per entry.
    """
    parts, entries, width = books.shape
    if not entries or not width:
        return books

    for _ in range(rounds):

        def add(batches: Iterator[pa.RecordBatch], books: np.ndarray = books) -> Iterator[pa.RecordBatch]:
            counts, sums = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
            for batch in batches:
                whole = np.asarray(batch["sums"].flatten()).reshape(-1, width)
                for i, part, _, pieces, entry in nearest(batch, books):
                    if isinstance(entry, int):
                        counts[part, entry] += len(pieces)
                        sums[part, entry] += whole[i]
                        continue
                    order = np.argsort(entry, kind="stable")
                    met, starts = np.unique(entry[order], return_index=True)
                    counts[part, met] += np.diff(np.append(starts, len(entry)))
                    sums[part, met] += np.add.reduceat(pieces[order], starts).astype(np.int64)
            part, entry = np.nonzero(counts)
            at = pa.array(np.arange(len(part) + 1, dtype=np.int32) * width)
            lists = pa.ListArray.from_arrays(at, pa.array(sums[part, entry].reshape(-1)))
            columns = [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(counts[part, entry]), lists]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "entry", "n", "sums"])

        partial = blocks.mapInArrow(add, "part int, entry int, n long, sums array<long>")
        totals = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)]
        books = books.copy()
        for part, entry, n, *total in partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *totals).collect():
            books[part, entry] = [s // n for s in total]
    return books


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components in decimal, by part, entry and component, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def encode(vectors: DataFrame, blocks: DataFrame, books: np.ndarray) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of every vector.

    ``code`` holds the nearest entry of each part in hexadecimal, two digits each (more for books of over 256 entries),
    ``error`` the squared distances summed over parts, ``label_error`` the errors summed over all vectors of the label, those
    without one together. Repeated vectors and vec_ids give as many rows.
    """
    parts, entries, width = books.shape
    digits = max(2, len(f"{max(entries - 1, 0):x}"))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, at = np.asarray(batch["rows"].flatten()), np.asarray(batch["rows"].offsets)
            part, entry, error = (np.zeros(len(row), t) for t in (np.int32, np.int32, np.int64))
            for i, p, _, pieces, found in nearest(batch, books):
                here = slice(at[i] - at[0], at[i + 1] - at[0])
                part[here], entry[here] = p, found
                error[here] = ((pieces - books[p, entry[here]]) ** 2).sum(axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (row, part, entry, error)], names=["row", "part", "entry", "error"])

    if width:
        coded = blocks.mapInArrow(code, "row long, part int, entry int, error long")
        chosen = [F.max(F.when(F.col("part") == p, F.col("entry"))).alias(f"e{p}") for p in range(parts)]
        coded = coded.groupBy("row").agg(*chosen, F.sum("error").alias("error"))
    else:  # no vectors, or vectors without components: all of them equal
        coded = vectors.select("row", *(F.lit(0).alias(f"e{p}") for p in range(parts)), F.lit(0).cast("long").alias("error"))
    shown = F.concat(*(F.lpad(F.lower(F.hex(f"e{p}")), digits, "0") for p in range(parts)))
    key = F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit(""))  # no label is a label of its own
    found = vectors.select("row", "vec_id", key.alias("key")).join(coded, "row").select("vec_id", "key", shown.alias("code"), "error")
    found = stored(found, "codes")
    by_label = found.groupBy("key").agg(F.sum("error").alias("label_error"))
    return join_reduced(found, by_label, "key", "inner").select(
        "vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")
    )
