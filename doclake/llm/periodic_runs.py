"""Periodic runs of words, found by longest common extensions on suffix trees.

A run is a longest stretch of words with some period that is repeated often enough. Every run holds, under one of the two
orders of the words, a Lyndon word of the length of its period that is the longest Lyndon word from its first place. So each
place gives two candidates, one for each order; how far a candidate's period goes on to both sides is a longest common
extension, answered in constant time as the lowest common ancestor in Ukkonen's suffix tree of the words (to the right) or of
the words in reversed order (to the left).

The words of a run recur within it, so a run lies inside a stretch covered by repeated windows of words (see
:func:`repeated_stretches`); trees are built of these stretches only. This loses nothing: a text without a repeated
window holds no run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from doclake.llm.common import slices
from doclake.llm.shingles import mix, shingle_hashes

RUNS = T.ArrayType(
    T.StructType([T.StructField(c, T.LongType(), False) for c in ("start", "length", "period")]), False
)
_ARROW_RUN = pa.struct([pa.field(c, pa.int64(), False) for c in ("start", "length", "period")])


class SuffixTree:
    """Ukkonen's suffix tree of ``symbols`` (numbers from 1), closed by 0, with its leaves in lexical order.

    Nodes are places in lists, edges one dictionary from (node, first symbol) to the node below, so a tree of n symbols takes
    a few hundred bytes for each. ``rank[i]`` is the place of suffix i among all, the closing one first.
    """

    def __init__(self, symbols: list[int]):
        self.text = [*symbols, 0]
        self.width = max(self.text) + 1
        self._build()
        self._order()

    def _build(self) -> None:
        text, width, size = self.text, self.width, len(self.text)
        first, last, link, edges = [0], [0], [0], {}
        leaves = []
        node = edge = length = pending = 0
        for i, symbol in enumerate(text):
            pending += 1
            waiting = 0  # inner node made last, still without its suffix link
            while pending:
                if not length:
                    edge = i
                key = node * width + text[edge]
                child = edges.get(key)
                if child is None:
                    edges[key] = len(first)
                    leaves.append(len(first))
                    first.append(i)
                    last.append(size)
                    link.append(0)
                    if waiting:
                        link[waiting] = node
                        waiting = 0
                else:
                    begin = first[child]
                    span = min(last[child], i + 1) - begin
                    if length >= span:
                        edge += span
                        length -= span
                        node = child
                        continue
                    if text[begin + length] == symbol:
                        if waiting:
                            link[waiting] = node
                        length += 1
                        break
                    middle = len(first)
                    edges[key] = middle
                    first += (begin, i)
                    last += (begin + length, size)
                    link += (0, 0)
                    leaves.append(middle + 1)
                    edges[middle * width + symbol] = middle + 1
                    first[child] = begin + length
                    edges[middle * width + text[begin + length]] = child
                    if waiting:
                        link[waiting] = middle
                    waiting = middle
                pending -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - pending + 1
        self.first, self.last = first, last
        keys = np.fromiter(edges.keys(), np.int64, len(edges))
        below = np.fromiter(edges.values(), np.int64, len(edges))
        order = np.argsort(keys)
        self.children = below[order]
        self.symbol = keys[order] % width
        self.at = np.searchsorted(keys[order], np.arange(len(first) + 1) * width)
        self.suffix = np.full(len(first), -1, np.int64)
        self.suffix[leaves] = np.arange(len(leaves))  # leaves are made in the order of their suffixes

    def _order(self) -> None:
        """Ranks of the suffixes, and the Euler tour between leaves: the depth at which a leaf parts from the one before."""
        ranked, parting = self._tour(self.children)
        self.rank = np.empty(len(ranked), np.int64)
        self.rank[ranked] = np.arange(len(ranked))
        table = [np.asarray(parting, np.int32)]
        while 2 << (len(table) - 1) <= len(table[0]):
            half = 1 << (len(table) - 1)
            table.append(np.minimum(table[-1][:-half], table[-1][half:]))
        self.lowest = table

    def _tour(self, children: np.ndarray) -> tuple[list[int], list[int]]:
        below, at, suffix = children.tolist(), self.at.tolist(), self.suffix.tolist()
        first, last = self.first, self.last
        ranked, parting = [], [0]
        stack, fresh = [(0, 0)], True  # a node, and the depth of the one above
        while stack:
            node, depth = stack.pop()
            if not fresh:
                parting.append(depth)
                fresh = True
            if suffix[node] >= 0:
                ranked.append(suffix[node])
                fresh = False
            else:
                depth += last[node] - first[node]
                stack.extend([(child, depth) for child in reversed(below[at[node] : at[node + 1]])])
        return ranked, parting

    def rank_in_reversed_order(self) -> np.ndarray:
        """Ranks where greater symbols come first; the end of the text stays before all others."""
        owner = np.repeat(np.arange(len(self.at) - 1), np.diff(self.at))
        again = np.lexsort((np.where(self.symbol == 0, -self.width, -self.symbol), owner))
        ranked, _ = self._tour(self.children[again])
        rank = np.empty(len(ranked), np.int64)
        rank[ranked] = np.arange(len(ranked))
        return rank

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """For each pair of different places, how many symbols their suffixes have in common."""
        a, b = self.rank[i], self.rank[j]
        low, high = np.minimum(a, b) + 1, np.maximum(a, b) + 1
        level = np.frexp(high - low)[1] - 1
        found = np.empty(len(low), np.int64)
        for k in np.unique(level):
            here = level == k
            found[here] = np.minimum(self.lowest[k][low[here]], self.lowest[k][high[here] - (1 << k)])
        return found


def lyndon_lengths(rank: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word from each place: up to the next smaller suffix."""
    ranks, stack = rank.tolist(), []
    found = [0] * (len(ranks) - 1)
    for i, r in enumerate(ranks):
        while stack and ranks[stack[-1]] > r:
            j = stack.pop()
            found[j] = i - j
        stack.append(i)
    return np.asarray(found, np.int64)


def runs(symbols: np.ndarray, least: int = 24, repeats: int = 3) -> list[tuple[int, int, int]]:
    """All runs ``(start, length, period)`` of at least ``least`` symbols and ``repeats`` periods, by start, then period."""
    size = len(symbols)
    if size < max(least, repeats, 2):
        return []
    codes = np.unique(symbols, return_inverse=True)[1] + 1
    ahead, behind = SuffixTree(codes.tolist()), SuffixTree(codes[::-1].tolist())
    found = []
    for rank in (ahead.rank, ahead.rank_in_reversed_order()):
        period = lyndon_lengths(rank)
        place = np.arange(size)
        start = place - behind.common(size - place, size - place - period)
        end = place + period + ahead.common(place, place + period)
        good = end - start >= np.maximum(least, repeats * period)
        found.append(np.stack([start[good], (end - start)[good], period[good]], axis=1))
    return sorted(set(map(tuple, np.concatenate(found).tolist())), key=lambda r: (r[0], r[2]))


def repeated_stretches(codes: np.ndarray, offsets: np.ndarray, window: int) -> list[tuple[int, int, int]]:
    """Longest stretches ``(text, start, end)`` covered by windows of words that occur twice or more in the same text.

    ``codes`` are the words of all texts, ``offsets`` where texts start and end. Windows are compared by hash, so a stretch may
    be too long, by chance, but never too short.
    """
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    count = len(codes) - window + 1
    if count <= 1:
        return []
    whole = np.flatnonzero(owner[:count] == owner[window - 1 :])  # windows inside one text
    hashes = shingle_hashes(mix(codes.astype(np.uint64)), window)[whole] ^ mix(owner[whole].astype(np.uint64) + np.uint64(1))
    order = np.argsort(hashes)
    same = hashes[order][1:] == hashes[order][:-1]
    again = np.zeros(len(whole), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    change = np.zeros(len(codes) + 1, np.int64)  # a window starts at most once at a place
    change[whole[again]] = 1
    change[whole[again] + window] -= 1
    covered = np.cumsum(change[:-1]) > 0
    opens = covered & np.concatenate([[True], ~covered[:-1] | (owner[1:] != owner[:-1])])
    closes = covered & np.concatenate([~covered[1:] | (owner[1:] != owner[:-1]), [True]])
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return list(zip(owner[starts].tolist(), starts.tolist(), ends.tolist(), strict=True))


def text_runs(texts: pa.Array, least: int, repeats: int) -> tuple[list[list[tuple[int, int, int]]], pa.Array, np.ndarray]:
    """For each text its runs, the text without what they repeat, and its number of words."""
    trimmed = pc.ascii_trim_whitespace(texts.fill_null(""))
    lists = pc.if_else(pc.equal(trimmed, ""), pa.scalar([], pa.list_(trimmed.type)), pc.ascii_split_whitespace(trimmed))
    words = lists.flatten()
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(counts)])
    codes = words.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    found: list[list[tuple[int, int, int]]] = [[] for _ in range(len(texts))]
    dropped = np.zeros(len(codes), bool)
    # A run of length L and period q recurs after q words, so its first and last L - q words are covered by repeated windows.
    window = least - least // repeats if repeats > 1 else 1
    for text, start, end in repeated_stretches(codes, offsets, window):
        if end - start < least:
            continue
        for place, length, period in runs(codes[start:end], least, repeats):
            found[text].append((int(start - offsets[text]) + place, length, period))
            dropped[start + place + period : start + place + length] = True
    if dropped.any():
        kept = ~dropped
        words = words.filter(pa.array(kept))
        ends = np.concatenate([[0], np.cumsum(kept)])[offsets]
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), words)
    return found, pc.binary_join(lists, " "), counts


def periodic_runs(docs: DataFrame, least: int = 24, repeats: int = 3) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` and ``collapsed``; all rows and columns stay, own columns of these names are replaced.

    Words are stretches of other characters than ASCII white space, numbered from 0. ``runs`` are ``(start, length, period)``
    of every stretch with smallest period ``period``, at least ``least`` words and ``repeats`` (2 or more) periods long, that
    no neighbouring word extends; by start, then period. ``collapsed`` are the words, joined by one space, without those that
    any run holds after its first period. A null, empty or blank text has no words, no runs and an empty ``collapsed``.
    Equal rows give equal results; every row is worked on alone, whole, in one narrow pass.
    """
    if least < 2 or repeats < 2:
        raise ValueError("least and repeats are 2 at least")
    kept = [f for f in docs.schema.fields if f.name not in ("n_words", "runs", "collapsed")]
    added = [T.StructField("n_words", T.LongType()), T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType())]
    schema = T.StructType([*kept, *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found, collapsed, counts = text_runs(batch["text"], least, repeats)
            flat = np.array([r for many in found for r in many], np.int64).reshape(-1, 3)
            at = np.concatenate([[0], np.cumsum([len(many) for many in found])])
            parts = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], fields=list(_ARROW_RUN))
            lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), parts)
            columns = [*(batch[f.name] for f in kept), pa.array(counts), lists, collapsed]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(*(f.name for f in kept)).mapInArrow(run, schema)


def strongest(runs_column: str = "runs"):
    """The run with the greatest length in periods, compared exactly; of equal ones the first. Null without runs."""
    longer = lambda best, r: F.when(r.length * best.period > best.length * r.period, r).otherwise(best)
    return F.aggregate(runs_column, F.get(runs_column, F.lit(0)), longer)


def with_planted_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the texts of a tenth of the rows, chosen by ``doc_id``, ending in a repeated stretch of their own words.

    With ``h`` the crc32 of the decimal doc_id and ``g = h // 10``, a text of n > 0 words with ``h % 10 = 0`` has its words from
    ``a = g % n`` replaced by word ``a + (i - a) % p``, ``p = 1 + (n - a) // (3 + g % 8)``. Rows without doc_id stay as they are.
    """
    rows = docs.columns
    words = "filter(split(text, '[ \\\\x09-\\\\x0D]+'), w -> w <> '')"
    crc = "crc32(cast(doc_id as string))"
    named = f"named_struct('w', {words}, 'g', {crc} div 10, 'n', cast(size({words}) as bigint))"
    begun = "transform(array({0}), s -> named_struct('w', s.w, 'n', s.n, 'g', s.g, 'a', if(s.n > 0, s.g % s.n, 0L)))"
    repeated = (
        "array_join(transform(s.w, (w, i) -> if(i < s.a, w, get(s.w, cast(s.a + (i - s.a) % "
        "(1 + (s.n - s.a) div (3 + s.g % 8)) as int)))), ' ')"
    )
    planted = f"transform({begun.format(named)}, s -> {repeated})[0]"
    text = F.expr(f"case when {crc} % 10 = 0 and text is not null then {planted} else text end")
    return docs.select(*(text.alias("text") if c == "text" else F.col(f"`{c}`") for c in rows))
