"""Main text of web pages by a recurrent labeller: a bidirectional LSTM over all blocks of a page.

A block enters as the hashed words of its tag path, its own hashed words, and a few measures of its text. Two LSTMs read
the blocks of the page forward and backward, so each block is judged with the whole page as context. No page comes with
labels: the network is trained on a bounded sample of the pages themselves, where the names of elements say what a block is,
with blocks moved into other surroundings (side bars, notices, comments, forms, plainer articles) so that it learns
those too, and with parts of the names hidden so that it relies on more than one of them. Near half of the pages it learns
from have no names at all, plain ``div`` or table cells in place of telling elements, so that it also goes by what blocks
look like: their length, links, sentences, tags and neighbours.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from doclake.llm.common import slices
from doclake.llm.html_blocks import Block, blocks

PATH, WORDS, MEASURES, HIDDEN = 160, 24, 8, 16
INPUT = PATH + WORDS + MEASURES

# Words that name what a part of a page is for; used to label the training sample only.
_ASIDE = frozenset(
    "nav header footer aside form head title button menu navbar sidebar ad ads advert advertisement banner promo sponsor sponsored "
    "cookie consent notice popup modal newsletter subscribe share social related comment comments reply breadcrumb breadcrumbs "
    "pagination pager login search widget copyright legal disclaimer toolbar topbar masthead dialog alert".split()
)
_MAIN = frozenset("article main content post entry story body text".split())
_TELLING = frozenset("article main section header footer nav aside form menu".split())
Known = tuple[tuple[str, ...], np.ndarray]  # a block's path and shape

_WRONG_PATHS = (
    "body aside .sidebar p", "body div .sidebar div .widget p", "body div .cookie .notice p", "body div .notice", "body div .banner p",
    "body form label", "body form p", "body form div .newsletter p", "body section .comments div .comment p", "body div .comments ul li p",
    "body div #comments div .comment p", "body article section .comments div .comment p", "body article div .comments p",
    "body header div p", "body header h1", "body header p", "body footer p", "body footer div .copyright", "body footer",
    "body article div .ad", "body article aside p", "body article footer p", "body div .ads p", "body div .advert", "body div .advertisement p",
    "body div .menu ul li a", "body nav ul li a", "body nav a", "body div .related ul li a", "body article div .related li a",
    "body article div .share a", "body article form label", "body article nav a", "body div .promo p", "body div .popup p",
    "body div .sponsored p", "body div .subscribe p", "body ul .breadcrumb li a", "body div .pagination a", "head title",
    "body div .legal p", "body main aside .sidebar p", "body main section .comments p", "body div .consent p", "body div .social a",
)
_RIGHT_PATHS = (
    "body article p", "body article h1", "body article h2", "body main p", "body main h1", "body main article p", "body main div p",
    "body div .content p", "body div .content h2", "body div .post .content p", "body div .entry .content p", "body article div .body p",
    "body article section p", "body article ul li", "body article ol li", "body article blockquote p", "body article blockquote",
    "body article pre", "body article table tr td", "body article div", "body article figure figcaption", "body article", "body article h3",
    "body article p b", "body article b", "body article p a", "body div .article p", "body div .main p", "body div .story p",
    "body article header h1", "body article div .text p", "body article dl dd", "body div article p", "body div div article p",
)


@lru_cache(maxsize=200_000)
def _slot(word: str, size: int) -> int:
    return xxhash.xxh3_64_intdigest(word) % size


def shape(text: str, linked: int) -> np.ndarray:
    """What the whole text of a block enters as: its hashed words, then measures; the share of links and the place come last."""
    words, n = text.lower().split(), max(len(text), 1)
    out = np.zeros(WORDS + MEASURES, np.float32)
    for w in words:
        out[_slot(w, WORDS)] += 1
    out[:WORDS] /= max(len(words), 1) ** 0.5 * 4
    ends = text.count(". ") + text.count("! ") + text.count("? ") + text.endswith((".", "!", "?"))
    out[WORDS:] = (np.log1p(n) / 8, len(words) / n * 4, float(n < 40), 1.0, float(ends > 0), min(ends, 8) / 8, linked / n, 0)
    return out


def _vector(path: tuple[str, ...], look: np.ndarray, place: float) -> np.ndarray:
    out = np.zeros(INPUT, np.float32)
    for depth, w in enumerate(path):
        if w not in ("html", "body"):
            out[_slot(w.replace("#", "."), PATH)] = 1.0 if depth < len(path) - 1 else 1.5
    out[PATH:] = look
    out[-1] = place
    return out


def inputs(page: list[Block]) -> np.ndarray:
    """A row for each block of a page."""
    rows = [_vector(b.path, shape(b.text, b.linked), i / max(len(page) - 1, 1)) for i, b in enumerate(page)]
    return np.stack(rows) if rows else np.zeros((0, INPUT), np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Labeller:
    """Weights of the two LSTMs (input, recurrent, bias) and of the logistic output over both states."""

    weights: dict[str, np.ndarray]

    @staticmethod
    def fresh(seed: int) -> Labeller:
        rng = np.random.default_rng(seed)
        w: dict[str, np.ndarray] = {}
        for d in "fb":
            w[f"x{d}"] = rng.normal(0, INPUT**-0.5, (INPUT, 4 * HIDDEN))
            w[f"h{d}"] = rng.normal(0, HIDDEN**-0.5, (HIDDEN, 4 * HIDDEN))
            w[f"b{d}"] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
        w["o"], w["ob"] = rng.normal(0, 0.3, 2 * HIDDEN), np.zeros(1)
        return Labeller({k: v.astype(np.float32) for k, v in w.items()})

    def _read(self, x: np.ndarray, mask: np.ndarray, d: str) -> tuple[np.ndarray, list]:
        """States ``(T, B, H)`` of one direction, and what training needs; padded steps leave the state as it was."""
        w, (steps, size) = self.weights, x.shape[:2]
        pre = x @ w[f"x{d}"] + w[f"b{d}"]
        h = c = np.zeros((size, HIDDEN), np.float32)
        out, tape = np.zeros((steps, size, HIDDEN), np.float32), []
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = pre[t] + h @ w[f"h{d}"]
            i, f, o = (_sigmoid(z[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(z[:, 3 * HIDDEN :])
            m = mask[t][:, None]
            new = f * c + i * g
            tanh = np.tanh(new)
            tape.append((t, h, c, i, f, o, g, tanh, m))
            h, c = m * (o * tanh) + (1 - m) * h, m * new + (1 - m) * c
            out[t] = h
        return out, tape

    def logits(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        both = np.concatenate([self._read(x, mask, "f")[0], self._read(x, mask, "b")[0]], axis=2)
        return both @ self.weights["o"] + self.weights["ob"]

    def gradients(self, x: np.ndarray, mask: np.ndarray, marks: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean logistic loss over real blocks and its slopes, by going back through both directions."""
        w = self.weights
        (hf, tf), (hb, tb) = self._read(x, mask, "f"), self._read(x, mask, "b")
        both = np.concatenate([hf, hb], axis=2)
        p = _sigmoid(both @ w["o"] + w["ob"])
        n = max(float(mask.sum()), 1.0)
        loss = float(-(mask * (marks * np.log(p + 1e-9) + (1 - marks) * np.log(1 - p + 1e-9))).sum() / n)
        dz = mask * (p - marks) / n
        grad = {"o": np.einsum("tb,tbh->h", dz, both), "ob": np.array([dz.sum()])}
        dboth = dz[:, :, None] * w["o"]
        for d, tape, dout in (("f", tf, dboth[:, :, :HIDDEN]), ("b", tb, dboth[:, :, HIDDEN:])):
            dh = dc = np.zeros((x.shape[1], HIDDEN), np.float32)
            dpre = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
            grad[f"h{d}"] = np.zeros_like(w[f"h{d}"])
            for t, h, c, i, f, o, g, tanh, m in reversed(tape):
                dh = dh + dout[t]
                dnew = m * dc + m * dh * o * (1 - tanh * tanh)
                dgate = np.concatenate([dnew * g * i * (1 - i), dnew * c * f * (1 - f), m * dh * tanh * o * (1 - o), dnew * i * (1 - g * g)], axis=1)
                dpre[t] = dgate
                grad[f"h{d}"] += h.T @ dgate
                dh, dc = dgate @ w[f"h{d}"].T + (1 - m) * dh, dnew * f + (1 - m) * dc
            grad[f"x{d}"] = np.einsum("tbi,tbg->ig", x, dpre, optimize=True)
            grad[f"b{d}"] = dpre.sum(axis=(0, 1))
        return loss, grad


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """``(T, B, INPUT)`` and its mask."""
    steps = max(map(len, pages), default=0)
    x, mask = np.zeros((steps, len(pages), INPUT), np.float32), np.zeros((steps, len(pages)), np.float32)
    for b, page in enumerate(pages):
        x[: len(page), b], mask[: len(page), b] = page, 1
    return x, mask


def named_label(path: tuple[str, ...]) -> int | None:
    """What element names say of a block: 0 in a part beside the article, 1 in the article, None if they say nothing."""
    words = [w.lstrip(".#") for w in path]
    if "article" in words:  # an article's own heading is text, whatever holds it
        inner = words[words.index("article") :]
        return 0 if any(w in _ASIDE and w not in ("header", "title") for w in inner) else 1
    if any(w in _ASIDE for w in words):
        return 0
    return 1 if any(w in _MAIN for w in words[2:]) else None


def unnamed(path: tuple[str, ...], cells: bool = False) -> tuple[str, ...]:
    """A path without names: no classes and ids, ``div`` or, with ``cells``, table cells for elements that say what they hold."""
    plain: list[str] = []
    for w in path:
        if w[0] not in ".#":
            plain += ["table", "tr", "td"] if cells and w in _TELLING | {"div"} else ["div"] if w in _TELLING else [w]
    return tuple(plain)


def in_pieces(page: list[Block], least: int = 100) -> list[Block]:
    """The page with each long text without links as several blocks, of whole sentences and at least ``least`` characters."""
    out: list[Block] = []
    for b in page:
        pieces = [b.text]
        if not b.linked and len(b.text) > 2 * least:
            pieces = [""]
            for sentence in re.split(r"(?<=[.!?]) ", b.text):
                if len(pieces[-1]) >= least:
                    pieces.append("")
                pieces[-1] += " " * bool(pieces[-1]) + sentence
        out += [Block(b.path, piece, b.linked) for piece in pieces]
    return out


def _bare(page: list[Known], asides: list[Known], rng: np.random.Generator) -> tuple[list[Known], list[int]]:
    """A page's blocks with labels as a page without names has them, with parts beside the article of other pages."""
    cells, loose = rng.random() < 0.4, rng.random() < 0.5
    rows, marks = [], []
    alone, last = rng.random() < 0.5, max((i for i, b in enumerate(page) if named_label(b[0])), default=-1)

    def beside() -> None:
        at = int(rng.integers(len(asides)))
        for path, look in asides[at : at + int(rng.integers(1, 5))]:
            rows.append((unnamed(path, cells), look))
            marks.append(0)

    for i, (path, look) in enumerate(page):
        mark = named_label(path)
        if mark is None or alone and i > last >= 0:  # half of the pages end with their article
            continue
        if asides and rng.random() < 0.05:
            beside()
        bare = unnamed(path, cells)
        if mark and loose and bare[-1] == "p" and rng.random() < 0.7:
            bare = (*bare[:-1], "td" if cells else "div")
        rows.append((bare, look))
        marks.append(mark)
    return rows, marks


def _varied(page: list[Known], other: list[Known], rng: np.random.Generator) -> tuple[list[Known], list[int]]:
    """A page's blocks with labels, some moved into other surroundings, others put in between, some names hidden."""
    rows, marks = [], []
    move = rng.random() < 0.5
    right = _RIGHT_PATHS[rng.integers(len(_RIGHT_PATHS))]

    def strange() -> None:
        for _ in range(int(rng.integers(1, 4))):
            path = tuple(_WRONG_PATHS[rng.integers(len(_WRONG_PATHS))].split())
            for _ in range(int(rng.integers(1, 4))):
                look = other[rng.integers(len(other))][1].copy()
                look[-2] = float(path[-1] == "a")
                rows.append((path, look))
                marks.append(0)

    if other and rng.random() < 0.6:
        strange()
    for path, look in page:
        mark = named_label(path)
        if mark is None:
            continue
        if mark and move:
            path = tuple((_RIGHT_PATHS[rng.integers(len(_RIGHT_PATHS))] if rng.random() < 0.5 else right).split())
        elif rng.random() < 0.15:
            path = tuple(w for w in path if rng.random() < 0.7 or w in ("p", "li", "a") or w.lstrip(".") in _ASIDE | _MAIN)
        rows.append((path, look))
        marks.append(mark)
        if other and rng.random() < 0.06:
            strange()
    if other and rng.random() < 0.6:
        strange()
    return rows, marks


def train(pages: DataFrame, sample: int = 160, most_blocks: int = 150, rounds: int = 240, seed: int = 11) -> Labeller:
    """A labeller fitted on at most ``sample`` pages, chosen by a hash of their ids, of at most ``most_blocks`` blocks each.

    Each page is learnt from as it is, and with its long texts in pieces of a few sentences.

    The driver receives of each block its path and the fixed numbers its whole text enters as. Without pages the network
    sees made-up surroundings only.
    """
    chosen = pages.filter("html is not null").select("page_id", "html").orderBy(F.xxhash64("page_id"), "page_id").limit(sample)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for page in batch["html"].to_pylist():
                whole = blocks(page)
                for found in (whole[:most_blocks], in_pieces(whole)[:most_blocks]):
                    columns = ([list(b.path) for b in found], [shape(b.text, b.linked) for b in found])
                    kinds = (pa.list_(pa.list_(pa.string())), pa.list_(pa.list_(pa.float32())))
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(columns, kinds, strict=True)], names=["paths", "looks"])

    rows = chosen.mapInArrow(cut, "paths array<array<string>>, looks array<array<float>>").collect()
    return fit([[(tuple(p), np.array(k, np.float32)) for p, k in zip(r["paths"], r["looks"], strict=True)] for r in rows], rounds, seed)


def fit(known: list[list[Known]], rounds: int, seed: int) -> Labeller:
    """The network after ``rounds`` steps, each over 16 varied pages of those given, by Adam with a falling rate."""
    texts = [b for page in known for b in page] or [((), shape(w * 8, 0)) for w in ("one ", "two ", "three ")]
    asides = [b for b in texts if named_label(b[0]) == 0]
    rng = np.random.default_rng(seed)
    model, moment, square = Labeller.fresh(seed), {}, {}
    for step in range(1, rounds + 1):
        batch, labels = [], []
        for k in rng.integers(0, max(len(known), 1), 16):
            page = known[k] if known else []
            rows, marks = _bare(page, asides, rng) if rng.random() < 0.45 else _varied(page, texts, rng)
            if rows:
                last = max(len(rows) - 1, 1)
                batch.append(np.stack([_vector(p, look, i / last) for i, (p, look) in enumerate(rows)]))
                labels.append(marks)
        if not batch:
            continue
        x, mask = padded(batch)
        y = np.zeros(mask.shape, np.float32)
        for b, marks in enumerate(labels):
            y[: len(marks), b] = marks
        _, grad = model.gradients(x, mask, y)
        rate = 0.02 * min(1.0, 2 * (1 - step / (rounds + 1)))
        for k, g in grad.items():
            g = np.clip(g, -1, 1)
            moment[k] = 0.9 * moment.get(k, 0) + 0.1 * g
            square[k] = 0.99 * square.get(k, 0) + 0.01 * g * g
            move = rate * (moment[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-6)
            model.weights[k] = (model.weights[k] - move).astype(np.float32)
    return model


def extract(pages: DataFrame, labeller: Labeller, blocks_at_once: int = 20_000) -> DataFrame:
    """``(page_id, url, text, n_chars)`` of each row of ``pages (page_id, url, html)``: blocks labelled as main text.

    Blocks keep page order and are joined by one newline; ``n_chars`` counts code points. A null, empty or textless html
    gives an empty text. Every block of a page is read whole; repeated rows stay, other columns are left out.
    """
    spark: SparkSession = pages.sparkSession
    shared = spark.sparkContext.broadcast(labeller.weights)  # fixed size

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Labeller(shared.value)
        for batch in slices(batches, "html", 4 << 20):
            pages = [blocks(h or "") for h in batch["html"].to_pylist()]
            texts = [""] * len(pages)
            order = sorted(range(len(pages)), key=lambda i: len(pages[i]))
            while order:
                # Pages of like length together; the longest sets the steps of all.
                take = max(1, min(len(order), 256, blocks_at_once // max(len(pages[order[-1]]), 1)))
                group, order = order[-take:], order[:-take]
                x, mask = padded([inputs(pages[i]) for i in group])
                if not len(x):
                    continue
                main = model.logits(x, mask) > 0
                for b, i in enumerate(group):
                    texts[i] = "\n".join(k.text for k, keep in zip(pages[i], main[:, b], strict=False) if keep)
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    wanted = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return wanted.mapInArrow(label, "page_id long, url string, text string, n_chars long")
