"""Document quality by pairwise preference: a Bradley-Terry model over features of the whole text.

A pair is a document marked good and one marked bad; the chance that the first is preferred is the logistic function of
the difference of their scores, a score being linear in standardised features. The weights minimise the logistic loss on
feature differences of pairs. The quantile of the training scores that parts the marks best becomes the threshold, where
the score reported is 0.5.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from doclake.llm.common import slices, stored

SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
NAMES = [
    "upper", "lower", "digit", "blank", "line", "other", "log_bytes", "word_length", "distinct_words", "longest_word",
    "distinct_lines", "line_length", "doubled", "capital_words", "signs_in_words", "top_word", "stops",
    *(f"sign_{ord(c)}" for c in SIGNS),
]
_DOUBLED = re.compile(rb"([^\w\s])\1")
_SIGNS = np.frombuffer(SIGNS.encode(), np.uint8)


def features(text: str) -> np.ndarray:
    """Shares and ratios of one whole text, in the order of :data:`NAMES`; all zero for an empty one."""
    out = np.zeros(len(NAMES))
    raw = text.encode("utf-8", "surrogatepass")
    if not raw:
        return out
    n = len(raw)
    seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words, lines = raw.split(), raw.split(b"\n")
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    k = max(len(words), 1)
    letters = max(int(seen[65:91].sum() + seen[97:123].sum() + seen[128:].sum()), 1)
    distinct = set(lines)
    out[:17] = (
        seen[65:91].sum() / letters,
        seen[97:123].sum() / n,
        seen[48:58].sum() / n,
        (seen[32] + seen[9]) / n,
        seen[10] / n,
        seen[128:].sum() / n,
        np.log1p(n),
        n / k,
        len(counts) / k**0.8,
        np.log1p(max(map(len, counts), default=0)),
        sum(map(len, distinct)) / max(sum(map(len, lines)), 1),
        np.log1p(n / len(lines)),
        sum(1 for _ in _DOUBLED.finditer(raw)) / k,
        sum(c for w, c in counts.items() if w.isupper() and len(w) > 1) / k,
        sum(c for w, c in counts.items() if not w.isalnum()) / k,
        max(counts.values(), default=0) / k,
        (seen[46] + seen[33] + seen[63]) / k,
    )
    out[17:] = np.minimum(seen[_SIGNS] / k, 1.0)
    return out


@dataclass(frozen=True)
class Ranker:
    """Mean and spread of the features, their weights, and the scale and threshold that turn a score into 0 to 1."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    threshold: float
    scale: float

    def score(self, values: np.ndarray) -> np.ndarray:
        raw = np.clip((values - self.mean) / self.spread, -8, 8) @ self.weights
        return 1 / (1 + np.exp(-np.clip((raw - self.threshold) / self.scale, -40, 40)))


def fit_pairs(values: np.ndarray, marks: np.ndarray, pairs: int = 60_000, ridge: float = 1e-3, steps: int = 30, seed: int = 7) -> Ranker | None:
    """The ranker for features and 0/1 marks, by Newton steps on the pairwise logistic loss; None without both marks."""
    good, bad = np.flatnonzero(marks == 1), np.flatnonzero(marks == 0)
    if not len(good) or not len(bad):
        return None
    mean, spread = values.mean(axis=0), np.maximum(values.std(axis=0), 1e-6)
    x = np.clip((values - mean) / spread, -8, 8)
    rng = np.random.default_rng(seed)
    diff = x[rng.choice(good, pairs)] - x[rng.choice(bad, pairs)]
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(diff @ w, -40, 40)))
        slope = diff.T @ (1 - p) / pairs - ridge * w
        bend = (diff * (p * (1 - p))[:, None]).T @ diff / pairs + ridge * np.eye(len(w))
        move = np.linalg.solve(bend, slope)
        w += move
        if np.abs(move).max() < 1e-6:
            break
    scores = x @ w
    order = np.argsort(scores, kind="stable")
    # Errors if the lowest i scores are refused, for every i: good ones refused plus bad ones kept.
    wrong = np.concatenate([[0], np.cumsum(marks[order] == 1)]) + len(bad) - np.concatenate([[0], np.cumsum(marks[order] == 0)])
    best = np.flatnonzero(wrong == wrong.min())
    cut = int(best[len(best) // 2])
    ends = np.concatenate([[scores.min() - 1], scores[order], [scores.max() + 1]])
    return Ranker(mean, spread, w, float((ends[cut] + ends[cut + 1]) / 2), max(float(np.std(scores)) / 4, 1e-6))


_FEATURES = "mark double, at long, values array<double>"


def held_out(doc_id: Column) -> Column:
    """True for rows whose labels are never learnt from: the checksum of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = 20_000) -> Ranker | None:
    """Fit on at most ``sample`` labelled rows outside the held-out third, chosen by a hash of their ids.

    ``labels (doc_id, quality)``: rows without either are left out; several marks of one doc_id count as their mean, and as
    none if that is a half. Only this bounded sample, a row of features each, is brought to the driver.
    """
    marks = labels.filter(~held_out(F.col("doc_id")) & F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    marks = marks.groupBy(F.col("doc_id").alias("_id")).agg(F.avg("quality").alias("mark")).filter("mark <> 0.5")
    chosen = F.broadcast(marks.orderBy(F.xxhash64("_id"), "_id").limit(sample))
    rows = docs.select("doc_id", "text").join(chosen, F.col("doc_id") == F.col("_id"))
    rows = rows.select("text", "mark", F.xxhash64("doc_id", "text").alias("at"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            values = [features(t or "") for t in batch["text"].to_pylist()]
            flat = pa.array(np.concatenate(values))
            lists = pa.ListArray.from_arrays(np.arange(len(values) + 1, dtype=np.int32) * len(NAMES), flat)
            yield pa.RecordBatch.from_arrays([batch["mark"], batch["at"], lists], names=["mark", "at", "values"])

    # In an order of their own, so that rows that share an id make the same sample in every run.
    # Stored, so that the choice is made in tasks and the driver gets no more than the sample.
    chosen_rows = rows.mapInArrow(extract, _FEATURES).orderBy("at", "mark", "values").limit(sample)
    found = stored(chosen_rows, "sample").orderBy("at", "mark", "values").toPandas()
    if found.empty:
        return None
    return fit_pairs(np.stack(found["values"].to_numpy()), (found["mark"].to_numpy() > 0.5).astype(int))


def score_quality(docs: DataFrame, ranker: Ranker | None) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on), from the whole text alone.

    A null text counts as empty and is scored like one; without a ranker (no labels of both kinds) every score is 0.5.
    All rows and columns stay, in place of columns of these two names.
    """
    kept = [c for c in docs.columns if c.lower() not in ("score", "predicted")]
    if ranker is None:
        scored = docs.select(*kept, F.lit(0.5).alias("score"))
    else:

        @F.pandas_udf("double")
        def score(texts):
            import pandas as pd

            values = [features(t or "") for t in texts]
            return pd.Series(ranker.score(np.stack(values)) if values else [])

        scored = docs.select(*kept, score("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
