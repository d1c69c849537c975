"""Token counts of whole texts without token ids: pieces are counted once for each distinct pre-token of the corpus.

1. A pass finds how often each pre-token occurs; the model cuts each of them into pieces once, and the table of
   ``(pre_token, n, pieces)`` is stored.
2. A second pass makes per-document frequencies. The most frequent pre-tokens, at most ``head`` of at most 64 characters
   and so of bounded size, are broadcast and summed where the document is read: they are most of the text, and they
   are the hot keys. The frequencies of all others are joined with the stored table by pre-token and summed.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from doclake.llm.common import slices, stored
from doclake.llm.tokens import encoder
from doclake.operators.joins import join_reduced

_FLUSH = 300_000
_HEAD_CHARS = 64


def pre_token_table(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``(pre_token, n, pieces)``: each distinct pre-token of the texts, how often it occurs, its number of tokens."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, total = encoder(tokenizer), Counter()
        if coder.kind is None:
            return
        for batch in slices(batches, "text"):
            found = coder.cut_all(batch["text"])[0].flatten().value_counts()
            for piece, n in zip(found.field(0).to_pylist(), found.field(1).to_pylist(), strict=True):
                for token in coder.pre_tokens(piece):
                    total[token] += n
            if len(total) > _FLUSH:
                yield _columns(pre_token=list(total), n=list(total.values()))
                total = Counter()
        if total:
            yield _columns(pre_token=list(total), n=list(total.values()))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenize = encoder(tokenizer).model.tokenize
        for batch in batches:
            pieces = [len(tokenize(x)) for x in batch["pre_token"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["pre_token"], batch["n"], pa.array(pieces, pa.int64())], names=["pre_token", "n", "pieces"])

    found = docs.select("text").mapInArrow(count, "pre_token string, n long")
    return found.groupBy("pre_token").agg(F.sum("n").alias("n")).mapInArrow(cut, "pre_token string, n long, pieces long")


def head_of(table: DataFrame, most: int) -> Column:
    """Condition for the most frequent pre-tokens: all above a frequency that at most ``most`` of them reach."""
    level = F.floor(F.log2("n") * 8).cast("int")
    short = table.filter(F.char_length("pre_token") <= _HEAD_CHARS)
    levels = short.groupBy(level.alias("level")).count().collect()  # at most 8 * 63 rows
    lowest, total = None, 0
    for row in sorted(levels, reverse=True):
        total += row["count"]
        if total > most:
            break
        lowest = row["level"]
    if lowest is None:
        return F.lit(False)
    return (F.char_length("pre_token") <= _HEAD_CHARS) & (level >= lowest)


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 2048, head: int = 1 << 19) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` of each row of ``docs (doc_id, text)``.

    ``n_tokens`` is the length of ``encode(text, add_special_tokens=False).ids`` of the tokenizer file, without
    truncation or padding; special strings in a text count as the library reads them. A null text is empty: 0 tokens.
    Rows with equal doc_id, null included, are counted each by its own text (told apart by 128 bits of hash), and repeated rows
    stay repeated. Other columns are left out; an empty table gives no rows.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    table = stored(pre_token_table(docs, tokenizer), "pre-tokens")
    in_head = head_of(table, head)
    top = table.filter(in_head).select("pre_token", "pieces").toPandas()
    known = spark.sparkContext.broadcast(dict(zip(top["pre_token"], top["pieces"].astype(int), strict=True)))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, heads = encoder(tokenizer), known.value
        for batch in slices(batches, "text"):
            texts = batch["text"]
            values = texts.to_pylist()
            coded = [x.encode() for x in values]
            digests = [xxhash.xxh3_128_digest(x) for x in coded]
            marks, more = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2).T.tolist()
            done = np.zeros(len(values), np.int64)
            rows, names, counts = np.zeros(0, np.int64), [], np.zeros(0, np.int64)
            if coder.kind is None:
                whole = np.arange(len(values))
            else:
                lists, special, whole = coder.cut_all(texts)
                done += special
                rows, names, counts = _split(coder, heads, lists, done)
            if len(whole):
                done[whole] += [len(x) for x in coder.library([values[i] for i in whole])]
            ids = batch["doc_id"].to_pylist()
            yield _columns(
                doc_id=[*ids, *(ids[i] for i in rows)],
                mark=[*marks, *(marks[i] for i in rows)],
                more=[*more, *(more[i] for i in rows)],
                n_rows=[1] * len(ids) + [0] * len(rows),
                n_bytes=[*map(len, coded), *[0] * len(rows)],
                done=[*done.tolist(), *[0] * len(rows)],
                pre_token=[*(f"\0{i} {m}" for i, m in zip(ids, marks, strict=True)), *names],
                n=[*[0] * len(ids), *counts.tolist()],
            )

    schema = "doc_id long, mark long, more long, n_rows long, n_bytes long, done long, pre_token string, n long"
    # A document's own row has a key that no pre-token has, and passes the join beside its frequencies.
    rest = table.filter(~in_head).select("pre_token", "pieces")
    counted = join_reduced(docs.mapInArrow(frequencies, schema), rest, "pre_token", "left")
    sums = counted.groupBy("doc_id", "mark", "more").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_bytes").alias("n_bytes"),
        F.sum(F.col("done") + F.col("n") * F.coalesce(F.col("pieces"), F.lit(0))).alias("n_tokens"),
    )
    each = sums.select(
        "doc_id",
        F.expr("n_bytes div n_rows").alias("n_bytes"),
        F.expr("n_tokens div n_rows").alias("n_tokens"),
        F.explode(F.sequence(F.lit(1), "n_rows")).alias("row"),
    )
    return each.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def _split(coder, heads: dict[str, int], lists: pa.ListArray, done: np.ndarray) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Adds what the head has of each text to ``done``; the rest as text, pre-token and count."""
    coded = lists.flatten().dictionary_encode()
    sums, tails = [], []
    for piece in coded.dictionary.to_pylist():
        total, tail = 0, None
        for token in coder.pre_tokens(piece):
            pieces = heads.get(token)
            if pieces is None:
                tail = [*(tail or ()), token]
            else:
                total += pieces
        sums.append(total)
        tails.append(tail)
    use = coded.indices.to_numpy(zero_copy_only=False)
    at = lists.offsets.to_numpy()
    each = np.array(sums, np.int64)[use] if len(sums) else np.zeros(0, np.int64)
    ends = np.concatenate([[0], np.cumsum(each)])
    done += ends[at[1:]] - ends[at[:-1]]
    has = np.array([t is not None for t in tails], bool)
    places = np.flatnonzero(has[use]) if len(tails) else np.zeros(0, np.int64)
    row = np.searchsorted(at, places, side="right") - 1
    found = Counter()
    for i, k in zip(row.tolist(), use[places].tolist(), strict=True):
        for token in tails[k]:
            found[i, token] += 1
    rows = np.fromiter((i for i, _ in found), np.int64, len(found))
    return rows, [t for _, t in found], np.fromiter(found.values(), np.int64, len(found))


def _columns(**values: list) -> pa.RecordBatch:
    kinds = {"pre_token": pa.string()}
    return pa.RecordBatch.from_arrays([pa.array(v, kinds.get(k, pa.int64())) for k, v in values.items()], names=list(values))
