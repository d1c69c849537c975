"""Conversations written by a compiled chat template, and read back from what was written."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from doclake.llm.common import slices
from doclake.llm.templates import compiled, unescape

#: One heading and one closing mark per turn; control strings in texts and roles are escaped, assistant texts are learnt.
TURNS = (
    "{% for m in messages %}### {{ m.role | escape_head }}:\n"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}{{ m.text | escape }}{% endif %}</turn>\n{% endfor %}"
)
_TURN = re.compile(r"### ((?:\\.|[^\\:])*):\n((?:\\.|[^\\<]|<(?!/turn>))*+)</turn>\n", re.S)
_CHUNK_CHARS = 1 << 20


def format_conversations(turns: DataFrame, template: str = TURNS) -> DataFrame:
    """``(conv_id, chunk, start, text, spans)``: each conversation as the template writes it, in chunks in order.

    ``turns (conv_id, turn, role, text)`` are rendered in order of turn (ties: by role, then text; a null turn first); a
    null role or text is empty. ``start`` is the chunk's place in the whole output, ``spans`` its stretches ``{begin, end}``
    between generation marks, both in code points. A chunk ends after a whole turn once it is long enough, so a
    conversation of any number of turns is streamed through its task, never held. Rows without conv_id form one
    conversation. Other columns are left out; no turns give no rows.
    """
    compiled(template)  # a template that cannot be read fails here, not in a task

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = compiled(template)

        def rows() -> Iterator[tuple]:
            for batch in slices(batches, "text"):
                yield from zip(*(batch[c].to_pylist() for c in ("conv_id", "role", "text")), strict=True)

        for conv, group in groupby(rows(), key=lambda r: r[0]):
            messages = ({"role": role, "text": text} for _, role, text in group)
            chunk, start, size, texts, spans = 0, 0, 0, [], []
            for part in run(messages=messages):
                text, learnt = part
                if text is None:  # a whole turn is written
                    if size >= _CHUNK_CHARS:
                        yield _chunk(conv, chunk, start, texts, spans)
                        chunk, start, size, texts, spans = chunk + 1, start + size, 0, [], []
                    continue
                if learnt and text:
                    spans.append({"begin": size, "end": size + len(text)})
                texts.append(text)
                size += len(text)
            if texts or not chunk:
                yield _chunk(conv, chunk, start, texts, spans)

    turns = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", *(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text"))
    )
    placed = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return placed.mapInArrow(render, "conv_id long, chunk int, start long, text string, spans array<struct<begin:int,end:int>>")


def _chunk(conv: int | None, chunk: int, start: int, texts: list[str], spans: list[dict]) -> pa.RecordBatch:
    kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
    columns = (([conv], pa.int64()), ([chunk], pa.int32()), ([start], pa.int64()), (["".join(texts)], pa.string()), ([spans], kind))
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in columns], names=["conv_id", "chunk", "start", "text", "spans"])


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation what the output of :data:`TURNS` says, its chunks being together and in order.

    ``n_turns``; ``turns_sha256`` of role, newline, text, newline for each turn; ``loss_chars`` and ``loss_sha256`` of the
    unescaped text under the loss mask; ``formatted_chars``. Raises if an output does not consist of turns.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(batch[c].to_pylist() for c in ("conv_id", "text", "spans")), strict=True)

        for conv, group in groupby(rows(), key=lambda r: r[0]):
            turns, loss, n, chars, loss_chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
            for _, text, spans in group:
                at = 0
                while at < len(text):
                    m = _TURN.match(text, at)
                    if not m:
                        raise ValueError(f"conversation {conv}: no turn at {chars + at}")
                    turns.update(f"{unescape(m[1])}\n{unescape(m[2])}\n".encode())
                    n, at = n + 1, m.end()
                for span in spans:
                    learnt = unescape(text[span["begin"] : span["end"]])
                    loss.update(learnt.encode())
                    loss_chars += len(learnt)
                chars += len(text)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([conv], pa.int64()),
                    pa.array([n], pa.int64()),
                    pa.array([turns.hexdigest()]),
                    pa.array([loss_chars], pa.int64()),
                    pa.array([loss.hexdigest()]),
                    pa.array([chars], pa.int64()),
                ],
                names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return formatted.select("conv_id", "text", "spans").mapInArrow(read, schema)
