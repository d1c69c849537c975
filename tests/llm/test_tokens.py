"""Token counts, files and packing against the tokenizers library."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from doclake.llm import packing, token_counts, token_files
from doclake.llm.tokens import Encoder
from tests.conftest import rows

WORD, BYTE = (public_tokenizers.path(x) for x in ("word_bpe_49k.json", "byte_bpe_50k.json"))
SIGNS = " \n\t'\u0085\u00a0\x1c\x00.,aAzZ09sStdrelvḿİΣÉé<|>½ªß"
ENCODERS = {p: Encoder(p) for p in (WORD, BYTE)}


@pytest.mark.parametrize("path", [WORD, BYTE])
@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.text(st.sampled_from(SIGNS), max_size=30) | st.text(max_size=20), min_size=1, max_size=6))
def test_ids_are_those_of_the_library(path, texts):
    texts = [*texts, "a <|endoftext|> b", "  <|endoftext|>", ""]
    coder = ENCODERS[path]
    ids, counts = coder.encode(pa.array(texts, pa.string()))
    want = [x.ids for x in coder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert counts.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]


def lengths(path, df):
    tokenizer = Tokenizer.from_file(path)
    return sorted((r["doc_id"], len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids)) for r in df.collect() if r["doc_id"] is not None)


@pytest.mark.parametrize("head", [3, 1 << 19])
def test_counts(odd_docs, no_docs, head):
    got = token_counts.count_tokens(odd_docs, WORD, head=head)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"] and got.count() == odd_docs.count()
    assert sorted((r["doc_id"], r["n_tokens"]) for r in got.collect() if r["doc_id"] is not None) == lengths(WORD, odd_docs)
    assert {r["doc_id"] for r in got.collect() if r["over_limit"]} == {7, 8}
    assert token_counts.count_tokens(no_docs, WORD).count() == 0


@settings(max_examples=80, deadline=None)
@given(texts=st.lists(st.text(st.sampled_from(SIGNS), max_size=30) | st.text(max_size=20), min_size=1, max_size=6))
def test_cuts_hold_all_tokens(texts):
    texts = [*texts, "a<|endoftext|>b <|startoftext|><|endoftext|>", "x\x1cy\x1f <|endoftext|>\x1d.", "a.b1c 'tis don't"]
    coder = ENCODERS[WORD]
    lists, special, whole = coder.cut_all(pa.array(texts, pa.string()))
    got = [
        n + sum(len(coder.model.tokenize(t)) for piece in pieces for t in coder.pre_tokens(piece))
        for n, pieces in zip(special, lists.to_pylist(), strict=True)
    ]
    assert not len(whole) and got == [len(x.ids) for x in coder.tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_pieces_of_no_use_are_forgotten(monkeypatch):
    monkeypatch.setattr("doclake.llm.tokens.MOST_PIECES", 50)
    for path in (WORD, BYTE):
        coder = Encoder(path)
        for i in range(30):
            texts = [f"always here w{i}x, the {chr(97 + i % 26)}{i} (and {'long' * 30}{i}) naïve", f"{i} don't stop"]
            ids, counts = coder.encode(pa.array(texts))
            want = [x.ids for x in coder.tokenizer.encode_batch(texts, add_special_tokens=False)]
            assert counts.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]
            assert len(coder.pieces) <= 50 and len(coder.used) == len(coder.pieces) == len(coder.at) - 1


def test_counts_of_different_texts_under_one_id(spark):
    # Two texts of one crc32, and many of one null id.
    same = ["plumless", "buckeroo"]
    texts = [*same, *(f"text number {i} <|endoftext|>" for i in range(200))]
    docs = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string")
    tokenizer = Tokenizer.from_file(WORD)
    want = sorted((len(t.encode()), len(tokenizer.encode(t, add_special_tokens=False).ids)) for t in texts)
    assert sorted((r["n_bytes"], r["n_tokens"]) for r in token_counts.count_tokens(docs, WORD, head=5).collect()) == want


def test_files(spark, odd_docs, no_docs, tmp_path):
    tokenizer = Tokenizer.from_file(BYTE)
    for encoding in ("delta", "dictionary"):
        folder = str(tmp_path / encoding)
        token_files.write_token_files(odd_docs, folder, BYTE, end_id=0, encoding=encoding)
        read = token_files.read_token_files(spark, folder)
        got = sorted(read.collect(), key=lambda r: r["start"])
        assert [r["doc_id"] for r in got] == sorted((r["doc_id"] for r in odd_docs.collect()), key=lambda i: -1 if i is None else i)
        assert [r["start"] for r in got] == np.cumsum([0, *(r["n_tokens"] for r in got)])[:-1].tolist()
        want = Counter(tuple(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [0]) for r in odd_docs.collect())
        assert Counter(tuple(r["ids"]) for r in got) == want
        sums = token_files.id_checksums(read).filter("doc_id = 5").first()
        ids = tokenizer.encode("One", add_special_tokens=False).ids + [0]
        assert (sums["n_tokens"], sums["ids_crc32"]) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    assert "ReadSchema: struct<part:int,place:bigint,doc_id:bigint>" in read.select("doc_id", "start")._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    token_files.write_token_files(no_docs, str(tmp_path / "none"), BYTE, end_id=0)
    assert token_files.read_token_files(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(ValueError):
        token_files.write_token_files(no_docs, "x", BYTE, 0, encoding="other")


def sequences_hold(found, capacity):
    for _, group in found.toPandas().sort_values("offset", kind="stable").groupby("sequence_id"):
        group = group.sort_values(["offset", "length"])
        assert group["length"].sum() <= capacity
        assert (group["offset"] == group["length"].cumsum() - group["length"]).all()


def test_packing_documents(odd_docs, no_docs):
    got = packing.pack_documents(odd_docs, WORD, capacity=4096, end_id=1)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    sequences_hold(got, 4096)
    whole = got.groupBy("doc_id").sum("length").filter("doc_id is not null").collect()
    want = Counter()
    for i, n in lengths(WORD, odd_docs):
        want[i] += n + 1
    assert {r[0]: r[1] for r in whole} == dict(want)
    assert packing.pack_documents(no_docs, WORD).count() == 0


def test_packing_many_blocks(spark):
    rng = np.random.default_rng(5)
    sizes = np.minimum(rng.geometric(1 / 900, 3000), 4096).tolist()
    pieces = spark.createDataFrame([(i, int(n), 0, i) for i, n in enumerate(sizes)], "id long, length long, part int, place long")
    got = packing.pack_pieces(pieces, 4096, block=400)
    assert rows(got.select("id", "length")) == sorted(((i, n) for i, n in enumerate(sizes)), key=repr)
    sequences_hold(got, 4096)
    assert got.select("sequence_id").distinct().count() <= packing.lower_bound(np.array(sizes), 4096) * 1.01 + 1


def test_evolution_reaches_a_packing_that_best_fit_misses():
    # Triples that fill bins exactly; largest first does not find them all.
    rng = np.random.default_rng(1)
    sizes = []
    for _ in range(12):
        a, b = rng.integers(260, 400, 2).tolist()
        sizes += [a, b, 1000 - a - b]
    sizes = np.array(sizes)
    plain: packing.Bins = []
    packing.best_fit(plain, np.argsort(-sizes, kind="stable").tolist(), sizes.tolist(), 1000)
    found = packing.evolve(sizes, 1000, 3, 60, 4)
    assert sorted(i for b in found for i in b) == list(range(36)) and all(sizes[b].sum() <= 1000 for b in found)
    assert len(found) <= len(plain)
    child = packing.crossover(found, plain, sizes.tolist(), 1000, rng)
    assert sorted(i for b in child for i in b) == list(range(36))
