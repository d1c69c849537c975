"""Periodic runs, the WARC archive and vector codes against plain versions and round trips."""

from __future__ import annotations

import base64
import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from doclake.llm import periodic_runs, vector_codes, warc_archive


def plain_runs(words, least, repeats):
    """Every period, every stretch of words equal that far on; of stretches found by several periods the smallest."""
    found = {}
    for q in range(1, len(words) // repeats + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, repeats * q) and j > i:
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def some_words(rng):
    n, kinds = rng.randint(0, 60), rng.choice([1, 2, 2, 3, 6])
    words = [f"w{rng.randrange(kinds)}" for _ in range(n)]
    if n and rng.random() < 0.6:
        a, p = rng.randrange(n), 1 + rng.randrange(max(1, n // 3))
        words = [words[i] if i < a else words[min(a + (i - a) % p, n - 1)] for i in range(n)]
    return words


@pytest.mark.parametrize("least, repeats", [(24, 3), (6, 3), (2, 2), (5, 2), (3, 3), (9, 4)])
def test_runs_against_every_period(least, repeats):
    rng = random.Random(least * 10 + repeats)
    for _ in range(400):
        texts = [some_words(rng) for _ in range(4)]
        found, collapsed, counts = periodic_runs.text_runs(pa.array([" ".join(t) for t in texts]), least, repeats)
        for words, here, rest, n in zip(texts, found, collapsed.to_pylist(), counts, strict=True):
            assert here == plain_runs(words, least, repeats) and n == len(words)
            gone = {i for s, length, q in here for i in range(s + q, s + length)}
            assert rest == " ".join(w for i, w in enumerate(words) if i not in gone)


def test_suffix_tree_answers_extensions():
    rng = random.Random(5)
    for _ in range(100):
        text = [rng.randint(1, 3) for _ in range(rng.randint(2, 40))]
        tree = periodic_runs.SuffixTree(text)
        suffixes = sorted(range(len(text) + 1), key=lambda i: [*text[i:], 0])
        assert [int(r) for r in np.argsort(tree.rank)] == suffixes
        i, j = (np.array(x) for x in zip(*[(a, b) for a in range(len(text)) for b in range(len(text) + 1) if a != b], strict=True))
        want = [next((k for k in range(len(text)) if max(a, b) + k >= len(text) or text[a + k] != text[b + k]), 0) for a, b in zip(i, j, strict=True)]
        assert tree.common(i, j).tolist() == want


def test_runs_of_odd_documents(spark, odd_docs):
    docs = odd_docs.withColumn("runs", F.lit("own")).withColumn("collapsed", F.lit(1))
    found = periodic_runs.periodic_runs(docs, least=6, repeats=3)
    assert found.columns == [*odd_docs.columns[:-1], "n_words", "runs", "collapsed"]  # odd_docs has its own n_words
    rows = found.collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        words = (r["text"] or "").split()
        assert r["n_words"] == len(words)
        if len(words) < 1000:
            assert [tuple(x) for x in r["runs"]] == plain_runs(words, 6, 3)
        if not words:
            assert r["collapsed"] == ""
    assert periodic_runs.periodic_runs(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        periodic_runs.periodic_runs(docs, repeats=1)


def test_planted_repeats(spark):
    texts = [(i, " ".join(f"w{j}" for j in range(i % 90))) for i in range(200)] + [(None, "a b"), (30, None)]
    rows = periodic_runs.with_planted_repeats(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    changed = 0
    for r in rows:
        if r["doc_id"] is None or r["text"] is None:
            continue
        n, h = r["doc_id"] % 90, zlib.crc32(str(r["doc_id"]).encode())
        words, g = [f"w{j}" for j in range(n)], h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
            changed += 1
        assert r["text"].split() == words
    assert changed


PAGES = [
    (1, "http://a/1", "<p>same é</p>"),
    (2, "http://a/2", "<p>other</p>"),
    (3, None, "<p>same é</p>"),
    (3, None, "<p>same é</p>"),
    (4, "http://a/4\r\nWARC-Type: metadata 50%", None),
    (5, "http://a/5", ""),
    (None, "http://a/6", "<p>same é</p>"),
    (None, None, "<p>alone</p>\r\n\r\n"),
    (7, "http://a/7", "x" * 300_000),
]


def test_archive_gives_records_back(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("digest", F.lit("d")).withColumn("name", F.lit("n"))
    folder = str(tmp_path / "archive")
    warc_archive.write_archive(warc_archive.page_records(pages), folder)
    assert warc_archive.read_payloads(spark, folder).count() == 5  # each distinct payload once
    found = warc_archive.read_records(spark, folder).collect()
    assert len(found) == len(PAGES) and len({r["record_id"] for r in found}) == len(PAGES)
    by_id = {r["record_id"]: r for r in found}
    for r in found:
        head, http, *rest = bytes(r["record"]).split(b"\r\n\r\n", 2)
        lines = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
        content = bytes(r["record"])[len(head) + 4 : -4]
        assert head.startswith(b"WARC/1.1\r\n") and bytes(r["record"]).endswith(b"\r\n\r\n")
        assert int(lines[b"Content-Length"]) == len(content)
        payload = bytes(r["payload"])
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        assert lines[b"WARC-Payload-Digest"].decode() == f"sha1:{r['payload_digest']}" and r["payload_bytes"] == len(payload)
        assert content.endswith(payload if r["record_type"] == "response" else b"\r\n\r\n")
        assert lines[b"WARC-Type"].decode() == r["record_type"]
        if r["record_type"] == "revisit":
            of = by_id[r["refers_to"]]
            assert of["record_type"] == "response" and of["payload"] == r["payload"] and of["name"] == r["refers_to_name"]
        else:
            assert r["refers_to"] is None and r["refers_to_name"] is None
    told = sorted(((r["name"] or 0, r["record_type"], r["refers_to_name"]) for r in found), key=str)
    assert told == sorted(
        [(0, "response", None), (0, "revisit", 3), (1, "revisit", 3), (2, "response", None), (3, "response", None), (3, "revisit", 3)]
        + [(4, "revisit", 5), (5, "response", None), (7, "response", None)],
        key=str,
    )


def test_archive_notices_damage(spark, tmp_path):
    pages = spark.createDataFrame(PAGES[:3], "page_id long, url string, html string")
    whole, bad = str(tmp_path / "whole"), str(tmp_path / "bad")
    warc_archive.write_archive(warc_archive.page_records(pages), whole)
    spark.read.parquet(f"{whole}/records").write.parquet(f"{bad}/records")
    payloads = spark.read.parquet(f"{whole}/payloads")
    other = F.encode(F.lit("<p>changed</p>"), "UTF-8")
    payloads.withColumn("payload", F.when(F.length("payload") == 12, other).otherwise(F.col("payload"))).write.parquet(f"{bad}/payloads")
    with pytest.raises(Exception, match="not what its digest says"):
        warc_archive.read_records(spark, bad).select("name", "payload_digest").collect()
    lost = str(tmp_path / "lost")
    spark.read.parquet(f"{whole}/records").write.parquet(f"{lost}/records")
    payloads.filter(F.length("payload") == 12).write.parquet(f"{lost}/payloads")
    with pytest.raises(Exception, match="does not fit its payload"):
        warc_archive.read_records(spark, lost).select("name").collect()
    empty = str(tmp_path / "empty")
    warc_archive.write_archive(warc_archive.page_records(pages.limit(0)), empty)
    assert warc_archive.read_records(spark, empty).collect() == []


def plain_codes(rows, parts, entries, rounds):
    """Rounds of whole-number assignment and floors, one vector at a time."""
    kept = [(v, [int(np.floor(np.float64(x) * 1024)) for x in e], label) for v, e, label in rows if e is not None and all(x is not None and np.isfinite(x) for x in e)]
    width = len(kept[0][1]) // parts
    cut = lambda e, p: e[p * width : (p + 1) * width]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[list(cut(e, p)) for _, e, _ in first] for p in range(parts)]

    def near(piece, book):
        return min((sum((a - b) ** 2 for a, b in zip(piece, entry, strict=True)), k) for k, entry in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for _, e, _ in kept:
                groups.setdefault(near(cut(e, p), books[p])[1], []).append(cut(e, p))
            for k, pieces in groups.items():
                books[p][k] = [sum(c) // len(pieces) for c in zip(*pieces, strict=True)]
    coded = []
    for v, e, label in kept:
        best = [near(cut(e, p), books[p]) for p in range(parts)]
        coded.append((v, "".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best), label))
    by_label = {}
    for _, _, error, label in coded:
        by_label[label] = by_label.get(label, 0) + error
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted(((v, code, error, by_label[label], digest) for v, code, error, label in coded), key=str)


def codes(spark, rows, parts=2, entries=8, rounds=3, most=256):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("row", F.lit("x")).withColumn("key", F.lit(1))
    vectors = vector_codes.whole_numbers(table)
    blocks = vector_codes.hilbert_blocks(vectors, parts, most)
    books = vector_codes.learn(blocks, vector_codes.first_entries(vectors, parts, entries), rounds)
    return sorted((tuple(r) for r in vector_codes.encode(vectors, blocks, books).collect()), key=str)


def test_codes_against_plain_rounds(spark):
    rng = np.random.default_rng(7)
    f32 = lambda row: [float(np.float32(x)) for x in row]
    spread = [(i, f32(rng.normal(0, 0.3, 6) + (i % 5)), i % 3) for i in range(150)]
    hot = [(1000 + i, f32([0.25, -0.5, 1, 0, 0, -1]), None) for i in range(120)]
    odd = [(1, None, 1), (2, [float("nan")] * 6, 1), (3, [1.0, 2.0, float("inf"), 0.0, 0.0, 0.0], 1), (4, [1.0, None, 0.0, 0.0, 0.0, 0.0], 2)]
    twice = [(5, f32([9, 9, 9, 9, 9, 9]), 4), (5, f32([9, 9, 9, 9, 9, 9]), 4), (None, f32([-9, 1, 2, 3, 4, 5]), None)]
    rows = spread + hot + odd + twice
    assert codes(spark, rows, most=16) == codes(spark, rows) == plain_codes(rows, 2, 8, 3)
    # Ties between equal entries go to the first; large components leave float64's whole numbers.
    ties = [(i, f32([i % 2, 0, 1, 1]), 0) for i in range(20)]
    assert codes(spark, ties) == plain_codes(ties, 2, 8, 3)
    large = [(i, f32([(-1) ** i * 60_000 + i, i * 1000, -i, 0.5]), 0) for i in range(30)]
    assert codes(spark, large) == plain_codes(large, 2, 8, 3)


def test_codes_of_few_or_no_vectors(spark):
    assert codes(spark, []) == []
    assert codes(spark, [(1, None, 1)]) == []
    one = [(3, [1.0, -1.0], None)]
    assert codes(spark, one) == plain_codes(one, 2, 8, 3)
    assert codes(spark, [(1, [], 2)]) == [(1, "0000", 0, 0, hashlib.sha256(b"").hexdigest())]
    with pytest.raises(ValueError):
        codes(spark, [(1, [1.0, 2.0], 1), (2, [1.0, 2.0, 3.0, 4.0], 1)])
    with pytest.raises(Exception, match="too large"):
        codes(spark, [(1, [1e9, 2.0], 1)])


def test_hilbert_curve_visits_neighbours():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), axis=-1).reshape(-1, 3)
    keys = vector_codes.hilbert_keys(cells, 3)
    assert sorted(keys.tolist()) == list(range(512))
    path = cells[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()
