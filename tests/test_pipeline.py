"""Whole runs over real files: increments, re-runs, failures and retries."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from doclake.operators import tables
from doclake.operators.parse import python_extractor, text_extractor
from doclake.operators.runlog import retry_stats
from doclake.plans import PipelineParams, run_batches, run_pipeline
from doclake.plans.pipeline import read_current, read_log
from tests.conftest import rows


def write(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


@pytest.fixture
def corpus(tmp_path):
    folder = tmp_path / "in"
    for i in range(7):
        write(folder, f"deep/{i % 2}/doc {i}.TXT", f"Title {i}\nline é {i}\n" + "x\n" * i)
    write(folder, "notes.md", "not listed")
    write(folder, "empty.txt", "")
    return folder


def params(corpus, tmp_path, **changes):
    settings = dict(
        root=str(tmp_path / "lake"),
        sources=[{"name": "local", "path": str(corpus), "file_pattern": "*.txt"}],
        batch_size=3,
        max_retries=2,
        retry_delay_seconds=0.0,
    )
    return PipelineParams(**{**settings, **changes})


def test_run_rerun_and_increment(spark, corpus, tmp_path):
    p = params(corpus, tmp_path)
    first = run_pipeline(spark, p, "r1")
    assert (first.listed, first.synced, first.failed_to_sync, first.to_process) == (8, 8, 0, 8)
    assert (first.batches, first.batches_failed, first.retries, first.parsed) == (3, 0, 0, 8)
    elements = tables.read_table(spark, p.root, "document_elements")
    assert first.elements == elements.count() == sum(3 + i for i in range(7)) + 1
    log = read_log(spark, p.root)
    assert rows(log.select("status", "attempt_number").distinct()) == [("completed", 1)]
    assert log.filter("started_at <= completed_at and parse_duration_ms >= 0").count() == 8
    counted = {r["source_path"]: r["elements_extracted"] for r in log.collect()}
    assert counted[f"{corpus}/deep/0/doc 4.TXT"] == 7
    registry = tables.read_snapshot(spark, p.root, "document_registry")
    assert registry.count() == 8 and registry.filter("file_name = 'empty.txt' and file_size_bytes = 0").count() == 1

    # The same run again leaves the same rows.
    before = rows(elements.drop("parsed_at"))
    again = run_pipeline(spark, p, "r1")
    assert (again.to_process, again.elements) == (8, first.elements)
    assert rows(tables.read_table(spark, p.root, "document_elements").drop("parsed_at")) == before
    assert read_log(spark, p.root).count() == 8

    # So does one cut into fewer batches: nothing of the three is left behind.
    run_pipeline(spark, params(corpus, tmp_path, batch_size=50), "r1")
    parsed = tables.read_table(spark, p.root, "parsed_documents")
    assert rows(parsed.select("batch_id").distinct()) == [(1,)] and parsed.count() == 8
    assert rows(tables.read_table(spark, p.root, "document_elements").drop("parsed_at", "batch_id")) == rows(
        spark.createDataFrame(before, elements.drop("parsed_at").schema).drop("batch_id")
    )

    # A new run over the same input has nothing to do.
    second = run_pipeline(spark, p, "r2")
    assert (second.synced, second.to_process, second.batches) == (8, 0, 0)

    # An edited file is parsed again, alone, and its old rows are no longer current.
    edited = write(corpus, "deep/1/doc 1.TXT", "New title")
    third = run_pipeline(spark, p, "r3")
    assert (third.to_process, third.elements) == (1, 1)
    current = read_current(spark, p.root, "document_elements")
    assert rows(current.filter(F.col("source_path") == edited).select("content")) == [("New title",)]
    assert current.count() == first.elements - 4 + 1


def test_failing_batches_are_retried_then_left(spark, corpus, tmp_path):
    marker = str(tmp_path / "failed-once")

    def load():
        def parse(content, options):
            if content.startswith(b"Title 6") and not os.path.exists(marker):
                open(marker, "w").close()
                raise RuntimeError("it's broken once")
            if content.startswith(b"Title 5"):
                raise RuntimeError("always")
            return {"document": {"elements": [{"id": 0, "type": "text", "bbox": [{"page_id": 0, "coord": [0, 0, 1, 1]}]}], "pages": [{"id": 0}]}}

        return parse

    p = params(corpus, tmp_path, extractor=python_extractor(load))
    done = run_pipeline(spark, p, "r1")
    assert (done.batches, done.batches_failed, done.retries) == (3, 1, 3)
    stats = retry_stats(tables.read_table(spark, p.root, "batch_attempts")).first()
    assert (stats["batches_completed"], stats["batches_failed"], stats["documents"], stats["retries"]) == (2, 1, done.parsed, 3)
    log = read_log(spark, p.root)
    assert log.filter("status = 'failed'").count() == 8 - done.parsed
    failed = log.filter("status = 'failed'").first()
    assert failed["attempt_number"] == 2 and "always" in failed["error_message"] and failed["parse_duration_ms"] is None
    # The failed documents come up again.
    retry = run_pipeline(spark, params(corpus, tmp_path, extractor=text_extractor()), "r2")
    assert retry.to_process == 8 - done.parsed and retry.batches_failed == 0


def test_broken_source_and_unreadable_file(spark, corpus, tmp_path):
    def fetch(path):
        if path.endswith("2"):
            raise OSError("gone")
        return f"text of {path}".encode()

    manifest = spark.createDataFrame([(f"a/f{i}", i + 1) for i in range(4)] + [("a/b/f1", 9)], "name string, size long")
    p = params(
        corpus,
        tmp_path,
        sources=[
            {"name": "store", "type": "adls", "manifest": manifest, "container": "c", "storage_account": "acc", "fetch": fetch},
            {"name": "nowhere", "type": "adls", "manifest": "no/such/place"},
            {"name": "odd", "type": "ftp"},
        ],
        staging_base="/staging",
    )
    done = run_pipeline(spark, p, "r1")
    assert (done.listed, done.synced, done.failed_to_sync, done.parsed) == (5, 4, 3, 4)
    registry = tables.read_snapshot(spark, p.root, "document_registry")
    failed = registry.filter("sync_status = 'failed'").first()
    assert failed["sync_error"] == "gone" and failed["staging_path"] is None and failed["content_hash"] is None
    names = {r["original_path"].split("/")[-2:][0] + "/" + r["file_name"][:2]: r["staging_path"] for r in registry.filter("sync_status = 'synced'").collect()}
    assert names["b/f1"] == "/staging/store/f1" and names["a/f1"].startswith("/staging/store/f1_")
    # The same files keep their paths in the next run.
    paths = rows(registry.select("document_id", "staging_path"))
    again = run_pipeline(spark, p, "r2")
    assert again.to_process == 0
    assert rows(tables.read_snapshot(spark, p.root, "document_registry").select("document_id", "staging_path")) == paths


def test_batch_attempts_and_pauses():
    waits, calls = [], []

    def write(batch):
        calls.append(batch)
        if batch == 2 and calls.count(2) < 3 or batch == 3:
            raise ValueError("x" * 2000)

    attempts = run_batches([1, 2, 3], write, 3, 10, waits.append)
    assert [(b, a, o) for b, a, o, *_ in attempts] == [
        (1, 1, "completed"),
        (2, 1, "failed"),
        (2, 2, "failed"),
        (2, 3, "completed"),
        (3, 1, "failed"),
        (3, 2, "failed"),
        (3, 3, "failed"),
    ]
    assert waits == [10, 20, 10, 20]
    assert len(attempts[-1].error_message) == 1000 and attempts[0].error_message is None
    assert all(a.duration_ms >= 0 and a.started_at <= a.completed_at for a in attempts)
    with pytest.raises(ValueError):
        run_batches([1], write, 0)
    several = run_batches(list(range(10, 30)), write, 2, 0, parallel=4)
    assert [(b, a, o) for b, a, o, *_ in several] == [(b, 1, "completed") for b in range(10, 30)]


def test_same_content_once(spark, corpus, tmp_path):
    write(corpus, "copy a.txt", "same")
    write(corpus, "copy b.txt", "same")
    done = run_pipeline(spark, params(corpus, tmp_path, dedupe_content=True, parallel_batches=3), "r1")
    assert (done.to_process, done.parsed, done.batches) == (9, 9, 3)
    parsed = tables.read_table(spark, str(tmp_path / "lake"), "parsed_documents")
    assert parsed.select("source_path").distinct().count() == parsed.count() == 9
