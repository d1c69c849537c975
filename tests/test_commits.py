"""Commits of runs: what readers see when runs are killed, repeated or superseded, and which files look-ups open."""

from __future__ import annotations

import json
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from checks.oracle import all_sql
from checks.queries import all_queries
from doclake.operators import commits, documents, flatten, folders
from doclake.operators.parse import python_extractor, text_extractor
from doclake.operators.summaries import summarized_list
from doclake.operators.registry import dedupe_latest, merge_deltas, registry_delta, upsert
from doclake.plans import pipeline, run_pipeline
from doclake.plans.pipeline import open_file, read_current, read_log, read_stats
from tests.conftest import rows
from tests.test_pipeline import corpus, params, write  # noqa: F401
from tools.compare import canonical

TABLES = ["raw_documents", "parsed_documents", "document_elements", "document_pages", "batch_attempts", "processing_log"]


def state(spark, root):
    """Everything readers see, but times and results as VARIANT."""
    timed = {"parsed_at", "ingested_at", "started_at", "completed_at", "parse_duration_ms", "duration_ms", "source_modified_at", "parsed_output"}
    seen = {n: commits.read_table(spark, root, n) for n in TABLES}
    seen |= {f"current {n}": read_current(spark, root, n) for n in ("document_elements", "document_pages")}
    found = {n: rows(df.drop(*timed)) for n, df in seen.items()}
    found["log"] = rows(read_log(spark, root).drop(*timed))
    found["registry"] = rows(commits.read_registry(spark, root).drop("synced_at", "registered_at"))
    return found


def test_look_ups_open_few_files(spark, tmp_path):
    folder = tmp_path / "in"
    for i in range(60):
        write(folder, f"{i % 7}/report {i:03d}.txt", "\n".join(f"line {j} of {i}" for j in range(40)))
    # A file to a task: about one document each, as a large corpus has about 256 MB each.
    p = params(folder, tmp_path, bytes_per_task=300, batch_size=20)
    run_pipeline(spark, p, "r1")
    for name in ("parsed_documents", "document_elements", "document_pages"):
        whole = commits.read_table(spark, p.root, name)
        assert len(whole.inputFiles()) >= 30
        one = commits.read_table(spark, p.root, name, ["report 017.txt"])
        assert 1 <= len(one.inputFiles()) <= 3
        assert rows(one.drop("parsed_output")) == rows(whole.filter("file_name = 'report 017.txt'").drop("parsed_output")) != []
        assert commits.read_table(spark, p.root, name, ["no such name"]).collect() == []
    several = commits.read_table(spark, p.root, "document_elements", ["report 001.txt", "report 059.txt"], page=1)
    assert several.count() == 2 * 12 and len(several.inputFiles()) <= 4
    with pytest.raises(ValueError):
        commits.read_table(spark, p.root, "raw_documents", ["report 017.txt"])
    # The views of one file give what whole tables give.
    part = open_file(spark, p.root, "report 017.txt", 2)
    tables = [read_current(spark, p.root, n) for n in ("parsed_documents", "document_elements", "document_pages")]
    want = documents.page_detail(*tables, read_log(spark, p.root), "report 017.txt", 2)
    got = documents.page_detail(part["parsed"], part["elements"], part["pages"], part["log"], "report 017.txt", 2)
    assert rows(got.header) == rows(want.header) != [] and rows(got.elements) == rows(want.elements) != []


def test_nothing_superseded_is_read_without_a_join(spark, corpus, tmp_path):  # noqa: F811
    p = params(corpus, tmp_path)
    run_pipeline(spark, p, "r1")
    plan = lambda: read_current(spark, p.root, "document_elements")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan() and "Join" not in plan()
    write(corpus, "other.txt", "a new file")
    run_pipeline(spark, p, "r2")
    assert "Exchange" not in plan() and "Join" not in plan()
    write(corpus, "deep/1/doc 1.TXT", "edited")
    run_pipeline(spark, p, "r3")
    assert "LeftAnti" in plan()
    for name in ("document_elements", "document_pages"):
        index = commits.read_table(spark, p.root, "parsed_documents").select("source_path", "parsed_at", "pipeline_run_id")
        want = flatten.current_rows(commits.read_table(spark, p.root, name), index)
        assert rows(read_current(spark, p.root, name)) == rows(want)
    # The first run again: its edited document is now the latest, and no older pair takes its rows away.
    write(corpus, "deep/1/doc 1.TXT", "edited twice\nand longer")
    run_pipeline(spark, p, "r1")
    text = read_current(spark, p.root, "document_elements").filter("file_name = 'doc 1.TXT'")
    assert rows(text.select("content")) == [("and longer",), ("edited twice",)]


def test_stats_of_runs_follow_what_is_superseded(spark, corpus, tmp_path):  # noqa: F811
    p = params(corpus, tmp_path)

    def check():
        tables = [read_current(spark, p.root, n) for n in ("document_elements", "document_pages")]
        read = read_log(spark, p.root)
        want = rows(documents.corpus_stats(*tables, read))
        assert rows(read_stats(spark, p.root)) == want
        # So few names are counted by a sketch without error.
        assert rows(read_stats(spark, p.root, approximate=True)) == want
        summaries = read_current(spark, p.root, "document_summaries")
        assert summarized_list(summaries, read, limit=50).collect() == documents.list_documents(*tables, read, limit=50).collect()
        return dict((r[0], r[2]) for r in want if r[1] == "")

    run_pipeline(spark, p, "r1")
    first = check()
    assert commits.runs_with_states(spark, p.root) == ({"r1"}, set())
    write(corpus, "deep/1/doc 1.TXT", "edited")
    write(corpus, "other.txt", "new\nlines")
    run_pipeline(spark, p, "r2")
    second = check()
    assert commits.runs_with_states(spark, p.root) == ({"r1", "r2"}, {"r1"})
    assert second["documents"] == first["documents"] + 1
    # Edited once more by a third run, then the second again: what it superseded at first is superseded by others now.
    write(corpus, "deep/1/doc 1.TXT", "edited\nagain")
    run_pipeline(spark, p, "r3")
    check()
    write(corpus, "other.txt", "shorter")
    run_pipeline(spark, p, "r2")
    check()
    # Nothing to do: no states, nothing counted twice.
    run_pipeline(spark, p, "r4")
    check()
    one = commits.read_table(spark, p.root, "document_summaries", ["other.txt"])
    assert len(one.inputFiles()) <= 2 and one.count() == 1


@pytest.mark.parametrize("stage", ["sync", "ingest", "flatten", "commit 1", "commit 2", "commit 3"])
def test_killed_runs_leave_one_state(spark, corpus, tmp_path, monkeypatch, stage):  # noqa: F811
    p = params(corpus, tmp_path)
    run_pipeline(spark, p, "r1")
    before = state(spark, p.root)
    write(corpus, "deep/1/doc 1.TXT", "edited")
    commit, made = commits.Run.commit, []

    def breaking(function):
        def run(*args, **kwargs):
            result = function(*args, **kwargs)
            raise KeyboardInterrupt
            return result

        return run

    def counted(self):
        made.append(1)
        if stage == f"commit {len(made)}":
            raise KeyboardInterrupt
        return commit(self)

    with monkeypatch.context() as patch:
        patch.setattr(commits.Run, "commit", counted)
        if stage == "supersede":
            patch.setattr(commits.Run, "supersede", breaking(commits.Run.supersede))
        elif not stage.startswith("commit"):
            patch.setattr(pipeline, stage, breaking(getattr(pipeline, stage)))
        with pytest.raises(KeyboardInterrupt):
            run_pipeline(spark, p, "r2")
    after = state(spark, p.root)
    for name in ("parsed_documents", "document_elements", "document_pages", "current document_elements", "current document_pages"):
        assert after[name] == before[name]
    if stage == "commit 1":
        assert after == before
    queued = [r for r in after["log"] if r not in before["log"]]
    assert len(queued) == (0 if stage in ("commit 1", "sync", "commit 2") else 1)
    if stage != "commit 3":
        return
    # The same run again, and another one instead, both find the edited document.
    done = run_pipeline(spark, p, "r2")
    assert (done.to_process, done.parsed) == (1, 1)
    again = state(spark, p.root)
    assert rows(read_current(spark, p.root, "document_elements").filter("file_name = 'doc 1.TXT'").select("content")) == [("edited",)]
    run_pipeline(spark, p, "r2")
    assert state(spark, p.root) == again
    assert commits.unreferenced(spark, p.root)


def test_repeated_with_less(spark, corpus, tmp_path):  # noqa: F811
    p = params(corpus, tmp_path)
    run_pipeline(spark, p, "r1")
    for i in range(1, 7):
        os.remove(corpus / f"deep/{i % 2}/doc {i}.TXT")
    run_pipeline(spark, p, "r1")
    seen = state(spark, p.root)
    assert len(seen["log"]) == len(seen["parsed_documents"]) == len(seen["raw_documents"]) == len(seen["registry"]) == 2
    assert len(seen["current document_elements"]) == 4
    for name in ("deep/0/doc 0.TXT", "empty.txt"):
        os.remove(corpus / name)
    done = run_pipeline(spark, p, "r1")
    assert done.to_process == 0
    assert all(found == [] for found in state(spark, p.root).values())


def test_raw_documents_are_those_of_the_last_run(spark, corpus, tmp_path):  # noqa: F811
    p = params(corpus, tmp_path)
    run_pipeline(spark, p, "r1")
    write(corpus, "new.txt", "one more")
    run_pipeline(spark, p, "r2")
    raw = commits.read_table(spark, p.root, "raw_documents")
    assert rows(raw.select("file_name", "pipeline_run_id")) == [("new.txt", "r2")]


def test_unreadable_files_are_failed_in_the_log(spark, corpus, tmp_path):  # noqa: F811
    reads: dict[str, int] = {}

    def fetch(path):  # hashed once, gone by the time it is loaded
        marker = tmp_path / ("seen " + path.replace("/", "_"))
        if path.endswith("f2") and marker.exists():
            raise OSError("no longer there")
        marker.write_text("x")
        return f"text of {path}".encode()

    manifest = spark.createDataFrame([(f"a/f{i}", i + 1) for i in range(4)], "name string, size long")
    source = {"name": "store", "type": "adls", "manifest": manifest, "container": "c", "storage_account": "acc", "fetch": fetch}
    p = params(corpus, tmp_path, sources=[source])
    done = run_pipeline(spark, p, "r1")
    assert (done.to_process, done.unreadable, done.parsed) == (4, 1, 3) and not reads
    failed = read_log(spark, p.root).filter("status = 'failed'").collect()
    assert [(r["file_name"], r["error_message"]) for r in failed] == [("f2", "no longer there")]
    assert commits.read_table(spark, p.root, "raw_documents").count() == 3


def test_registry_log(spark, corpus, tmp_path):  # noqa: F811
    p = params(corpus, tmp_path, compact_share=100.0)
    for run, change in (("r1", None), ("r2", "deep/0/doc 2.TXT"), ("r3", "added.txt")):
        if change:
            write(corpus, change, f"changed in {run}")
        run_pipeline(spark, p, run)
    parts = commits._deltas(spark, p.root)
    assert [part.rows for part in parts] == [8, 1, 1]  # what was written whole follows the changed files
    registry = commits.read_registry(spark, p.root)
    assert registry.count() == 9 and registry.filter("pipeline_run_id <> 'r3'").count() == 0
    before = rows(registry)
    # Cut short before its commit, a compaction changes nothing; done, it leaves the same rows in one folder.
    commit = commits.Run.commit
    try:
        commits.Run.commit = lambda self: (_ for _ in ()).throw(KeyboardInterrupt())
        with pytest.raises(KeyboardInterrupt):
            commits.compact_registry(spark, p.root, 0.1)
    finally:
        commits.Run.commit = commit
    assert rows(commits.read_registry(spark, p.root)) == before and len(commits._deltas(spark, p.root)) == 3
    assert commits.compact_registry(spark, p.root, 0.1) and not commits.compact_registry(spark, p.root, 0.1)
    assert rows(commits.read_registry(spark, p.root)) == before and len(commits._deltas(spark, p.root)) == 1
    run_pipeline(spark, p, "r4")
    assert rows(commits.read_registry(spark, p.root).select("pipeline_run_id").distinct()) == [("r4",)]
    assert commits.compact_registry(spark, p.root, -1.0) and commits.read_registry(spark, p.root).count() == 9


def test_merged_deltas_are_upserts(spark):
    columns = "document_id string, source_name string, source_type string, original_path string, staging_path string, file_name string, "
    columns += "file_size_bytes long, content_hash string, sync_status string, sync_error string, synced_at timestamp, registered_at timestamp, pipeline_run_id string"
    base = spark.range(0, 400, 1, 4)

    def listed(run, changed):
        """Every other file, or all; of a file's columns some differ between runs."""
        at = F.timestamp_seconds(F.lit(1_700_000_000 + run))
        own = F.when(F.col("id") % changed == 0, run).otherwise(0).cast("string")
        return base.filter(F.col("id") % (run + 1) != 1).select(
            F.col("id").cast("string").alias("document_id"), F.lit("s").alias("source_name"), own.alias("source_type"), own.alias("original_path"),
            F.when(F.col("id") % 5 > 0, own).alias("staging_path"), own.alias("file_name"), own.cast("long").alias("file_size_bytes"),
            own.alias("content_hash"), F.lit("synced").alias("sync_status"), F.lit(None).cast("string").alias("sync_error"),
            at.alias("synced_at"), at.alias("registered_at"), F.lit(f"r{run}").alias("pipeline_run_id"),
        )

    registry = spark.createDataFrame([], columns)
    deltas = []
    for run, changed in ((1, 1000), (2, 50), (3, 7)):
        found = dedupe_latest(listed(run, changed), ["document_id"], ["sync_status"])
        deltas.append(registry_delta(registry, found).withColumn("order", F.lit(run)))
        registry = upsert(registry, found)
    assert deltas[1].filter("seen_only").count() > 100
    log = deltas[0].unionByName(deltas[1]).unionByName(deltas[2])
    assert rows(merge_deltas(log)) == rows(registry)


def test_repeated_keys_in_the_log(spark):
    """Deltas that hold keys more than once, or rows without key, merge as the upserts do: no row is lost, none made up."""
    columns = "document_id string, source_name string, source_type string, original_path string, staging_path string, file_name string, "
    columns += "file_size_bytes long, content_hash string, sync_status string, sync_error string, synced_at timestamp, registered_at timestamp, pipeline_run_id string"

    def found(run, entries):
        df = spark.createDataFrame(entries, "document_id string, file_name string, content_hash string")
        at = F.timestamp_seconds(F.lit(1_700_000_000 + run))
        absent = ("source_name", "source_type", "original_path", "staging_path", "sync_status", "sync_error")
        df = df.select("*", *[F.lit(None).cast("string").alias(c) for c in absent], F.lit(1).cast("long").alias("file_size_bytes"))
        df = df.select("*", at.alias("synced_at"), at.alias("registered_at"), F.lit(f"r{run}").alias("pipeline_run_id"))
        return df.select(*registry.columns)

    registry = spark.createDataFrame([], columns)
    runs = [
        [("one", "f", "h"), ("twice", "f1", "h"), ("twice", "f2", "h"), (None, "f", "h"), ("differ", "f1", "h1"), ("differ", "f2", "h2")],
        [("one", "g", "h"), ("one", "g", "i"), ("twice", "g", "h"), ("new", "n1", "h1"), ("new", "n2", "h2"), (None, "f", "h"), ("differ", "g", "h1")],
        [("one", "g", "i"), ("twice", "g", "h"), ("twice", "g", "k"), ("new", "n1", "h2"), (None, "f", "h"), (None, "f", "i"), ("differ", "g", "h1")],
    ]
    log = None
    for run, entries in enumerate(runs):
        delta = registry_delta(registry, found(run, entries)).withColumn("order", F.lit(run))
        assert delta.count() == len(entries)
        log = delta if log is None else log.unionByName(delta)
        registry = upsert(registry, found(run, entries))
        assert rows(merge_deltas(log)) == rows(registry)
    counts = {r[0]: r[1] for r in registry.groupBy("document_id").count().collect()}
    assert counts == {"one": 2, "twice": 4, "new": 2, None: 4, "differ": 2}
    assert log.filter("seen_only").count() == 4


def test_registry_log_of_pages_that_share_a_url(spark, tmp_path):
    """Two pages of one URL come as two new rows, as in the SQL of the query."""
    sf = "/root/testdata/sf0.001"
    for name in ("documents", "labels"):
        spark.read.parquet(f"{sf}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    again = pages.filter("page_id % 5 = 0").select((F.col("page_id") + 100_000).alias("page_id"), "url", F.concat("html", F.lit("x")).alias("html"))
    pages.unionByName(again).write.parquet(str(tmp_path / "pages.parquet"))
    duck = duckdb.connect()
    for name in ("documents", "labels", "pages"):
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    got = all_queries()["snk5_registry_log"](spark, str(tmp_path))
    cursor = duck.execute(all_sql()["snk5_registry_log"])
    names = [d[0] for d in cursor.description]
    assert canonical(got.collect(), got.columns, sorted(names)) == canonical(cursor.fetchall(), names, sorted(names))


def test_commits_do_not_replace_each_other(spark, tmp_path):
    root = str(tmp_path)
    assert folders.put_once(spark, f"{root}/_commits", "0000000001.json", json.dumps({"run_id": "a", "parts": []}))
    assert not folders.put_once(spark, f"{root}/_commits", "0000000001.json", json.dumps({"run_id": "b", "parts": []}))
    assert commits.Run(spark, root, "b").commit() == 2
    assert [c.run_id for c in commits.history(spark, root)] == ["a", "b"]


def test_a_batch_that_breaks_the_job_is_found(spark, corpus, tmp_path):  # noqa: F811
    plain = text_extractor()

    def breaking(content, options):
        bad = F.when(F.contains(content.cast("string"), F.lit("Title 5")), F.raise_error("bad document")).cast("string")
        return plain(F.coalesce(bad, content.cast("string")).cast("binary"), options)

    p = params(corpus, tmp_path, extractor=breaking, batch_size=2)
    done = run_pipeline(spark, p, "r1")
    assert (done.batches, done.batches_failed, done.retries, done.parsed) == (4, 1, 2, 6)
    log = read_log(spark, p.root)
    assert log.filter("status = 'failed' and error_message like '%bad document%'").count() == 2
    assert read_current(spark, p.root, "parsed_documents").count() == 6


def test_jobs_and_folders_do_not_grow_with_batches(spark, tmp_path):
    folder = tmp_path / "in"
    for i in range(40):
        write(folder, f"f{i:02d}.txt", f"text {i}")
    load = lambda: lambda content, options: {"document": {"elements": [], "pages": [{"id": 0}]}}
    counts = []
    for size in (20, 1):
        where = tmp_path / str(size)
        where.mkdir()
        p = params(folder, where, batch_size=size, extractor=python_extractor(load))
        done = run_pipeline(spark, p, "r1")
        assert (done.batches, done.parsed) == (40 // size, 40)
        counts.append({n: len(folders.children(spark, f"{p.root}/{n}/r1")) for n in ("parsed_documents", "batch_attempts", "raw_documents")})
    assert counts[0] == counts[1] == {"parsed_documents": 1, "batch_attempts": 1, "raw_documents": 1}
