from __future__ import annotations

import json

import pytest
from pyspark.sql import Row, functions as F

from doclake import schemas
from doclake.operators import aggregates, batching, documents, flatten, incremental, registry, runlog, tables
from doclake.operators.layout import html_parts, layout_from_html, layout_from_text
from tests.conftest import rows


def parsed_of(spark, *payloads, path="/p"):
    data = [("s", f"{path}{i}", f"f{i}.txt", json.dumps(p), "2024-01-01 00:00:00", "r1") for i, p in enumerate(payloads)]
    df = spark.createDataFrame(data, "source_name string, source_path string, file_name string, j string, t string, pipeline_run_id string")
    return df.select(
        "source_name", "source_path", "file_name", F.parse_json("j").alias("parsed_output"), F.to_timestamp("t").alias("parsed_at"), "pipeline_run_id"
    )


def doc(elements=(), pages=(), errors=None, **more):
    result = {"document": {"elements": list(elements), "pages": list(pages)}, **more}
    if errors is not None:
        result["error_status"] = errors
    return result


BOX = {"page_id": 0, "coord": [1, 2.7, "3", 4, 5]}


def test_elements_without_boxes_vanish(spark):
    elements = [
        {"id": 0, "type": "text", "content": "a", "bbox": [BOX, {"page_id": "1", "coord": [1]}]},
        {"id": 1, "type": "text", "bbox": []},
        {"id": 2, "type": "text"},
        {"id": 3, "type": "text", "bbox": None},
        {"id": 4, "type": "text", "bbox": "scalar"},
        {"id": "7", "type": 5, "content": "", "description": "d", "bbox": [{"coord": None}], "extra": {"x": 1}},
    ]
    parsed = parsed_of(spark, doc(elements), doc(), {}, {"document": "odd"}, {"document": {"elements": {"a": 1}}})
    got = flatten.flatten_elements(parsed)
    assert got.columns == schemas.DOCUMENT_ELEMENTS.names
    picked = got.select("element_id", "element_type", "content", "page_id", "bbox_index", "bbox_x1", "bbox_y1", "bbox_x2", "bbox_y2")
    assert rows(picked) == sorted(
        [(0, "text", "a", 0, 0, 1, 2, 3, 4), (0, "text", "a", 1, 1, 1, None, None, None), (7, "5", "", None, 0, None, None, None, None)], key=repr
    )
    assert got.filter("element_id = 0").first()["bounding_box_json"] == '[{"coord":[1,2.7,"3",4,5],"page_id":0},{"coord":[1],"page_id":"1"}]'
    kept = flatten.flatten_elements(parsed, outer=True).groupBy("element_id").count()
    assert rows(kept) == [(0, 2), (1, 1), (2, 1), (3, 1), (4, 1), (7, 1)]


def test_bad_values_raise_or_become_null(spark):
    parsed = parsed_of(spark, doc([{"id": "z", "type": "text", "bbox": [BOX]}]))
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
        flatten.flatten_elements(parsed).collect()
    assert rows(flatten.flatten_elements(parsed, on_error="null").select("element_id", "bbox_x2")) == [(None, 3)]
    with pytest.raises(ValueError):
        flatten.flatten_elements(parsed, on_error="ignore")


def test_page_errors(spark):
    pages = [{"id": 0, "image_uri": "u"}, {"id": 1}]
    twice = parsed_of(spark, doc(pages=pages, errors=[{"page_id": 1}, {"page_id": 1}, {"page_id": None}, {"page_id": 9}]), doc(pages=pages, errors=[]), doc(pages=pages))
    for match in ("document", "path"):
        got = flatten.flatten_pages(twice, match=match).select("source_path", "page_number", "has_parse_errors", "page_has_error")
        assert rows(got) == sorted(
            [("/p0", 0, True, False)] + [("/p0", 1, True, True)] * 2 + [(p, n, False, False) for p in ("/p1", "/p2") for n in (0, 1)], key=repr
        )
        assert flatten.flatten_pages(twice, match=match, distinct_errors=True).count() == 6
    # Two results for one path share their errors only when matched by path.
    shared = parsed_of(spark, doc(pages=pages, errors=[{"page_id": 0}]), doc(pages=pages)).withColumn("source_path", F.lit("/same"))
    assert flatten.flatten_pages(shared).filter("page_has_error").count() == 1
    assert flatten.flatten_pages(shared, match="path").filter("page_has_error").count() == 2
    assert rows(flatten.payload_sizes(parsed_of(spark, doc(pages=pages), {})).drop("source_path")) == [("r1", 0, 2), ("r1", None, None)]


def test_runs_are_kept_apart(spark):
    parsed = parsed_of(spark, doc([{"id": 0, "bbox": [BOX]}], [{"id": 0}], [{"page_id": 0}]))
    both = parsed.unionByName(parsed.withColumn("pipeline_run_id", F.lit("r2")).withColumn("parsed_at", F.to_timestamp(F.lit("2024-01-02 00:00:00"))))
    for match in ("document", "path"):
        assert flatten.flatten_pages(both, match=match).count() == 2
    assert flatten.flatten_elements(both, "r2").count() == 1
    current = flatten.current_rows(flatten.flatten_elements(both), both.drop("parsed_output"))
    assert rows(current.select("pipeline_run_id")) == [("r2",)]


def test_layouts(spark):
    text = spark.createDataFrame([("a\n\nb",), ("",)], "t string").select(layout_from_text(F.col("t"), 2).alias("v"))
    first, second = [json.loads(r[0]) for r in text.select(F.to_json("v")).collect()]
    assert [e["content"] for e in first["document"]["elements"]] == ["a", "", "b"]
    assert [p["id"] for p in first["document"]["pages"]] == [0, 1] and first["document"]["elements"][2]["bbox"][0]["page_id"] == 1
    assert len(second["document"]["elements"]) == 1
    html = '<title>T</title><p class="x">one</li><img src="a>b"><table><tr></tr></table><li>two</p><footer>f</footer><pre>no</pre><p>open'
    pages = spark.createDataFrame([(html,), ("none",)], "h string")
    assert [tuple(p) for p in pages.select(html_parts(F.col("h"))).first()[0]] == [
        ("title", "T"), ("p", "one"), ("img", None), ("table", "<tr></tr>"), ("li", "two"), ("footer", "f")]
    laid = json.loads(pages.select(F.to_json(layout_from_html(F.col("h")))).first()[0])
    assert [(e["type"], e.get("content")) for e in laid["document"]["elements"]] == [
        ("title", "T"), ("text", "one"), ("figure", None), ("table", "<table><tr></tr></table>"), ("text", "two"), ("footer", "f")]
    assert json.loads(pages.select(F.to_json(layout_from_html(F.col("h")))).collect()[1][0])["document"]["elements"] == []


def test_upsert_and_duplicates(spark):
    schema = "document_id string, file_name string, sync_status string, staging_path string"
    target = spark.createDataFrame([("a", "A", "synced", "/a"), ("b", "B", "synced", "/b")], schema)
    source = spark.createDataFrame([("b", "B2", "failed", None), ("c", "C", "synced", "/c")], schema)
    merged = registry.upsert(target, source, update_cols=["sync_status", "staging_path"])
    assert rows(merged) == [("a", "A", "synced", "/a"), ("b", "B", "failed", None), ("c", "C", "synced", "/c")]
    assert rows(registry.upsert(target.limit(0), source)) == rows(source)
    twice = source.unionByName(source.withColumn("sync_status", F.lit("zz")))
    latest = registry.dedupe_latest(twice, ["document_id"], ["sync_status"])
    assert rows(latest) == [("b", "B2", "zz", None), ("c", "C", "zz", "/c")]
    with pytest.raises(Exception, match="more than one row"):
        registry.dedupe_latest(twice, ["document_id"], ["sync_status"], "error").collect()
    assert rows(registry.dedupe_latest(source, ["document_id"], ["sync_status"], "error")) == rows(source)


def registry_of(spark, *entries):
    df = spark.createDataFrame(list(entries), "staging_path string, content_hash string, sync_status string, pipeline_run_id string")
    return df


def test_edited_and_unreadable_files(spark):
    known = registry_of(spark, ("/same", "h1", "synced", "r2"), ("/edited", "h2new", "synced", "r2"), ("/unreadable", "", "synced", "r2"),
                        ("/new", "h3", "synced", "r2"), ("/copy", "h3", "synced", "r2"), ("/bad", None, "failed", "r2"), ("/old", "h9", "synced", "r1"))
    parsed = spark.createDataFrame([("/same", "h1"), ("/edited", "h2"), ("/unreadable", "")], "source_path string, content_hash string")
    def new(mode):
        return [r[0] for r in incremental.not_yet_parsed(known, parsed, "r2", mode).select("staging_path").orderBy("staging_path").collect()]
    assert new("parsed_hash") == ["/copy", "/edited", "/new", "/unreadable"]
    assert new("registry_hash") == ["/copy", "/new"]
    once = incremental.one_per_content(incremental.not_yet_parsed(known, parsed, "r2"))
    assert [r[0] for r in rows(once.select("staging_path"))] == ["/copy", "/edited", "/unreadable"]
    with pytest.raises(ValueError):
        incremental.not_yet_parsed(known, parsed, "r2", "other")


@pytest.mark.parametrize("count", [0, 1, 7, 101])
def test_ranks_and_batches(spark, count):
    raw = spark.range(count).select(F.concat(F.lit("/"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("source_path"), (F.col("id") % 3).alias("file_size_bytes"))
    ranked = sorted((r["rn"], -r["file_size_bytes"], r["source_path"]) for r in batching.global_rank(raw).collect())
    assert [r[0] for r in ranked] == list(range(1, count + 1))
    assert [r[1:] for r in ranked] == sorted(r[1:] for r in ranked)
    batches = [r["documents"] for r in batching.batch_balance(batching.assign_batches(raw, 10)).collect()]
    assert len(batches) == (max(1, -(-count // 10)) if count else 0)
    assert not batches or max(batches) - min(batches) <= 1
    contiguous = [r["documents"] for r in batching.batch_balance(batching.assign_batches(raw, 10, "contiguous")).collect()]
    assert contiguous == [10] * (count // 10) + ([count % 10] if count % 10 else [])


def test_log_events_fold_to_the_last_value(spark):
    raw = spark.createDataFrame([("s", "/a", "a", "r1"), ("s", "/b", "b", "r1")], "source_name string, source_path string, file_name string, pipeline_run_id string")
    one = raw.filter("source_path = '/a'")
    events = runlog.log_events(raw, 1, status=F.lit("queued"), attempt_number=F.lit(0)).unionByName(
        runlog.log_events(one, 3, status=F.lit("failed"), error_message=F.repeat(F.lit("x"), F.lit(2000)))
    ).unionByName(runlog.log_events(one, 2, status=F.lit("processing"), batch_id=F.lit(4)))
    folded = {r["source_path"]: r for r in runlog.fold_log(events).collect()}
    assert (folded["/a"]["status"], folded["/a"]["batch_id"], folded["/a"]["attempt_number"], len(folded["/a"]["error_message"])) == ("failed", 4, 0, 1000)
    assert (folded["/b"]["status"], folded["/b"]["batch_id"]) == ("queued", None)
    log = runlog.open_log(raw, F.lit(None).cast("timestamp"))
    moved = runlog.log_transition(log, one.unionByName(one), "r1", status=F.lit("processing"))
    assert rows(moved.select("source_path", "status")) == [("/a", "processing"), ("/b", "queued")]
    assert rows(runlog.log_transition(log, one, "r2", status=F.lit("x")).select("status")) == [("queued",)] * 2
    assert log.schema.names == schemas.PROCESSING_LOG.names


def test_document_queries_on_edges(spark):
    parsed = parsed_of(spark, doc([{"id": 0, "type": "title", "content": None, "bbox": [BOX, BOX]}], [{"id": 0, "width": 10, "height": 20}]))
    elements, pages = flatten.flatten_elements(parsed), flatten.flatten_pages(parsed)
    log = runlog.open_log(spark.createDataFrame([], "source_name string, source_path string, file_name string, pipeline_run_id string"))
    listed = documents.list_documents(elements, pages, log, limit=1).first()
    assert (listed["total_elements"], listed["total_pages"], listed["status"], listed["element_types"]) == (1, 1, "unknown", {"title": 2})
    assert documents.list_documents(elements, pages, log, offset=5).count() == 0
    for bad in ({"limit": 0}, {"limit": 101}, {"offset": -1}):
        with pytest.raises(ValueError):
            documents.list_documents(elements, pages, log, **bad)
    assert documents.document_detail(elements, pages, log, "no'pe").header.count() == 0
    header = documents.document_detail(elements, pages, log, "f0.txt").header.first()
    assert (header["total_elements"], header["total_pages"]) == (2, 1)
    many = elements.crossJoin(spark.range(5).withColumnRenamed("id", "k")).withColumn("element_id", (4 - F.col("k")).cast("int")).drop("k")
    ordered = documents.page_detail(parsed, many, pages, log, "f0.txt", 0).elements.collect()
    assert [r["element_id"] for r in ordered] == [0, 0, 1, 1, 2, 2, 3, 3, 4, 4]
    detail = documents.page_detail(parsed, elements, pages, log, "f0.txt", 0)
    assert tuple(detail.header.first())[2:] == ("", None, 10, 20)
    assert detail.elements.first()["content"] == ""
    assert documents.page_detail(parsed, elements, pages, log, "f0.txt", 3).header.count() == 0
    none = elements.limit(0)
    stats = {(r["metric"], r["name"]): r["value"] for r in documents.corpus_stats(none, pages.limit(0), log).collect()}
    assert stats == {(m, ""): 0 for m in ("documents", "elements", "pages", "completed", "failed")}
    board = documents.dashboard(documents.corpus_stats(none, pages.limit(0), log)).first()
    assert board["success_rate"] is None and board["element_type_distribution"] == {}
    boxed = documents.normalize_bbox(elements, spark.createDataFrame([("/p0", 0, 2, 3)], "source_path string, page_number int, page_width int, page_height int"), 4, 6)
    assert rows(boxed.select("box_x", "box_y", "box_width", "box_height")) == [(2.0, 4.0, 2.0, 2.0)] * 2
    flat = elements.withColumn("bbox_x2", F.col("bbox_x1"))
    assert documents.normalize_bbox(flat, spark.createDataFrame([], "source_path string, page_number int, page_width int, page_height int"), 4, 6).count() == 0
    assert aggregates.total_bytes(spark.createDataFrame([], "file_size_bytes long")).first()[0] == 0


def test_tables(spark, tmp_path):
    root = str(tmp_path)
    assert tables.read_table(spark, root, "document_pages").count() == 0
    pages = flatten.flatten_pages(parsed_of(spark, doc(pages=[{"id": 0}, {"id": 1}])))
    for _ in range(2):
        tables.append(pages, root, "document_pages")
    tables.append(pages.withColumn("pipeline_run_id", F.lit("2024")), root, "document_pages")
    stored = tables.read_table(spark, root, "document_pages")
    assert stored.schema == schemas.DOCUMENT_PAGES and stored.count() == 4
    target = spark.createDataFrame([("a",)], "document_id string")
    empty = spark.createDataFrame([], schemas.DOCUMENT_REGISTRY)
    tables.replace_snapshot(empty.drop("document_id").join(target, F.lit(False), "right"), root, "document_registry", ["source_name"], ["document_id"])
    first = tables.read_snapshot(spark, root, "document_registry")
    assert first.count() == 1
    tables.replace_snapshot(first.unionAll(first), root, "document_registry")
    assert tables.read_snapshot(spark, root, "document_registry").count() == 2
    assert len(tables.old_snapshots(spark, root, "document_registry")) == 1
    with pytest.raises(ValueError):
        tables.table_path(root, "other")
    with pytest.raises(ValueError):
        tables.replace_run(pages, root, "document_pages", "a/b", [])


def test_catalog_tables(spark):
    for name in schemas.TABLES:
        assert tables.ensure_table(spark, name, "lake_test") == f"lake_test.{name}"
        assert tables.ensure_table(spark, name, "lake_test") == f"lake_test.{name}"
        assert spark.table(f"lake_test.{name}").schema.names == schemas.TABLES[name].names


def test_clustered_files_have_narrow_ranges(spark, tmp_path):
    """Each file covers few values, and a value most rows have is cut over several files."""
    rows_ = spark.range(0, 4000, 1, 4).select(
        F.when(F.col("id") % 4 == 0, F.concat(F.lit("s"), (F.col("id") % 7).cast("string"))).otherwise("hot").alias("source_name"), "id"
    )
    path = str(tmp_path / "clustered")
    # So little data would be merged into one file.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tables.write_clustered(rows_, ["source_name"], path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = (
        spark.read.parquet(path)
        .groupBy(F.input_file_name().alias("file"))
        .agg(F.min("source_name").alias("low"), F.max("source_name").alias("high"), F.count_if(F.col("source_name") == "hot").alias("hot"))
        .collect()
    )
    spans = sorted((f["low"], f["high"]) for f in files)
    assert len(files) == 4 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    assert sum(f["hot"] > 0 for f in files) >= 3


def test_a_file_put_back_is_new_again(spark):
    known = registry_of(spark, ("/back", "A", "synced", "r3"), ("/kept", "B", "synced", "r3"), ("/other", "A", "synced", "r3"))
    parsed = spark.createDataFrame(
        [("/back", "A", 1), ("/back", "B2", 2), ("/kept", "A9", 1), ("/kept", "B", 2)], "source_path string, content_hash string, parsed_at int"
    )
    new = incremental.not_yet_parsed(known, parsed, "r3")
    assert [r[0] for r in rows(new.select("staging_path"))] == ["/back"]


def test_bad_bytes_and_bad_results_are_errors_of_their_document(spark):
    from doclake.functions.payload import has_parse_errors
    from doclake.operators import parse

    raw = spark.createDataFrame([(1, bytearray(b"fine\nline")), (2, bytearray(b"\xff\xfe bad"))], "n int, content binary")
    options = parse.parse_options()
    for extractor in (parse.text_extractor(), parse.html_extractor()):
        got = raw.select("n", has_parse_errors(extractor(F.col("content"), options)).alias("bad"))
        assert rows(got) == [(1, False), (2, True)]

    def load():
        return lambda content, chosen: {"document": {"elements": [], "pages": []}, "error_status": [], "x": float("nan") if content[:1] == b"f" else 1}

    got = raw.select("n", has_parse_errors(parse.python_extractor(load, on_error="status")(F.col("content"), options)).alias("bad"))
    assert rows(got) == [(1, True), (2, False)]


def test_results_of_a_python_extractor_do_not_gather_in_its_worker(spark):
    from doclake.operators import parse

    def load():
        import os

        def resident(content, chosen):
            with open("/proc/self/statm") as pages:
                mb = int(pages.read().split()[1]) * os.sysconf("SC_PAGE_SIZE") // 2**20
            return {"n": int(content), "version": chosen["version"], "mb": mb, "text": "x" * 500_000}

        return resident

    raw = spark.range(0, 300, 1, 1).select("id", F.encode(F.col("id").cast("string"), "UTF-8").alias("content"))
    args = (F.col("content"), parse.parse_options())
    raising = parse.python_extractor(load)
    for parsed in (raising(*args), parse.python_extractor(load, on_error="status")(*args), F.parse_json(raising.attempt(*args)["result"])):
        got = raw.select("id", parsed.alias("p")).select("id", *[F.variant_get("p", f"$.{k}", kind) for k, kind in (("n", "int"), ("version", "string"), ("mb", "int"))]).collect()
        assert [tuple(r)[:3] for r in got] == [(i, i, "2.0") for i in range(300)]
        assert max(r[3] for r in got) - min(r[3] for r in got) < 75


def test_html_tables_stay_whole_in_any_case_of_letters(spark):
    from doclake.operators.layout import html_parts

    page = "<H1>Head</H1><TABLE class=x><tr><td><p>one</p></td><td><ul><li>two</li></ul></td></tr></TABLE><P>last</P>"
    got = spark.createDataFrame([(page,)], "html string").select(F.explode(html_parts(F.col("html"))).alias("p")).select("p.*")
    assert rows(got) == [("h1", "Head"), ("p", "last"), ("table", "<tr><td><p>one</p></td><td><ul><li>two</li></ul></td></tr>")]


def test_nested_html_tables_are_whole(spark):
    import random
    import re

    from doclake.operators.layout import html_parts

    def plain(page):
        """Pairs of table tags by a stack; the outermost ones are parts, what is outside has paragraphs."""
        stack, spans = [], []
        for m in re.finditer(r"(?i)<table(?:\s[^>]*)?>|</table>", page):
            if not m[0].startswith("</"):
                stack.append(m)
            elif stack:
                spans.append((stack.pop(), m))
        outer = [(a, b) for a, b in spans if not any(c.start() < a.start() and b.end() < d.end() for c, d in spans)]
        found = [(a.start(), "table", page[a.end() : b.start()]) for a, b in outer]
        found += [(m.start(), "p", m[1]) for m in re.finditer(r"<p>(.*?)</p>", page) if not any(a.start() < m.start() < b.end() for a, b in outer)]
        return [f[1:] for f in sorted(found)]

    rng = random.Random(1)
    tags = ["<table>", "<TABLE class=x>", "</table>", "</Table>", "<p>a</p>", "<p>b</p>", "<td>c", "rest", "\n", "</table\ufdd0>", "</table\ufdd0\ufdd0>", "<\ufdd0table>", "<p>e</table\ufdd0>f</p>"]
    pages = [
        "<table><tr><td>a<table><tr><td>b</td></tr></table></td><td>rest of the outer table</td></tr></table><p>last</p>",
        "<table>open<p>x</p><table>own<table>in</table>end</table><p>y</p>",
        "</table><table>" * 3 + "<table>" * 500 + "deep" + "</table>" * 500 + "</table></table><p>z</p>",
        *("".join(rng.choice(tags) for _ in range(rng.randrange(30))) for _ in range(300)),
    ]
    got = spark.createDataFrame(list(enumerate(pages)), "n int, html string").select("n", html_parts(F.col("html")).alias("parts")).collect()
    assert {r["n"]: [tuple(p) for p in r["parts"]] for r in got} == {n: plain(page) for n, page in enumerate(pages)}
    assert plain(pages[0])[0] == ("table", "<tr><td>a<table><tr><td>b</td></tr></table></td><td>rest of the outer table</td></tr>")


def test_page_sizes_in_rows(spark):
    """Sizes looked up in the payload: repeated, odd and missing pages, boxes of unknown pages."""
    payload = '''{"document": {"pages": [{"id": 1, "width": 10, "height": 20}, {"id": 0, "width": 5, "height": 6}, {"id": 1, "width": 9, "height": 99},
        {"width": 7, "height": 7}, 3, {"id": 2}], "elements": [{"id": 0, "bbox": [{"page_id": 1, "coord": [0, 0, 5, 5]}, {"page_id": 0, "coord": [1, 1, 9, 9]}]},
        {"id": 1, "bbox": [{"page_id": 2, "coord": [0, 0, 1, 1]}, {"page_id": 7, "coord": [0, 0, 1, 1]}, {"coord": [0, 0, 1, 1]}, 4]}, {"id": 2, "bbox": []}, 8]}}'''
    bare = '{"document": {"elements": [{"id": 0, "bbox": [{"page_id": 0, "coord": [0, 0, 3, 3]}]}]}}'
    table = spark.createDataFrame([("s", f"/p{i}", f"f{i}", "r", p) for i, p in enumerate((payload, bare, "{}", None))], "source_name string, source_path string, file_name string, pipeline_run_id string, raw string")
    parsed = table.withColumn("parsed_at", F.lit("2024-01-01").cast("timestamp")).withColumn("parsed_output", F.parse_json("raw")).drop("raw")
    for outer in (False, True):
        sized = flatten.flatten_elements(parsed, outer=outer, page_sizes=True)
        assert rows(sized.drop("page_width", "page_height")) == rows(flatten.flatten_elements(parsed, outer=outer))
    sizes = {(r["source_path"], r["element_id"], r["bbox_index"]): (r["page_width"], r["page_height"]) for r in flatten.flatten_elements(parsed, page_sizes=True).collect()}
    none = (None, None)
    assert sizes == {("/p0", 0, 0): (10, 20), ("/p0", 0, 1): (5, 6), **{("/p0", 1, i): none for i in range(4)}, ("/p1", 0, 0): none}
    boxes = documents.normalize_bbox(flatten.flatten_elements(parsed, page_sizes=True), None, 4, 6)
    joined = documents.normalize_bbox(flatten.flatten_elements(parsed), flatten.page_dimensions(parsed, key="source_path"), 4, 6)
    assert boxes.count() and rows(boxes) == rows(joined)


def test_list_goes_on_behind_a_row(spark):
    """Pages by cursor meet every document once, in order, with equal times, no times and names that are missing."""
    times = ["2024-01-02 10:00:00.000001", "2024-01-01 00:00:00", None]
    found = [(times[i % 3], f"f{i // 4}" if i % 7 else None, "s" if i % 5 else None, f"/p{i}" if i % 3 else None, i) for i in range(40)]
    elements = spark.createDataFrame(found, "at string, file_name string, source_name string, source_path string, element_id int")
    elements = elements.select(F.col("at").cast("timestamp").alias("parsed_at"), "file_name", "source_name", "source_path", "element_id", F.lit("text").alias("element_type"))
    pages = spark.createDataFrame([], "file_name string, page_number int")
    log = spark.createDataFrame([], "file_name string, status string, completed_at timestamp")
    order = [F.desc("parsed_at"), F.asc("file_name"), F.asc("source_path"), F.asc("source_name")]
    key = ["parsed_at", "file_name", "source_path", "source_name"]
    every = [tuple(r) for r in elements.groupBy("file_name", "source_path", "source_name").agg(F.min("parsed_at").cast("string").alias("parsed_at")).select(*key).orderBy(*order).collect()]
    for at in (None, *range(0, len(every), 3)):
        after = None if at is None else Row(**dict(zip(key, every[at], strict=True)))
        got = [tuple(r[c] for c in key) for r in documents.list_documents(elements, pages, log, limit=4, after=after).collect()]
        start = 0 if at is None else at + 1
        assert got == every[start : start + 4]
