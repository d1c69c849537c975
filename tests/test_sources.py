from __future__ import annotations

import fnmatch
import hashlib
from random import Random

import pytest
from pyspark.sql import functions as F

from doclake.functions import content_hash, matches_pattern, matches_search, preview, strip_scheme
from doclake.operators.parse import parse_options
from doclake.sources import (
    assign_staging_path,
    files_from_library_manifest,
    files_from_tree_manifest,
    list_files,
    load_raw,
    read_source,
    register_source,
    resolve_roots,
    stage_with_isolation,
    supported_types,
)
from tests.conftest import rows

PATTERN_CASES = {
    "*.pdf": {"a.pdf": True, "A.PDF": True, "a.pdf.txt": False, "pdf": False},
    "*.{pdf, docx}": {"a.pdf": True, "B.DOCX": True, "c.txt": False, "docx": False},
    "*.{PDF}": {"a.pdf": False, "a.PDF": False},
    "report_[0-9]*": {"Report_7x": True, "report_x": False, "my report_1": False},
    "[!a]?.t*": {"bc.txt": True, "ac.txt": False, "b.txt": False},
    "*": {"": True, "any thing": True},
    "a+b(c).txt": {"A+B(C).TXT": True, "aab(c).txt": False},
    "x[]^]y": {"x]y": True, "x^y": True, "xay": False},
    "*a*\n*": {"ba\nc": True, "ba c": False},
}


@pytest.mark.parametrize("pattern", PATTERN_CASES)
def test_patterns(spark, pattern):
    cases = PATTERN_CASES[pattern]
    df = spark.createDataFrame([(n,) for n in cases], "name string")
    got = {r["name"]: r["hit"] for r in df.select("name", matches_pattern(F.col("name"), pattern).alias("hit")).collect()}
    assert got == cases


def test_patterns_agree_with_shell_globs(spark):
    """Random patterns and names, against the standard library."""
    random = Random(7)
    patterns = sorted({"".join(random.choices("aab.*?[]!-^c", k=random.randint(1, 7))) for _ in range(250)})
    names = sorted({"".join(random.choices("aAb.]^-c[!", k=random.randint(0, 5))) for _ in range(400)})
    df = spark.createDataFrame([(n,) for n in names], "name string").coalesce(1)
    for start in range(0, len(patterns), 50):
        some = patterns[start : start + 50]
        hits = df.select("name", *[matches_pattern(F.col("name"), p).alias(f"p{i}") for i, p in enumerate(some)])
        for row in hits.collect():
            for i, pattern in enumerate(some):
                assert row[i + 1] == fnmatch.fnmatchcase(row["name"].lower(), pattern), (pattern, row["name"])


def test_roots():
    assert resolve_roots(["/a/", "b"], "/c/", strip="/") == ["a", "b", "c"]
    assert resolve_roots(None, "/", [""], strip="/") == [""]
    assert resolve_roots([], "") == []
    assert resolve_roots(["x", "x"], "x") == ["x", "x", "x"]


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "sub dir/deeper").mkdir(parents=True)
    (tmp_path / "a.PDF").write_bytes(b"one")
    (tmp_path / "sub dir/it's.pdf").write_bytes(b"two!")
    (tmp_path / "sub dir/deeper/empty.pdf").write_bytes(b"")
    (tmp_path / "note.txt").write_bytes(b"x")
    (tmp_path / "_hidden.pdf").write_bytes(b"h")
    (tmp_path / "part=1").mkdir()
    (tmp_path / "part=1/p.pdf").write_bytes(b"p")
    return str(tmp_path)


def test_list_files(spark, folder):
    found = list_files(spark, [folder], "*.pdf")
    assert rows(found.select("file_name", "file_size_bytes")) == sorted(
        [("a.PDF", 3), ("it's.pdf", 4), ("empty.pdf", 0), ("_hidden.pdf", 1), ("p.pdf", 1)], key=repr
    )
    flat = list_files(spark, [folder, "file:" + folder], "*", recursive=False)
    assert rows(flat.select("file_name")) == sorted([(n,) for n in ["a.PDF", "note.txt", "_hidden.pdf"] * 2], key=repr)
    nested = list_files(spark, [folder, folder + "/sub dir"], "it*")
    assert rows(nested.select("original_path")) == [(f"{folder}/sub dir/it's.pdf",)] * 2
    assert list_files(spark, ["/no/such/folder"]).count() == 0
    assert list_files(spark, []).count() == 0


def test_read_source(spark, folder):
    assert read_source(spark, {"paths": [folder], "file_pattern": "*.txt"}).count() == 1
    with pytest.raises(ValueError, match="adls, google_drive, sharepoint, volume"):
        read_source(spark, {"type": "ftp"})
    register_source("listing", lambda session, source: source["files"])
    assert "listing" in supported_types()
    files = list_files(spark, [folder])
    assert read_source(spark, {"type": "listing", "files": files}).count() == files.count()


def test_bytes_and_failures(spark, folder):
    files = list_files(spark, [folder], "*.pdf").withColumn("source_name", F.lit("s"))
    gone = spark.createDataFrame([("/gone.pdf", "gone.pdf", 5, {}, "s")], files.schema)
    both = files.unionByName(gone)
    staged = {r["file_name"]: r for r in stage_with_isolation(both).collect()}
    assert staged["it's.pdf"]["content_hash"] == hashlib.md5(b"two!").hexdigest()
    assert staged["empty.pdf"]["content_hash"] == "d41d8cd98f00b204e9800998ecf8427e"
    assert staged["gone.pdf"]["content_hash"] is None and staged["gone.pdf"]["sync_error"]
    in_place = {r["file_name"]: r for r in stage_with_isolation(both, unreadable="empty_hash").collect()}
    assert in_place["gone.pdf"]["content_hash"] == "" and in_place["gone.pdf"]["sync_error"] is None

    chosen = both.withColumn("source_path", F.col("original_path"))
    with pytest.raises(Exception, match="gone"):
        load_raw(chosen, "r1").collect()
    raw = {r["file_name"]: r for r in load_raw(chosen, "r1", on_unreadable="skip").collect()}
    assert set(raw) == {"a.PDF", "it's.pdf", "empty.pdf", "_hidden.pdf", "p.pdf"}
    assert bytes(raw["it's.pdf"]["content"]) == b"two!" and raw["a.PDF"]["source_modified_at"] is not None


def test_compressed_files_are_read_as_they_are(spark, tmp_path):
    import gzip

    data = gzip.compress(b"text")
    (tmp_path / "a.gz").write_bytes(data)
    files = list_files(spark, [str(tmp_path)]).withColumn("source_name", F.lit("s"))
    row = load_raw(files.withColumn("source_path", F.col("original_path")), "r1").first()
    assert bytes(row["content"]) == data


def test_staging_names(spark):
    files = spark.createDataFrame(
        [("s", f"/{i}/{n}", n, h) for i, (n, h) in enumerate([("a.b.pdf", "0123456789"), ("a.b.pdf", "abcdefghij"), ("README", "x" * 32), ("README", "y" * 32), (".rc", "z" * 32), (".rc", "w" * 32), ("held.txt", "q" * 32)])]
        + [("t", "/9/a.b.pdf", "a.b.pdf", "k" * 32)],
        "source_name string, original_path string, file_name string, content_hash string",
    )
    staged = spark.createDataFrame(
        [("s", "/other/held.txt", "/st/s/held.txt", "held.txt"), ("s", "/1/a.b.pdf", "/st/s/kept.pdf", "kept.pdf")],
        "source_name string, original_path string, staging_path string, file_name string",
    )
    got = {r["original_path"]: r["staging_path"] for r in assign_staging_path(files, staged, "/st/").collect()}
    assert got == {
        "/0/a.b.pdf": "/st/s/a.b.pdf",
        "/1/a.b.pdf": "/st/s/kept.pdf",
        "/2/README": "/st/s/README",
        "/3/README": "/st/s/README_yyyyyyyy",
        "/4/.rc": "/st/s/.rc",
        "/5/.rc": "/st/s/.rc_wwwwwwww",
        "/6/held.txt": "/st/s/held_qqqqqqqq.txt",
        "/9/a.b.pdf": "/st/t/a.b.pdf",
    }


def test_tree_and_library_edges(spark):
    folder, pdf, doc = "application/vnd.google-apps.folder", "application/pdf", "application/vnd.google-apps.document"
    tree = spark.createDataFrame(
        [("d1", "root", "sub", folder, None), ("d2", "d1", "deep", folder, None), ("f1", "root", "a.pdf", pdf, 3),
         ("f2", "d2", "Plan", doc, None), ("f3", "d2", "Plan.docx", doc, None), ("f4", "elsewhere", "b.pdf", pdf, 1)],
        "id string, parent string, name string, mime string, size long",
    )
    assert rows(files_from_tree_manifest(tree, ["root"]).drop("metadata")) == [
        ("gdrive://f1", "a.pdf", 3), ("gdrive://f2", "Plan.docx", 0), ("gdrive://f3", "Plan.docx", 0)]
    assert rows(files_from_tree_manifest(tree, ["root"], recursive=False).select("original_path")) == [("gdrive://f1",)]
    assert files_from_tree_manifest(tree, []).count() == 0
    loop = tree.unionByName(spark.createDataFrame([("root", "d2", "back", folder, None)], tree.schema))
    with pytest.raises(ValueError, match="cycle"):
        files_from_tree_manifest(loop, ["root"]).count()
    library = spark.createDataFrame(
        [("", "a.pdf", "file", 1), ("x", "b.pdf", "file", None), ("xy", "c.pdf", "file", 3), ("x/y", "d%.pdf", "file", 4), ("", "x", "folder", None)],
        "parent_path string, name string, kind string, size long",
    )
    assert rows(files_from_library_manifest(library).select("original_path", "file_size_bytes")) == sorted(
        [("/a.pdf", 1), ("x/b.pdf", 0), ("xy/c.pdf", 3), ("x/y/d%.pdf", 4)], key=repr)
    assert rows(files_from_library_manifest(library, ["x"]).select("original_path")) == [("x/b.pdf",), ("x/y/d%.pdf",)]


def test_small_functions(spark):
    df = spark.createDataFrame([("dbfs:/a/dbfs:b", "Ünï_50%", "", None), ("/x", "plain", None, "y" * 400)], "p string, n string, c string, d string")
    assert [r[0] for r in df.select(strip_scheme(F.col("p"))).collect()] == ["/a/dbfs:b", "/x"]
    def found(q, **how):
        return [r["n"] for r in df.filter(matches_search(q, F.col("n"), **how)).collect()]
    assert found("  ") == ["Ünï_50%", "plain"] and found("ü") == ["Ünï_50%"]
    assert found("p_i") == [] and found("p_ai") == ["plain"] and found("_5", literal=True) == ["Ünï_50%"]
    assert found("it's") == [] and found("%", literal=True) == ["Ünï_50%"]
    shown = [r[0] for r in df.select(preview(F.col("c"), F.col("d"))).collect()]
    assert shown == ["No content", "y" * 200]
    with pytest.raises(ValueError):
        content_hash(F.lit(b""), "crc")


def test_parse_options(spark):
    def options(**given):
        return spark.range(1).select(parse_options(**given)).first()[0]
    assert options() == {"version": "2.0", "descriptionElementTypes": "*"}
    assert options(image_dir="/img/", run_id="r1")["imageOutputPath"] == "/img/r1/"


def test_deep_trees_are_listed_whole(spark):
    folder, pdf = "application/vnd.google-apps.folder", "application/pdf"
    chain = [(f"d{i}", f"d{i - 1}" if i else "root", "x", folder, None) for i in range(105)]
    tree = spark.createDataFrame([*chain, ("f", "d104", "a.pdf", pdf, 1)], "id string, parent string, name string, mime string, size long")
    assert rows(files_from_tree_manifest(tree, ["root"]).select("original_path")) == [("gdrive://f",)]


def test_an_entry_that_vanishes_leaves_the_others(tmp_path, monkeypatch):
    from doclake.sources import files

    for name in "abc":
        (tmp_path / name).write_text(name)
    real = files.os.scandir

    class Gone:
        path, name = str(tmp_path / "z"), "z"

        def is_dir(self, follow_symlinks=True):
            return False

        def is_file(self):
            return True

        def stat(self):
            raise FileNotFoundError(self.path)

    class Entries:
        def __init__(self, folder):
            self.found = [Gone(), *real(folder)]

        def __enter__(self):
            return self

        def __exit__(self, *error):
            return False

        def __iter__(self):
            return iter(self.found)

    monkeypatch.setattr(files.os, "scandir", Entries)
    assert sorted(x[1] for x in files._scan(str(tmp_path))) == ["a", "b", "c"]
    monkeypatch.undo()
    assert list(files._scan(str(tmp_path / "missing"))) == []


def test_copies_of_one_file_get_paths_of_their_own(spark):
    files = spark.createDataFrame(
        [("s", f"/{i}/r.txt", "r.txt", "8cdeb44417") for i in range(4)], "source_name string, original_path string, file_name string, content_hash string"
    )
    staged = spark.createDataFrame([], "source_name string, original_path string, staging_path string, file_name string")
    got = assign_staging_path(files, staged, "/st")
    paths = [r["staging_path"] for r in got.collect()]
    assert len(set(paths)) == 4 and "/st/s/r.txt" in paths and "/st/s/r_8cdeb444.txt" in paths
    assert got.columns == [*files.columns, "staging_path"]


def test_image_folders_keep_their_scheme():
    from pyspark.sql import functions as F  # noqa: F401

    text = str(parse_options(image_dir="s3://bucket/images/", run_id="r1"))
    assert "s3://bucket/images/r1/" in text
