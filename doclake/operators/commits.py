"""What every run has written, switched from one state to the next by single renames.

A run writes its rows to folders of new names. They count from the moment a commit names them: a small file, numbered in
order, that lists the folders of all tables of its run. The last commit of each run holds; whatever no commit names is not
read, so a run that is killed, repeated, or repeated with less leaves exactly one state. Commits name folders, not files, and
there are a few per run, so the driver holds little.

Beside each folder of a clustered table goes a row of statistics per file: the least and greatest source, file name and
page. A look-up by file name reads these first and opens only the files that can hold it.

Rows of a document that a later run parsed again stay where they are. The later run names them in its table of superseded
(path, run) pairs, and readers leave them out by an anti join; runs of which nothing is superseded are read without any join.

The registry is a log: each run appends a row for every file it saw, whole for new and changed files, only key and stamps for the
others. Readers merge the log by one aggregate, and it is compacted once it outgrows a share of its last compaction.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import asdict, dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from doclake.operators import folders
from doclake.operators.flatten import superseded_pairs, without_superseded
from doclake.operators.registry import merge_deltas
from doclake.schemas import DOCUMENT_SUMMARIES, PARSED_DOCUMENTS, RAW_DOCUMENTS, REGISTRY_DELTA, RUN_STATES, TABLES

COMMITS, STATISTICS, SUPERSEDED, COMPACTION = "_commits", "_statistics", "superseded", "_compaction"
SUMMARIES, STATES = "document_summaries", "run_states"
#: Tables with statistics of their files, and the column that numbers their pages.
CLUSTERED = {
    "document_elements": "page_id", "document_pages": "page_number", "parsed_documents": None, "processing_log": None, SUMMARIES: None
}
#: Tables of which only the run that wrote last counts.
LAST_RUN_ONLY = ("raw_documents",)
#: How many failed batches are named in a commit; the rows of more are taken out by a join and written again.
MOST_LEFT_OUT = 1000
#: How many files a look-up names; one that more files can hold is a scan with a filter.
MOST_FILES = 10_000

_STORED = {
    **TABLES,
    "document_registry": REGISTRY_DELTA,
    "raw_documents": T.StructType([*RAW_DOCUMENTS.fields, T.StructField("read_error", T.StringType())]),
    "parsed_documents": T.StructType([*PARSED_DOCUMENTS.fields, T.StructField("parse_error", T.StringType())]),
    SUMMARIES: DOCUMENT_SUMMARIES,
    STATES: RUN_STATES,
    SUPERSEDED: T.StructType([TABLES["parsed_documents"]["source_path"], TABLES["parsed_documents"]["pipeline_run_id"]]),
}
_FILE_STATISTICS = (
    "folder string, file string, rows long, source_name_min string, source_name_max string, "
    "file_name_min string, file_name_max string, page_min int, page_max int"
)


@dataclass(frozen=True)
class Part:
    """A folder of one table, written by one step of a run."""

    name: str
    step: str
    folder: str
    seq: int | None = None  # the first commit that named it
    left_out: tuple[int, ...] = ()  # batches whose rows do not count
    runs: tuple[str, ...] = ()  # of superseded pairs: the runs they name
    covers: tuple[str, ...] = ()  # of a compaction: the folders merged into it
    rows: int | None = None  # of the registry
    statistics: str | None = None


@dataclass(frozen=True)
class Commit:
    seq: int
    run_id: str
    parts: tuple[Part, ...]


_COMMIT = (
    "run_id string, parts array<struct<name:string,step:string,folder:string,seq:int,left_out:array<int>,runs:array<string>,"
    "covers:array<string>,rows:long,statistics:string>>"
)


_known: dict[tuple, Commit] = {}


def history(spark: SparkSession, root: str) -> list[Commit]:
    """All commits in order. A commit never changes, so each is read once by a process."""
    path = f"{root.rstrip('/')}/{COMMITS}"
    files = {n: (path, n, *stamp) for n, stamp in folders.stamps(spark, path).items() if n.endswith(".json")}
    new = sorted(n for n, key in files.items() if key not in _known)
    if new:
        rows = spark.read.schema(_COMMIT).json([f"{path}/{n}" for n in new])
        for row in rows.select(F.col("_metadata.file_name").alias("file"), "run_id", "parts").collect():
            seq, parts = int(row["file"].split(".")[0]), [p.asDict() for p in row["parts"]]
            for p in parts:
                p["seq"] = seq if p["seq"] is None else p["seq"]
                p.update({k: tuple(p[k] or ()) for k in ("left_out", "runs", "covers")})
            _known[files[row["file"]]] = Commit(seq, row["run_id"], tuple(Part(**p) for p in parts))
    return sorted((_known[key] for key in files.values()), key=lambda c: c.seq)


def current(spark: SparkSession, root: str) -> dict[str, Commit]:
    """The last commit of each run."""
    return {c.run_id: c for c in history(spark, root)}


def unreferenced(spark: SparkSession, root: str) -> list[str]:
    """Folders of rows that no current commit names, for whoever owns the storage to remove; none may be under way."""
    root = root.rstrip("/")
    named = {p.folder for c in current(spark, root).values() for p in c.parts}
    named -= {folder for p in _parts(spark, root, "document_registry") for folder in p.covers}
    found = []
    for name in _STORED:
        for run in folders.children(spark, f"{root}/{name}"):
            found += [f"{name}/{run}/{part}" for part in folders.children(spark, f"{root}/{name}/{run}")]
    return [f"{root}/{folder}" for folder in found if folder not in named]


class Run:
    """The rows of one run, those committed and those still to be committed."""

    def __init__(self, spark: SparkSession, root: str, run_id: str):
        self.spark, self.root, self.run_id = spark, root.rstrip("/"), run_id
        committed = current(spark, root).get(run_id)
        self.parts: list[Part] = list(committed.parts) if committed else []

    def write(self, df: DataFrame, name: str, step: str = "rows", **more) -> Part:
        """Write rows of a table to a new folder; it takes the place of the step's earlier one."""
        part = Part(name, step, f"{name}/{self.run_id}/{step}-{uuid.uuid4().hex}", **more)
        df.select(*_STORED[name].names).write.parquet(f"{self.root}/{part.folder}")
        self.put(part)
        return part

    def put(self, part: Part) -> None:
        self.parts = [p for p in self.parts if (p.name, p.step) != (part.name, part.step)] + [part]

    def clear(self, *kept: str) -> None:
        """Forget all tables but ``kept``."""
        self.parts = [p for p in self.parts if p.name in kept]

    def read(self, name: str, session: SparkSession | None = None) -> DataFrame:
        """This run's rows, committed or not."""
        return _rows(session or self.spark, self.root, name, [p for p in self.parts if p.name == name])

    def stored(self, part: Part, session: SparkSession | None = None) -> DataFrame:
        """All rows of a part with all columns that are stored, those that do not count included."""
        return (session or self.spark).read.schema(_STORED[part.name]).parquet(f"{self.root}/{part.folder}")

    def leave_out(self, part: Part, failed: DataFrame) -> None:
        """Rows of the batches in ``failed (batch_id)`` do not count."""
        few = [r[0] for r in failed.limit(MOST_LEFT_OUT + 1).collect()]
        if len(few) <= MOST_LEFT_OUT:
            self.put(replace(part, left_out=tuple(sorted(few))))
        else:
            self.write(self.stored(part).join(failed, "batch_id", "left_anti"), part.name, part.step)

    def supersede(self, earlier: DataFrame, documents: DataFrame) -> None:
        """Rows of ``documents`` in the runs that ``earlier (source_path, pipeline_run_id)`` names are no longer current."""
        part = self.write(superseded_pairs(earlier, documents), SUPERSEDED)
        pairs = _rows(self.spark, self.root, SUPERSEDED, [part])
        runs = tuple(sorted(r[0] for r in pairs.select("pipeline_run_id").distinct().collect()))
        if runs:
            self.put(replace(part, runs=runs))
        else:
            self.parts = [p for p in self.parts if p.name != SUPERSEDED]

    def commit(self) -> int:
        """From here on, readers see the run's tables as they are; returns the number of the commit."""
        self._measure([p for p in self.parts if p.seq is None and p.statistics is None and p.name in CLUSTERED])
        while True:
            done = history(self.spark, self.root)
            seq = max((c.seq for c in done), default=0) + 1
            parts = [replace(p, seq=seq) if p.seq is None else p for p in self.parts]
            text = json.dumps({"run_id": self.run_id, "parts": [asdict(p) for p in parts]})
            if folders.put_once(self.spark, f"{self.root}/{COMMITS}", f"{seq:010d}.json", text):
                self.parts = parts
                return seq

    def _measure(self, parts: Sequence[Part]) -> None:
        """Least and greatest keys of every file of the parts, one narrow scan of the key columns each."""
        if not parts:
            return
        folder = f"{STATISTICS}/{self.run_id}/{uuid.uuid4().hex}"
        rows = reduce(DataFrame.unionByName, [self._file_statistics(p) for p in parts])
        rows.coalesce(1).write.parquet(f"{self.root}/{folder}")  # a row per file
        for part in parts:
            self.put(replace(part, statistics=folder))

    def _file_statistics(self, part: Part) -> DataFrame:
        rows = self.spark.read.schema(_STORED[part.name]).parquet(f"{self.root}/{part.folder}")
        page = F.col(CLUSTERED[part.name]) if CLUSTERED[part.name] else F.lit(None).cast("int")
        keyed = rows.select(F.col("_metadata.file_name").alias("file"), "source_name", "file_name", page.alias("page"))
        bounds = [f(c).alias(f"{c}_{n}") for c in ("source_name", "file_name", "page") for n, f in (("min", F.min), ("max", F.max))]
        return keyed.groupBy("file").agg(F.count(F.lit(1)).alias("rows"), *bounds).select(F.lit(part.folder).alias("folder"), "*")


def _parts(spark: SparkSession, root: str, name: str, without_run: str | None = None) -> list[Part]:
    """Committed parts of a table, in the order of their commits."""
    commits = current(spark, root)
    parts = [p for c in commits.values() if c.run_id != without_run for p in c.parts if p.name == name]
    if name in LAST_RUN_ONLY:
        last = max((p.seq for p in parts), default=None)
        parts = [p for p in parts if p.seq == last]
    return sorted(parts, key=lambda p: (p.seq, p.folder))


def _rows(spark: SparkSession, root: str, name: str, parts: Iterable[Part], files: Sequence[str] | None = None) -> DataFrame:
    """Rows of the parts, of the named files alone if any are named, in the table's stored columns."""
    schema, parts = _STORED[name], list(parts)

    def read(some: list[Part]) -> DataFrame:
        paths = [f"{root}/{p.folder}" for p in some]
        if files is not None:
            paths = [f for f in files if any(f.startswith(f"{path}/") for path in paths)]
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)

    whole = [p for p in parts if not p.left_out]
    found = [read(whole)] if whole else []
    found += [read([p]).filter(~F.col("batch_id").isin(*p.left_out)) for p in parts if p.left_out]
    rows = reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], schema)
    if name == "raw_documents":
        rows = rows.filter(F.col("read_error").isNull())
    return rows.select(*TABLES[name].names) if name in TABLES and name != "document_registry" else rows


def files_holding(
    spark: SparkSession, root: str, name: str, parts: Sequence[Part], file_names: Sequence[str], page: int | None = None
) -> list[str] | None:
    """Files of a clustered table that can hold rows of the names (and page), by their statistics; None if too many."""
    root = root.rstrip("/")
    measured = sorted({p.statistics for p in parts if p.statistics})
    if not measured:
        return []
    rows = spark.read.schema(_FILE_STATISTICS).parquet(*[f"{root}/{folder}" for folder in measured])
    within = [(F.col("file_name_min") <= n) & (F.col("file_name_max") >= n) for n in sorted(set(file_names))]
    hit = reduce(lambda a, b: a | b, within, F.lit(False))
    if page is not None and CLUSTERED[name]:
        hit = hit & (F.col("page_min") <= page) & (F.col("page_max") >= page)
    found = rows.filter(hit).select("folder", "file").limit(MOST_FILES + 1).collect()
    if len(found) > MOST_FILES:
        return None
    live = {p.folder for p in parts}
    return sorted(f"{root}/{r['folder']}/{r['file']}" for r in found if r["folder"] in live)


def _chosen(
    spark: SparkSession, root: str, name: str, parts: Sequence[Part], file_names: Sequence[str] | None, page: int | None
) -> DataFrame:
    if file_names is None:
        return _rows(spark, root, name, parts)
    files = files_holding(spark, root, name, parts, file_names, page)
    rows = _rows(spark, root, name, parts, files).filter(F.col("file_name").isin(*sorted(set(file_names))))
    column = CLUSTERED[name]
    return rows if page is None or column is None else rows.filter(F.col(column) == page)


def read_table(
    spark: SparkSession,
    root: str,
    name: str,
    file_names: Sequence[str] | None = None,
    page: int | None = None,
    without_run: str | None = None,
) -> DataFrame:
    """A table as committed, all runs together; of a clustered table perhaps only the rows of some file names and a page."""
    if file_names is not None and name not in CLUSTERED:
        raise ValueError(f"{name} keeps no statistics; tables that do: {', '.join(CLUSTERED)}")
    return _chosen(spark, root.rstrip("/"), name, _parts(spark, root, name, without_run), file_names, page)


def read_current(
    spark: SparkSession, root: str, name: str, file_names: Sequence[str] | None = None, page: int | None = None
) -> DataFrame:
    """Rows of each document's latest parse: what no later commit supersedes.

    Folders older than all superseded pairs that name their run are read as they are; the others are anti-joined with
    those pairs.
    """
    root = root.rstrip("/")
    parts = _parts(spark, root, name)
    pairs = _parts(spark, root, SUPERSEDED)
    against = {p: [s for s in pairs if _run_of(p) in s.runs and s.seq > p.seq] for p in parts}
    groups: dict[tuple[Part, ...], list[Part]] = {}
    for part, some in against.items():
        groups.setdefault(tuple(some), []).append(part)
    found = []
    for some, members in groups.items():
        rows = _chosen(spark, root, name, members, file_names, page)
        found.append(without_superseded(rows, _rows(spark, root, SUPERSEDED, some)) if some else rows)
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], _STORED[name])


def runs_with_states(spark: SparkSession, root: str) -> tuple[set[str], set[str]]:
    """Runs whose states are stored, and those of them of which a later commit supersedes rows."""
    states = {_run_of(p): p.seq for p in _parts(spark, root, STATES)}
    pairs = _parts(spark, root, SUPERSEDED)
    return set(states), {run for run, seq in states.items() if any(run in s.runs and s.seq > seq for s in pairs)}


def _run_of(part: Part) -> str:
    return part.folder.split("/")[1]


def unreadable(run: Run) -> DataFrame:
    """The run's documents that could not be read when they were loaded, with ``read_error``."""
    found = [run.stored(p) for p in run.parts if p.name == "raw_documents"]
    rows = reduce(DataFrame.unionByName, found) if found else run.spark.createDataFrame([], _STORED["raw_documents"])
    return rows.filter(F.col("read_error").isNotNull())


def _deltas(spark: SparkSession, root: str, without_run: str | None = None) -> list[Part]:
    """The last compaction, and the parts of the registry log after it, in order."""
    parts = _parts(spark, root, "document_registry", without_run)
    covered = {folder for p in parts for folder in p.covers}
    return sorted((p for p in parts if p.folder not in covered), key=lambda p: not p.covers)


def read_registry(spark: SparkSession, root: str, without_run: str | None = None) -> DataFrame:
    """The registry as it stands: its log merged by document."""
    root = root.rstrip("/")
    parts = _deltas(spark, root, without_run)
    if not parts:
        return spark.createDataFrame([], TABLES["document_registry"])
    order = F.create_map(*[F.lit(x) for i, p in enumerate(parts) for x in (p.folder.rsplit("/", 1)[1], i)])
    rows = spark.read.schema(REGISTRY_DELTA).parquet(*[f"{root}/{p.folder}" for p in parts])
    folder = F.element_at(F.split("_metadata.file_path", "/"), -2)
    return merge_deltas(rows.withColumn("order", F.element_at(order, folder)))


def compact_registry(spark: SparkSession, root: str, share: float = 0.5) -> bool:
    """Merge the registry log into one folder if its later parts have outgrown ``share`` of the first; True if it was done.

    The merged folder takes effect by a commit of its own. Cut short before that, the log stays as it was.
    """
    parts = _deltas(spark, root)
    if len(parts) < 2 or sum(p.rows or 0 for p in parts[1:]) <= share * (parts[0].rows or 0):
        return False
    run = Run(spark, root, COMPACTION)
    merged = read_registry(spark, root).withColumn("seen_only", F.lit(False))
    part = run.write(merged, "document_registry", covers=tuple(p.folder for p in parts))
    # What the compaction before it covered stays covered.
    before = tuple(folder for p in _parts(spark, root, "document_registry") for folder in p.covers)
    rows = spark.read.schema(REGISTRY_DELTA).parquet(f"{run.root}/{part.folder}").count()
    run.put(replace(part, covers=tuple(dict.fromkeys((*before, *part.covers))), rows=rows))
    run.commit()
    return True
