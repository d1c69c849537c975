"""Sinks: tables of Parquet files under one root folder."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from doclake.operators import commits
from doclake.operators.folders import children as _children, exists as _exists
from doclake.schemas import TABLES

_SNAPSHOT = "snapshot-"


def table_path(root: str, name: str) -> str:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}; tables: {', '.join(TABLES)}")
    return f"{root.rstrip('/')}/{name}"


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A run-partitioned table, with its declared columns; empty if nothing was written yet.

    Where runs were committed (see :mod:`doclake.operators.commits`), what their commits name.
    """
    schema, path = TABLES[name], table_path(root, name)
    if _exists(spark, f"{root.rstrip('/')}/{commits.COMMITS}"):
        return commits.read_table(spark, root, name)
    if not any("=" in child for child in _children(spark, path)):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def ensure_table(spark: SparkSession, name: str, database: str | None = None) -> str:
    """Create a catalog table with the declared schema if it is missing; returns its full name."""
    schema = TABLES[name]
    full = name
    if database is not None:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
        full = f"{database}.{name}"
    if not spark.catalog.tableExists(full):
        spark.createDataFrame([], schema).write.format("parquet").saveAsTable(full)
    return full


def append(df: DataFrame, root: str, name: str, by: Sequence[str] = ("pipeline_run_id",)) -> None:
    """Write the rows of a run, in declared column order, replacing the partitions they fall in.

    Writing the same run (or run and batch) again leaves the same rows, so a retry duplicates nothing.
    """
    columns = TABLES[name].names
    (
        df.select(*columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(table_path(root, name))
    )


def checked_run_id(run_id: str) -> str:
    """``run_id`` if it can name a folder as it is."""
    if not re.fullmatch(r"[\w.-]+", run_id):
        raise ValueError("a run id may hold letters, digits, dots, hyphens and underscores only")
    return run_id


def replace_run(df: DataFrame, root: str, name: str, run_id: str, by: Sequence[str]) -> None:
    """Write all rows of a run, replacing whatever an earlier attempt of the run left in the table."""
    columns = [c for c in TABLES[name].names if c != "pipeline_run_id"]
    (
        df.select(*columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(*by)
        .parquet(f"{table_path(root, name)}/pipeline_run_id={checked_run_id(run_id)}")
    )


def clear_run(spark: SparkSession, root: str, name: str, run_id: str, by: Sequence[str] = ()) -> None:
    """Leave no row of a run in a table, if an earlier attempt of the run wrote some."""
    if _exists(spark, f"{table_path(root, name)}/pipeline_run_id={checked_run_id(run_id)}"):
        replace_run(spark.createDataFrame([], TABLES[name]), root, name, run_id, by)


def _snapshots(spark: SparkSession, path: str) -> list[str]:
    """Complete snapshots, oldest first; one without its success marker was cut short and is ignored.

    Several snapshots of which none is marked are an error: the markers are switched off, and the table would seem empty.
    """
    names = sorted(n for n in _children(spark, path) if n.startswith(_SNAPSHOT))
    done = [n for n in names if _exists(spark, f"{path}/{n}/_SUCCESS")]
    if len(names) > 1 and not done:
        raise RuntimeError(f"no snapshot below {path} has its _SUCCESS marker; these sessions must write them")
    return done


def read_snapshot(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The current state of a table that is replaced as a whole; empty if there is none.

    The registry of committed runs is merged from its log.
    """
    path = table_path(root, name)
    if name == "document_registry" and _exists(spark, f"{root.rstrip('/')}/{commits.COMMITS}"):
        return commits.read_registry(spark, root)
    done = _snapshots(spark, path)
    if not done:
        return spark.createDataFrame([], TABLES[name])
    return spark.read.schema(TABLES[name]).parquet(f"{path}/{done[-1]}")


def replace_snapshot(df: DataFrame, root: str, name: str, by: Sequence[str] = (), unique: Sequence[str] = ()) -> None:
    """Replace a table by a query, which may read that table: the result goes to a new folder.

    The older snapshots stay until :func:`old_snapshots` are removed by whoever owns the storage.
    """
    spark, path = df.sparkSession, table_path(root, name)
    taken = [int(n.removeprefix(_SNAPSHOT)) for n in _children(spark, path) if n.startswith(_SNAPSHOT)]
    target = f"{path}/{_SNAPSHOT}{max(taken, default=0) + 1:010d}"
    rows = df.select(*TABLES[name].names)
    if by:
        write_clustered(rows, by, target, unique)
    else:
        rows.write.parquet(target)


def old_snapshots(spark: SparkSession, root: str, name: str) -> list[str]:
    """Folders of a replaced table that are no longer read."""
    path = table_path(root, name)
    return [f"{path}/{n}" for n in _snapshots(spark, path)[:-1]]


def write_clustered(df: DataFrame, by: Sequence[str], path: str, unique: Sequence[str] = ()) -> None:
    """Write with the rows of nearby ``by`` values together, so scans skip files by their statistics.

    A value that a large share of rows has is cut over several files by the ``unique`` columns, or
    by a hash of the row.
    """
    spread = [F.col(c) for c in unique] or [F.xxhash64(*df.columns)]
    (
        df.repartitionByRange(*[F.col(c) for c in by], *spread)
        .sortWithinPartitions(*by)
        .write.parquet(path)
    )
