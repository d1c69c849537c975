"""Folders of any file system Spark reaches, seen from the driver; few and small things only."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _opened(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, files = _opened(spark, path)
    return files.exists(hadoop_path)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what is directly in a folder; none if there is no such folder."""
    hadoop_path, files = _opened(spark, path)
    if not files.exists(hadoop_path):
        return []
    return [status.getPath().getName() for status in files.listStatus(hadoop_path)]


def stamps(spark: SparkSession, path: str) -> dict[str, tuple[int, int]]:
    """Modification time and size of what is directly in a folder, by name."""
    hadoop_path, files = _opened(spark, path)
    if not files.exists(hadoop_path):
        return {}
    found = files.listStatus(hadoop_path)
    return {s.getPath().getName(): (s.getModificationTime(), s.getLen()) for s in found}


def put_once(spark: SparkSession, folder: str, name: str, text: str) -> bool:
    """Write a small file so that it is there as a whole or not at all; False if one of that name is there already.

    The text goes to a file of another name first, and one rename that does not replace anything puts it in place.
    """
    target, files = _opened(spark, f"{folder}/{name}")
    files.mkdirs(target.getParent())
    written, _ = _opened(spark, f"{folder}/_writing-{uuid.uuid4().hex}")
    stream = files.create(written, False)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    jvm, settings = spark._jvm, spark._jsc.hadoopConfiguration()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), settings)
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(files.makeQualified(written), files.makeQualified(target), options)
    except Exception:
        if files.exists(target):
            files.delete(written, False)
            return False
        raise
    return True
