"""Commit records of tables whose partitions are replaced: which folders count.

New rows are written into a folder of their own, `generation=N/…`, and a record written last names every folder
that counts from then on. A reader resolves the newest record first, so it sees a table before or after a
replacement and never in between; a run that stops before its record leaves nothing but unused files.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession

RECORDS = "_commits"
GENERATION = "generation"
# Records, and the folders they name, that stay for reads which have begun.
KEPT_RECORDS = 2


def hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def file_system(spark: SparkSession, path: str):
    return hadoop_path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Existing paths that fit a pattern, in order."""
    found = file_system(spark, pattern).globStatus(hadoop_path(spark, pattern)) or []
    return sorted(status.getPath().toString() for status in found)


def drop(spark: SparkSession, path: str) -> None:
    file_system(spark, path).delete(hadoop_path(spark, path), True)


def _records(spark: SparkSession, path: str) -> list[str]:
    return [r for r in matching(spark, f"{path}/{RECORDS}/*") if not r.endswith(".new")]


def _folders(spark: SparkSession, record: str) -> list[str]:
    stream = file_system(spark, record).open(hadoop_path(spark, record))
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return text.split("\n")[:-1]


def live_folders(spark: SparkSession, path: str) -> list[str] | None:
    """Folders below `path` that count by its newest record; None for a table that has no records."""
    records = _records(spark, path)
    return _folders(spark, records[-1]) if records else None


def next_generation(spark: SparkSession, path: str) -> int:
    """The number of the next record. Files that a stopped run left under it are deleted."""
    records = _records(spark, path)
    number = int(records[-1].rsplit("/", 1)[1]) + 1 if records else 0
    drop(spark, f"{path}/{GENERATION}={number}")
    return number


def commit(spark: SparkSession, path: str, number: int, folders: Iterable[str]) -> None:
    """Makes `folders` count, all at once, and deletes what no kept record names.

    Raises if another writer has committed that number meanwhile; nothing is replaced then.
    """
    files, record = file_system(spark, path), f"{path}/{RECORDS}/{number:012d}"
    stream = files.create(hadoop_path(spark, f"{record}.new"), True)
    stream.write(bytearray("".join(f"{folder}\n" for folder in sorted(folders)), "utf-8"))
    stream.close()
    if files.exists(hadoop_path(spark, record)) or not files.rename(hadoop_path(spark, f"{record}.new"), hadoop_path(spark, record)):
        raise RuntimeError(f"{path}: another run has committed record {number}")
    records = _records(spark, path)
    kept = {folder for r in records[-KEPT_RECORDS:] for folder in _folders(spark, r)}
    for old in records[:-KEPT_RECORDS]:
        for folder in set(_folders(spark, old)) - kept:
            drop(spark, f"{path}/{folder}")
        drop(spark, old)
