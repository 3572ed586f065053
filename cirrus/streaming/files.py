"""Folder operations on the table store through Spark's own file system access."""

from __future__ import annotations

import time

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, without hidden ones; none if there is no folder."""
    fs, p = _fs(spark, path)
    found = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(n for n in found if not n.startswith((".", "_")))


def make(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)
    return path


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder in one step, to a name that is free."""
    fs, p = _fs(spark, source)
    to = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(to.getParent())
    if fs.exists(to) or not fs.rename(p, to):
        raise OSError(f"cannot rename {source} to {target}")


def read_text(spark: SparkSession, path: str) -> str:
    """A small file, read without a job."""
    fs, p = _fs(spark, path)
    source = fs.open(p)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small new file, visible under its name once it is whole."""
    fs, p = _fs(spark, path)
    fs.mkdirs(p.getParent())
    hidden = spark._jvm.org.apache.hadoop.fs.Path(p.getParent(), f"_{p.getName()}")
    out = fs.create(hidden, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.rename(hidden, p)


def current(spark: SparkSession, path: str) -> str:
    """The newest finished version ``<path>/v=<n>`` of a table; the folder itself if it holds no versions."""
    versions = numbered(spark, path, "v")
    return f"{path}/v={versions[-1]}" if versions else path


def numbered(spark: SparkSession, path: str, prefix: str, known: set[int] | None = None) -> list[int]:
    """Numbers of the finished sub-folders ``<prefix>=<n>``, ascending: those whose job has left its success marker, which
    it writes after its last file. One listing, and a look into each folder that is not in ``known``, which takes in the
    finished ones (they never change)."""
    fs, p = _fs(spark, path)
    marker = spark._jvm.org.apache.hadoop.fs.Path
    if not fs.exists(p):
        return []
    known = set() if known is None else known
    found = [int(n.split("=", 1)[1]) for n in (s.getPath().getName() for s in fs.listStatus(p)) if n.startswith(prefix + "=")]
    known.intersection_update(found)
    known.update(i for i in found if i not in known and fs.exists(marker(p, f"{prefix}={i}/_SUCCESS")))
    return sorted(known)


def delete_older(spark: SparkSession, path: str, seconds: float) -> bool:
    """Delete a folder last changed at least ``seconds`` ago; False if it is younger or gone."""
    fs, p = _fs(spark, path)
    if not fs.exists(p) or time.time() - fs.getFileStatus(p).getModificationTime() / 1000 < seconds:
        return False
    return fs.delete(p, True)
