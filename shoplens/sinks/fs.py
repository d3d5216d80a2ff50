"""Small filesystem helpers over Hadoop's FileSystem (works for local, HDFS,
S3 ... whatever the cluster's paths are), reached through the session.

PySpark has no file-system API of its own, so these go through the JVM
gateway to Hadoop's public ``FileSystem`` class with the session's Hadoop
configuration; metadata calls (list, exists, rename, delete, mkdirs) and the
small text files of a commit log, never data reads."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-directories of ``path`` (empty if it is missing)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True))


def touch(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.create(p, True).close()


def mkdirs(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def rename(spark: SparkSession, src: str, dst: str) -> None:
    """Move ``src`` to ``dst``; raises if the file system refuses."""
    fs, p = _fs(spark, src)
    to = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(dst)
    if not fs.rename(p, to) or not fs.exists(to):
        raise OSError(f"could not move {src} to {dst}")


def list_entries(spark: SparkSession, path: str) -> list[tuple[str, bool, float]]:
    """(name, is a directory, seconds of last change) of what is in ``path``."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [
        (s.getPath().getName(), bool(s.isDirectory()), s.getModificationTime() / 1000) for s in fs.listStatus(p)
    ]


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files below a folder."""
    fs, p = _fs(spark, path)
    return int(fs.getContentSummary(p).getLength())


def read_text(spark: SparkSession, path: str) -> str:
    """A small file (a log entry), whole."""
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears whole or not at all; raises FileExistsError
    where ``path`` is taken."""
    fs, p = _fs(spark, path)
    if fs.exists(p):
        raise FileExistsError(path)
    folder, name = path.rsplit("/", 1)
    draft = f"{folder}/.{name}.{uuid.uuid4().hex}"
    out = fs.create(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(draft), True)
    try:
        out.write(text.encode())
    finally:
        out.close()
    try:
        rename(spark, draft, path)
    except Exception:
        delete(spark, draft)
        if fs.exists(p):
            raise FileExistsError(path) from None
        raise
