"""Shared working folder and small file-system helpers (any Hadoop FS)."""

from __future__ import annotations

import tempfile
import uuid
from typing import NamedTuple

from pyspark.sql import SparkSession


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder that all executors can reach.

    It lies below ``spark.checkpoint.dir``. Only a local session without that
    setting gets a temporary folder; a cluster without it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = tempfile.mkdtemp(prefix="lanepulse-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


class Version(NamedTuple):
    """A version folder: its number, and the run and batch that wrote it."""

    number: int
    run: str
    batch: int | None

    @property
    def folder(self) -> str:
        return f"v={self.number}" if self.batch is None else f"v={self.number}.{self.run}.{self.batch}"


def version_list(spark: SparkSession, path: str) -> list[Version]:
    """Finished versions below ``path``, oldest first."""
    p, fs = _path(spark, path)
    if not fs.exists(p):
        return []
    found = []
    for status in fs.listStatus(p):
        name = status.getPath().getName()
        if name.startswith("v=") and exists(spark, f"{path}/{name}/_SUCCESS"):
            number, _, writer = name[2:].partition(".")
            run, _, batch = writer.rpartition(".")
            found.append(Version(int(number), run, int(batch) if batch else None))
    return sorted(found, key=lambda v: v.number)


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the finished versions below ``path``, oldest first."""
    return [v.number for v in version_list(spark, path)]


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Renames a folder, so that ``to`` appears at once; what an earlier attempt left there goes."""
    source, fs = _path(spark, path)
    target, _ = _path(spark, to)
    fs.mkdirs(target.getParent())
    fs.delete(target, True)
    if not fs.rename(source, target):
        raise OSError(f"cannot rename {path} to {to}")


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; none if there is no file."""
    p, fs = _path(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return str(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Makes a small file; fails if it is there."""
    p, fs = _path(spark, path)
    stream = fs.create(p, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
