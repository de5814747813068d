"""Small files on the cluster's file systems, by Hadoop's own API: what Spark's
readers and writers have no call for (replacing one small file, listing and
removing folders)."""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def read_text(spark: SparkSession, path: str) -> str:
    stream = _fs(spark, path).open(_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Put ``text`` at ``path`` in one step: readers see the old file or the
    new one.  It is written beside and renamed over."""
    fs, beside = _fs(spark, path), f"{path}.{uuid.uuid4().hex}.new"
    out = fs.create(_path(spark, beside), True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    jvm, target = spark._jvm, fs.makeQualified(_path(spark, path))
    over = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
    over[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(_path(spark, beside)), target, over)


@dataclass(frozen=True)
class Entry:
    name: str
    path: str
    changed: float  # seconds since 1970
    is_folder: bool
    size: int


def listed(spark: SparkSession, folder: str) -> list[Entry]:
    """What lies in a folder, by name; nothing if there is none."""
    if not exists(spark, folder):
        return []
    found = [Entry(s.getPath().getName(), s.getPath().toString(), s.getModificationTime() / 1000, s.isDirectory(), s.getLen())
             for s in _fs(spark, folder).listStatus(_path(spark, folder))]
    return sorted(found, key=lambda e: e.name)


def size(spark: SparkSession, folder: str) -> int:
    """Bytes of the files below a folder."""
    return _fs(spark, folder).getContentSummary(_path(spark, folder)).getLength()


def fingerprint(spark: SparkSession, folders: list[str]) -> str:
    """A digest of the files below the folders: path, size and time of change."""
    seen = hashlib.sha256()
    for folder in folders:
        found, lines = _fs(spark, folder).listFiles(_path(spark, folder), True), []
        while found.hasNext():
            s = found.next()
            lines.append(f"{s.getPath()} {s.getLen()} {s.getModificationTime()}")
        seen.update("\n".join(sorted(lines)).encode() + b"\n\n")
    return seen.hexdigest()


def remove(spark: SparkSession, folder: str) -> None:
    _fs(spark, folder).delete(_path(spark, folder), True)
