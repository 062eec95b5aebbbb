"""Single small files through the file system that a path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return fs.getFileStatus(where).isDirectory()


def read(spark: SparkSession, path: str) -> bytes:
    """A whole file; for manifests and the like."""
    return tail(spark, path, None)


def tail(spark: SparkSession, path: str, most: int | None) -> bytes:
    """The last bytes of a file."""
    fs, where = _at(spark, path)
    size = fs.getFileStatus(where).getLen()
    stream = fs.open(where)
    try:
        stream.seek(max(0, size - most) if most is not None else 0)
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def replace(spark: SparkSession, path: str, content: bytes) -> None:
    """Writes beside the file, then renames, so that a reader sees the old file or the new one."""
    fs, where = _at(spark, path)
    _, beside = _at(spark, f"{path}.part")
    stream = fs.create(beside, True)
    try:
        stream.write(bytearray(content))
    finally:
        stream.close()
    if fs.exists(where):
        fs.delete(where, False)
    if not fs.rename(beside, where):
        raise OSError(f"{path} can't be replaced")
