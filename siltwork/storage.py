"""Files of any store that the session's Hadoop configuration knows: local, HDFS or an object store, by path or URI."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str) -> tuple[object, object]:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that a pattern matches, sorted; none if its folder isn't there."""
    fs, p = _at(spark, pattern)
    return sorted(x.getPath().toString() for x in fs.globStatus(p) or [])


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)


def folder(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.mkdirs(p)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename; the target must not exist."""
    fs, p = _at(spark, source)
    if not fs.rename(p, _at(spark, target)[1]):
        raise OSError(f"cannot rename {source} to {target}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """The whole file at once: written beside, then put in place, so that no reader sees a part of it."""
    fs, p = _at(spark, path + ".part")
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    remove(spark, path)
    move(spark, path + ".part", path)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _at(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
    finally:
        stream.close()
