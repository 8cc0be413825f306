"""Small files and folders of the shared store, through Spark's own file systems."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder (none if it does not exist)."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def files(spark: SparkSession, path: str) -> list[tuple[str, int, int]] | None:
    """(path, bytes, modification time) of each file under a path, sorted; None if there is none."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    found, it = [], fs.listFiles(p, True)
    while it.hasNext():
        s = it.next()
        found.append((s.getPath().toString(), s.getLen(), s.getModificationTime()))
    return sorted(found)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, temporary: str, final: str, text: str) -> None:
    """Write a new file whole or not at all: under another name first, then renamed.  ``final`` must not exist."""
    fs, tmp = _fs(spark, temporary)
    stream = fs.create(tmp, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    _, to = _fs(spark, final)
    if fs.exists(to) or not fs.rename(tmp, to):
        fs.delete(tmp, False)
        raise FileExistsError(final)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)
