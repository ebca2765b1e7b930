"""Metadata-only file system calls through Hadoop's FileSystem API.

These touch names, never row data: listing, renames and deletes of whole
directories. They work the same on a local disk, HDFS or an object store.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return hpath.getFileSystem(conf), hpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def mkdirs(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def delete(spark: SparkSession, path: str, recursive: bool = True) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, recursive))


def rename(spark: SparkSession, src: str, dst: str) -> bool:
    fs, s = _fs(spark, src)
    _, d = _fs(spark, dst)
    return bool(fs.rename(s, d))


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Paths matching a Hadoop glob, sorted; [] when nothing matches."""
    fs, p = _fs(spark, pattern)
    found = fs.globStatus(p)
    if found is None:
        return []
    return sorted(str(st.getPath().toString()) for st in found)


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Visible files directly under ``path`` (names starting with . or _ are skipped)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isFile() and not name.startswith((".", "_")):
            out.append(str(st.getPath().toString()))
    return sorted(out)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Small marker file (a version stamp); overwrites."""
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
