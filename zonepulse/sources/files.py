"""Questions to the file system of a path, through the session's Hadoop configuration."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.delete(p, True)


def create(spark: SparkSession, path: str) -> bool:
    """Create an empty file, folders above it included; false if it was there."""
    fs, p = _fs(spark, path)
    return fs.createNewFile(p)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; none if it does not exist."""
    fs, p = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def data_files(spark: SparkSession, paths: list[str] | str) -> list[str]:
    """Files that ``paths`` (globs, folders or files) stand for, without hidden ones."""
    out = []
    for path in [paths] if isinstance(paths, str) else paths:
        fs, p = _fs(spark, path)
        found = fs.globStatus(p)
        if not found:
            raise FileNotFoundError(path)
        for status in found:
            for s in fs.listStatus(status.getPath()):
                name = s.getPath().getName()
                if s.isFile() and not name.startswith(("_", ".")):
                    out.append(s.getPath().toString())
    return sorted(out)


def first_line(spark: SparkSession, path: str) -> str | None:
    """First line of a text file, decompressed by its extension; nothing beyond it is read."""
    jvm = spark.sparkContext._jvm
    fs, p = _fs(spark, path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(
        spark.sparkContext._jsc.hadoopConfiguration()).getCodec(p)
    stream = fs.open(p)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(
        codec.createInputStream(stream) if codec is not None else stream, "UTF-8"))
    try:
        return reader.readLine()
    finally:
        reader.close()
