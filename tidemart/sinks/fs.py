"""Small file-system helpers through Hadoop's FileSystem API, so the same
calls work on local disk, HDFS or object stores the cluster is configured
for.  Only metadata and tiny manifest files go through here; data is always
read and written by Spark."""

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
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def list_files(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isFile())


def modified(spark: SparkSession, path: str) -> dict[str, int]:
    """Modification time of the files of a folder, in milliseconds."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return {}
    return {s.getPath().getName(): s.getModificationTime() for s in fs.listStatus(p) if s.isFile()}


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file atomically (temporary name, then a rename that
    fails if the file exists: of two writers one loses, and knows it)."""
    fs, p = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    tmp = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(tmp, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.makeQualified(p).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(fs.makeQualified(tmp), fs.makeQualified(p), options)
    except Exception as e:
        fs.delete(tmp, False)
        raise OSError(f"could not publish {path}: another writer was first") from e


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
    lines = []
    while True:
        line = reader.readLine()
        if line is None:
            break
        lines.append(line)
    reader.close()
    return "\n".join(lines)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)
