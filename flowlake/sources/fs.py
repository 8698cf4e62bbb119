"""Hadoop FileSystem helpers (any scheme Spark can read: file, hdfs, s3a, ...).

Only metadata goes through the driver here: listings, small records,
directory deletes.  Data is always read by Spark tasks.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _jvm(spark: SparkSession):
    return spark.sparkContext._jvm


def _fs(spark: SparkSession, path: str):
    jvm = _jvm(spark)
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def glob_files(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """(qualified path, size) of the files matching a glob, sorted by path."""
    fs, p = _fs(spark, pattern)
    statuses = fs.globStatus(p) or []
    out = []
    for st in statuses:
        if st.isFile():
            out.append((st.getPath().toString(), int(st.getLen())))
        else:
            it = fs.listFiles(st.getPath(), True)
            while it.hasNext():
                f = it.next()
                name = f.getPath().getName()
                if not name.startswith(("_", ".")):
                    out.append((f.getPath().toString(), int(f.getLen())))
    return sorted(out)


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().toString() for st in fs.listStatus(p) if st.isDirectory())


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True))


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """Create a small file, whole or not at all; fails if it already exists.

    The text goes to a hidden name first and is then renamed, so a crash leaves no
    half-written file under ``path``.  Two writers racing for one name are told apart
    where renames are atomic (HDFS, local disks); on object stores a table
    must have one writer."""
    fs, p = _fs(spark, path)
    if fs.exists(p):
        raise FileExistsError(f"{path} exists")
    folder, _, name = path.rpartition("/")
    staged = _jvm(spark).org.apache.hadoop.fs.Path(f"{folder}/.{name}.{uuid.uuid4().hex}.tmp")
    out = fs.create(staged, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if fs.exists(p) or not fs.rename(staged, p):
        fs.delete(staged, False)
        raise FileExistsError(f"{path} exists")


def read_text(spark: SparkSession, path: str) -> str:
    """Whole content of a small file (commit records, markers)."""
    jvm = _jvm(spark)
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        lines = []
        line = reader.readLine()
        while line is not None:
            lines.append(line)
            line = reader.readLine()
        return "\n".join(lines)
    finally:
        stream.close()


def list_names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(p))


def list_dirs_with_mtime(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(name, modification time in ms) of the sub-folders of ``path``."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted((st.getPath().getName(), int(st.getModificationTime()))
                  for st in fs.listStatus(p) if st.isDirectory())
