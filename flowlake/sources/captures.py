"""The captures table: one row per input file, with what the file's path and first line tell.

Listing is metadata.  First lines are read by Spark tasks: files up to HEADER_BYTES
are scanned as text (only rows of a file's first split count), of longer files a task reads the first
line and no more.  Nothing is opened on the driver, which gets one row per file.
"""

from __future__ import annotations

import re
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake.functions.cleaning import capture_name, date_from_name
from flowlake.sources import fs

#: A first line longer than this is no header: an error, never a cut.
HEADER_BYTES = 1 << 20
CAPTURE_SCHEMA = "file_path string, file_size long, header string"


class NoHeader(ValueError):
    """A file whose first line doesn't end within HEADER_BYTES."""


def source_path(c: Column | None = None) -> Column:
    """Decoded source URI of each row (``+`` kept, ``%xx`` decoded; most paths hold neither)."""
    raw = F.col("_metadata.file_path") if c is None else c
    return F.when(raw.contains("%"), F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))).otherwise(raw)


def _uri(path: Column) -> Column:
    """Paths as the file system lists them, spelled alike: ``file:/x`` and ``file:///x``."""
    return F.regexp_replace(path, r"^([a-z0-9]+):/+(?=[^/])", "$1:/")


def first_lines(spark: SparkSession, files: list[tuple[str, int]],
                header_bytes: int = HEADER_BYTES) -> dict[str, str]:
    """Path -> first line, of files that aren't empty."""
    small = [p for p, n in files if 0 < n <= header_bytes]
    large = [p for p, n in files if n > header_bytes]
    found: dict[str, str] = {}
    if small:
        rows = (spark.read.text(small).where("_metadata.file_block_start = 0")
                .select("value", F.col("_metadata.file_path").alias("raw"), F.monotonically_increasing_id().alias("at"))
                .groupBy("raw").agg(F.min_by("value", "at").alias("line"))
                .select(_uri(source_path(F.col("raw"))).alias("path"), "line").collect())
        lines = {r["path"]: r["line"] for r in rows}
        for p in small:
            line = lines.get(_plain(p))
            if line is not None:
                found[p] = line
    if large:
        found.update(zip(large, _lead_lines(spark, large, header_bytes)))
    return found


def _plain(path: str) -> str:
    scheme, colon, rest = path.partition(":/")
    return f"{scheme}:/{rest.lstrip('/')}" if colon else path


def _lead_lines(spark: SparkSession, paths: list[str], header_bytes: int) -> list[str]:
    """The first line of each file: one split and one task a file, which stops after one line.
    (The reader knows compressed files, and skips lines that are too long: seen by their offset.)"""
    literal = [re.sub(r"([\[\]{}*?\\])", r"\\\1", p) for p in paths]      # names, not globs
    listed = ",".join(p.replace("\\", "\\\\").replace(",", "\\,") for p in literal)
    lines = spark.sparkContext.newAPIHadoopRDD(
        "org.apache.hadoop.mapreduce.lib.input.TextInputFormat", "org.apache.hadoop.io.LongWritable",
        "org.apache.hadoop.io.Text",
        conf={"mapreduce.input.fileinputformat.inputdir": listed,
              "mapreduce.input.fileinputformat.split.minsize": str(1 << 62),
              "mapreduce.input.linerecordreader.line.maxlength": str(header_bytes)})
    found = dict(lines.mapPartitionsWithIndex(lambda i, rows: [(i, r) for r in islice(rows, 1)]).collect())
    if lines.getNumPartitions() != len(paths):
        raise RuntimeError("header read: a file wasn't listed as one split")
    for i, path in enumerate(paths):
        if i not in found or found[i][0] != 0:
            raise NoHeader(f"{path}: no line break in the first {header_bytes} bytes")
    return [found[i][1] for i in range(len(paths))]


def captures(spark: SparkSession, pattern: str, header: str | None = None,
             header_bytes: int = HEADER_BYTES) -> DataFrame:
    """One row per file of a glob: ``file_path`` (as listed), ``source_file`` (decoded, as rows carry
    it), ``capture`` (name), ``capture_date`` (by its weekday, else null), ``file_size``, ``header``
    (null for an empty file).  With ``header`` given no file is read."""
    files = fs.glob_files(spark, pattern)
    if not files:
        raise FileNotFoundError(f"no files match {pattern}")
    lines = {} if header is not None else first_lines(spark, files, header_bytes)
    rows = [(p, n, header if header is not None else lines.get(p)) for p, n in files]
    listed = spark.createDataFrame(rows, CAPTURE_SCHEMA)
    named = listed.withColumn("capture", capture_name(F.col("file_path")))
    return named.select("file_path", _uri(F.col("file_path")).alias("source_file"), "capture",
                        date_from_name(F.col("capture")).alias("capture_date"), "file_size", "header")


def by_file(counted: DataFrame, files: DataFrame, path: str = "file_path") -> DataFrame:
    """Add capture name and date to rows that carry a file's path: a join of per-file rows, so
    nothing is worked out per input row."""
    known = files.select(F.col("source_file").alias("__path"), "capture", "capture_date")
    return counted.join(known, _uri(source_path(F.col(path))) == F.col("__path")).drop("__path")
