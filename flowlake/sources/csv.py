"""Multi-file CSV scan with header grouping, lineage and line counts.

Files are grouped by their own header line, so files with different
headers are read by name, never by position.  The canonical columns have declared
types, others those the caller gives (text without one).  Values are read as text and
converted with ``try_cast``, but for the further columns that the caller declares as
``double``: these the reader parses itself, which takes a fraction of the time where captures have
dozens of them.  Either way a stray header or junk value becomes null in its own cell.  Type inference for the other columns is one
distributed aggregate, on request only.
"""

from __future__ import annotations

import csv as _csv
import io
from collections import OrderedDict

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from flowlake.functions.cleaning import capture_name
from flowlake.functions.columns import CANONICAL_TYPES, resolve_aliases, unique_names
from flowlake.operators.clean import SOURCE_FILE
from flowlake.sources import fs
from flowlake.sources.captures import captures, first_lines, source_path

# Text shapes that inference knows.  Integers beyond a bigint are decimals, so no
# digit is lost; numbers of other shapes and inf/nan literals are doubles.
_INTEGER = r"^[+-]?0*([0-9]{1,38})$"
_NUMBER = (r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
           r"|^[+-]?(?i:inf|infinity)$|^(?i:nan)$")
_BIGINT_MAX = str(2 ** 63 - 1)
_INFERRED = ("string", "bigint", "decimal(38,0)", "double", "string")


def parse_header(line: str) -> list[str]:
    """Header cells of one CSV line (quotes handled; a UTF-8 byte-order mark
    in front of the first name is dropped)."""
    return next(_csv.reader(io.StringIO(line.lstrip("\ufeff"))))


def header_groups(spark: SparkSession, pattern: str, header: str | None = None) -> "OrderedDict[str, list[str]]":
    """Files grouped by their first line (read by Spark tasks).  With ``header`` given (all files
    known to share it) no file is read for it."""
    files = fs.glob_files(spark, pattern)
    if not files:
        raise FileNotFoundError(f"no files match {pattern}")
    if header is not None:
        return OrderedDict([(header, [p for p, _ in files])])
    lines = first_lines(spark, files)
    groups: OrderedDict[str, list[str]] = OrderedDict()
    for path, _ in files:
        line = lines.get(path)
        if line and line.strip("\ufeff \t\r"):  # an empty capture has no rows
            groups.setdefault(line, []).append(path)
    if not groups:
        raise ValueError(f"all files of {pattern} are empty: no header to read")
    return groups


def read_text_columns(spark: SparkSession, pattern: str, header: str | None = None,
                      doubles: set[str] = frozenset()) -> DataFrame:
    """All files as string columns (stripped, de-duplicated names) + lineage.  Columns of ``doubles``
    that aren't canonical ones are parsed as numbers; non-finite ones are spelled as in Java
    (``NaN``, ``Infinity``) or ``Inf``."""
    frames = []
    groups = [(unique_names(parse_header(line)), files)
              for line, files in header_groups(spark, pattern, header).items()]
    every = list(dict.fromkeys(n for names, _ in groups for n in names))
    parsed = doubles - set(resolve_aliases(every).values())
    for names, files in groups:
        schema = StructType([StructField(n, DoubleType() if n in parsed else StringType(), True) for n in names])
        df = (
            spark.read.schema(schema)
            .option("header", True)
            .option("enforceSchema", True)
            .option("mode", "PERMISSIVE")
            .csv(files)
            .withColumn(SOURCE_FILE, source_path())
        )
        frames.append(df)
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def infer_types(df: DataFrame, columns: list[str] | None = None) -> dict[str, str]:
    """Narrowest of bigint, decimal(38,0) and double that every value of a column fits.

    One aggregate pass.  Empty values, and values equal to the column's own
    name (stray header rows), do not count against a type.  Each cell gets a
    code (0 absent, 1 bigint, 2 decimal, 3 double, 4 text) and each column keeps its
    maximum: one small aggregate per column.  The codes come from regexes
    only: a failed ``try_cast`` costs a JVM exception per cell."""
    columns = [c for c in (columns or df.columns) if c != SOURCE_FILE]
    if not columns:
        return {}
    codes = []
    for i, c in enumerate(columns):
        v = F.trim(F.col(f"`{c}`"))
        present = v.isNotNull() & (v != F.lit("")) & (v != F.lit(c.strip()))
        digits = F.regexp_extract(v, _INTEGER, 1)
        fits = (F.length(digits) < 19) | ((F.length(digits) == 19) & (digits <= F.lit(_BIGINT_MAX)))
        code = (
            F.when(~present, F.lit(0))
            .when((digits != "") & fits, F.lit(1))
            .when(digits != "", F.lit(2))
            .when(v.rlike(_NUMBER), F.lit(3))
            .otherwise(F.lit(4))
        )
        codes.append(code.cast("tinyint").alias(f"c{i}"))
    row = df.select(*codes).agg(*[F.max(f"c{i}").alias(f"c{i}") for i in range(len(columns))]).first()
    return {c: _INFERRED[row[f"c{i}"] or 0] for i, c in enumerate(columns)}


def apply_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    cols = []
    for c in df.columns:
        t = types.get(c, "string")
        col = F.col(f"`{c}`")
        cols.append(col if t in ("string", df.schema[c].dataType.simpleString()) else _converted(F.trim(col), t).alias(c))
    return df.select(*cols)


def _converted(text: Column, data_type: str) -> Column:
    """``try_cast``; a whole number written with a point (``12.0``) is an integer too."""
    if data_type != "bigint":
        return text.try_cast(data_type)
    pointed = F.when(text.contains(".") | text.contains("e") | text.contains("E"),
                     text.try_cast("double").try_cast("bigint"))
    return F.coalesce(F.when(text.rlike(_INTEGER), text.try_cast("bigint")), pointed)


def csv_scan(spark: SparkSession, pattern: str,
             types: dict[str, str] | None = None, header: str | None = None,
             infer: bool = False) -> DataFrame:
    """CSV files -> typed DataFrame with ``_source_file``.

    Canonical columns have their declared types; ``types`` maps further (stripped)
    column names to Spark types, or overrides.  Other columns are text, unless ``infer``
    asks for one aggregate pass over them.  ``header`` (the raw header line)
    declares that every file shares it: with very many files this skips the
    per-file header reads on the driver."""
    text = read_text_columns(spark, pattern, header, {c for c, t in (types or {}).items() if t == "double"})
    known = {actual: CANONICAL_TYPES[canonical]
             for canonical, actual in resolve_aliases(text.columns).items()}
    known.update(types or {})
    if infer:
        known.update(infer_types(text, [c for c in text.columns if c not in known]))
    return apply_types(text, known)


def raw_line_counts(spark: SparkSession, pattern: str) -> DataFrame:
    """S8 per file: physical lines minus the header line."""
    files = [p for p, _ in fs.glob_files(spark, pattern)]
    return (
        spark.read.text(files)
        .groupBy(F.col("_metadata.file_path").alias("file_path"))
        .agg((F.count(F.lit(1)) - 1).alias("raw_rows"))
    )


def raw_line_count(spark: SparkSession, pattern: str) -> DataFrame:
    """One row, all files (an upper bound on records: quoted newlines)."""
    return raw_line_counts(spark, pattern).agg(F.sum("raw_rows").cast("bigint").alias("raw_rows"))


def raw_record_counts(spark: SparkSession, pattern: str) -> DataFrame:
    """S8 exactly, per file: ``file_path, raw_rows`` (lines, less the header) and ``records``, which may
    hold quoted line feeds; blank lines between records aren't any.

    A line with an odd number of quotes opens or closes a quoted cell.  Splits are scanned in parallel:
    each counts its lines, a running sum over a file's splits gives where each begins, and
    only the lines that matter (odd quotes, or blank) are put in order.  Quotes follow what
    Spark writes: a cell that holds one is quoted, and it stands behind a backslash or doubled."""
    bare = F.when(F.col("value").contains("\\"), F.regexp_replace("value", r"\\.", "")).otherwise(F.col("value"))
    quotes = F.length(bare) - F.length(F.replace(bare, F.lit('"'), F.lit("")))
    lines = spark.read.text([p for p, _ in fs.glob_files(spark, pattern)]).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"), (quotes % 2).alias("odd"),
        (F.trim("value") == "").cast("int").alias("blank"))
    earlier = Window.partitionBy("file_path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    splits = (lines.groupBy("file_path", "start").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
              .withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))))
    size = splits.groupBy("file_path").agg(F.sum("n").alias("lines"))
    telling = (lines.where("odd = 1 OR blank = 1").join(splits, ["file_path", "start"])
               .select("file_path", (F.col("before") + F.col("at") - F.col("first")).alias("place"), "odd", "blank"))
    order = Window.partitionBy("file_path").orderBy("place")
    seen = F.sum("odd").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    opened = F.max(F.when(F.col("odd") == 1, F.col("place"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    judged = telling.select("file_path", "place", "odd", "blank", seen.alias("seen"), opened.alias("opened"))
    inside = F.when((F.col("odd") == 1) & (F.col("seen") % 2 == 0), F.col("place") - F.col("opened"))
    gone = judged.groupBy("file_path").agg(
        (F.coalesce(F.sum(inside), F.lit(0)) + F.count_if((F.col("blank") == 1) & (F.col("seen") % 2 == 0))).alias("gone"),
        # a quote that is never closed takes in the rest of the file
        F.max_by(F.when(F.col("seen") % 2 == 1, F.greatest("opened", F.when(F.col("odd") == 1, F.col("place")))),
                 "place").alias("open_at"))
    less = F.coalesce("gone", F.lit(0)) + F.coalesce(F.col("lines") - 1 - F.col("open_at"), F.lit(0))
    return size.join(gone, "file_path", "left").select(
        "file_path", (F.col("lines") - 1).alias("raw_rows"), (F.col("lines") - 1 - less).alias("records"))


def raw_record_count(spark: SparkSession, pattern: str) -> DataFrame:
    """One row, all files: lines (an upper bound) and records."""
    return raw_record_counts(spark, pattern).agg(F.sum("raw_rows").alias("raw_rows"), F.sum("records").alias("records"))


def smallest_file(spark: SparkSession, pattern: str) -> DataFrame:
    """The smallest input file (ties broken by path), from the captures table."""
    return captures(spark, pattern, header="").orderBy("file_size", "file_path").limit(1).select(
        "file_path", "capture", "file_size")


def rows_of_source_file(df: DataFrame, name: str) -> DataFrame:
    """Rows of the capture called ``name``.

    Equality on the capture's decoded name, so ``Monday x.csv`` matches its own file,
    ``a.csv`` does not also match ``aa.csv``, and folders don't count."""
    return df.where(capture_name(F.col(SOURCE_FILE)) == F.lit(name))
