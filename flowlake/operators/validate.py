"""Independent recount from raw CSV text (V1) and the structural check (V2).

The recount does not reuse the cleaning code: it parses each raw line with
``from_csv`` (its own, positional read of the cells), applies the documented row
rules itself (trimmed label, not null, not ``Label``; a time in one of the accepted
formats or a weekday in the capture's name) and groups by capture and label.  Comparing it with the fact by a full
outer join shows every label whose rows the cleaning step kept or dropped
differently from the documented rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake.functions.cleaning import TIMESTAMP_FORMATS, capture_name
from flowlake.functions.columns import resolve_aliases, unique_names
from flowlake.operators.clean import SOURCE_FILE
from flowlake.operators.reconcile import reconcile_counts
from flowlake.sources.captures import by_file, captures
from flowlake.sources.csv import header_groups, parse_header


def source_name(path: Column) -> Column:
    """Name of the capture, from its decoded path."""
    return capture_name(path)


def _readable(time: Column | None) -> Column:
    """Does the cell hold a time in one of the accepted formats?  A parse is only tried on text
    that looks like one: a failed one costs an exception."""
    if time is None:
        return F.lit(False)
    tried = F.coalesce(*[F.try_to_timestamp(time, F.lit(f)) for f in TIMESTAMP_FORMATS])
    return F.when(time.rlike(r"^[0-9]+/[0-9]+/[0-9]+ [0-9]+:[0-9]+"), tried.isNotNull()).otherwise(F.lit(False))


def raw_label_recount(spark: SparkSession, pattern: str) -> DataFrame:
    """(source_name, label, raw_flow_count) straight from the text lines.

    Lines are counted per file; the captures table then tells each file's name and day."""
    frames = []
    for header, files in header_groups(spark, pattern).items():
        names = unique_names(parse_header(header))
        found = resolve_aliases(names)
        if "label" not in found:
            raise ValueError(f"no label column in header of {files[0]}")
        ddl = ", ".join(f"c{i} STRING" for i in range(len(names)))
        cells = spark.read.text(files).select(
            F.from_csv("value", ddl).alias("cells"), F.col("_metadata.file_path").alias("file_path"))
        cell = lambda name: F.col(f"cells.c{names.index(found[name])}")
        frames.append(cells.select(
            F.trim(cell("label")).alias("label"), "file_path",
            _readable(cell("timestamp") if "timestamp" in found else None).alias("timed")))
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    counted = (out.where(F.col("label").isNotNull() & (F.col("label") != F.lit("Label")))
               .groupBy("file_path", "label", "timed").agg(F.count(F.lit(1)).alias("n")))
    return (by_file(counted, captures(spark, pattern, header=""))
            .where(F.col("timed") | F.col("capture_date").isNotNull())
            .groupBy(F.col("capture").alias("source_name"), "label")
            .agg(F.sum("n").alias("raw_flow_count")))


def fact_label_counts_by_source(fact: DataFrame) -> DataFrame:
    """Counted per path first: names are taken from a row per path and label."""
    counted = fact.groupBy(SOURCE_FILE, "label").agg(F.count(F.lit(1)).alias("n"))
    return (counted.groupBy(source_name(F.col(SOURCE_FILE)).alias("source_name"), "label")
            .agg(F.sum("n").alias("fact_flow_count")))


def validate_labels(spark: SparkSession, pattern: str, fact: DataFrame) -> DataFrame:
    """V1: per (source, label) recount vs fact, with a match flag."""
    return reconcile_counts(
        raw_label_recount(spark, pattern), fact_label_counts_by_source(fact),
        ["source_name", "label"], "raw_flow_count", "fact_flow_count")


def reconcile_label_counts(spark: SparkSession, pattern: str, fact: DataFrame) -> DataFrame:
    """Per label recount vs fact (full outer join, missing -> 0)."""
    raw = raw_label_recount(spark, pattern).groupBy("label").agg(
        F.sum("raw_flow_count").cast("bigint").alias("raw_flow_count"))
    facts = fact.groupBy("label").agg(F.count(F.lit(1)).alias("fact_flow_count"))
    return reconcile_counts(raw, facts, ["label"], "raw_flow_count", "fact_flow_count")


def validate_structure(raw_rows: DataFrame, fact: DataFrame) -> DataFrame:
    """V2: one row; cleaning only drops rows, so cleaned <= raw.  Where ``raw_rows`` also counts
    records, these are the bound: lines that a quoted cell spans aren't rows."""
    exact = "records" in raw_rows.columns
    raw = raw_rows.select("raw_rows").scalar()
    bound = raw_rows.select("records").scalar() if exact else raw
    records = [bound.alias("records")] if exact else []
    return fact.agg(F.count(F.lit(1)).alias("cleaned_rows")).select(
        raw.alias("raw_rows"), *records, "cleaned_rows",
        (F.col("cleaned_rows") <= bound).alias("passed"))
