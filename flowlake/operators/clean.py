"""Raw flows -> cleaned fact rows (``network_events``).

Filters, projections and generators over the raw scan: no shuffle, no action.
Catalyst pushes the label predicate into the scan; the time text is parsed once a row,
for the rows that the label keeps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, TimestampNTZType, TimestampType

from flowlake.functions import cleaning as C

SOURCE_FILE = "_source_file"
FACT_PARTITIONS = ["event_date", "attack_category"]


def trimmed_label(df: DataFrame, cols: dict[str, str]) -> Column:
    return F.trim(F.col(cols["label"]))


def keep_labelled(label: Column) -> Column:
    """Drop null labels and stray header rows (trimmed label == 'Label')."""
    return label.isNotNull() & (label != F.lit(C.STRAY_HEADER_LABEL))


def filename_date(df: DataFrame) -> Column:
    if SOURCE_FILE in df.columns:
        return C.date_from_path(F.col(SOURCE_FILE))
    return F.lit(None).cast("date")


def event_time(df: DataFrame, cols: dict[str, str]) -> Column:
    if "timestamp" not in cols:
        return F.lit(None).cast("timestamp_ntz")
    raw = cols["timestamp"]
    dtype = df.schema[raw].dataType
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return F.col(raw).cast("timestamp_ntz")
    text = F.col(raw) if isinstance(dtype, StringType) else F.col(raw).cast("string")
    return C.parse_timestamp_multi(text)


def _bound(df: DataFrame, *columns: Column) -> DataFrame:
    """Add columns whose values later filters and projections share.

    A projection would be copied into every expression above and below it; a
    generator's output is computed once a row."""
    return df.select("*", F.inline(F.array(F.struct(*columns))))


def with_event_time(df: DataFrame, cols: dict[str, str]) -> DataFrame:
    """Add ``event_time`` and ``event_date`` (of the time, else of the capture's name)."""
    if SOURCE_FILE in df.columns:
        df = _bound(df, C.capture_name(F.col(SOURCE_FILE)).alias("__capture"))
        file_date = C.date_from_name(F.col("__capture"))
    else:
        file_date = filename_date(df)
    df = _bound(df, event_time(df, cols).alias("event_time"), file_date.alias("__file_date"))
    dated = F.coalesce(F.to_date("event_time"), F.col("__file_date")).alias("event_date")
    return df.select("*", dated).drop("__file_date", "__capture")


def clean(df: DataFrame, cols: dict[str, str]) -> DataFrame:
    """Trim label, drop stray headers, null non-finite floats, derive time
    columns and category, rename the label to ``label``, drop undated rows."""
    label_col = cols["label"]
    label = trimmed_label(df, cols)
    projected = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if field.name == label_col:
            projected.append(label.alias("label"))
        elif C.is_floating(field.dataType):
            projected.append(C.nonfinite_to_null(c).alias(field.name))
        else:
            projected.append(c)
    projected += ["event_time", "event_date", C.attack_category(label).alias("attack_category")]
    timed = with_event_time(df.where(keep_labelled(label)), cols)
    return timed.where(F.col("event_date").isNotNull()).select(*projected)


def fact_columns(cols: dict[str, str]) -> dict[str, str]:
    """Resolved names after ``clean`` (the label column is renamed)."""
    out = dict(cols)
    out["label"] = "label"
    return out
