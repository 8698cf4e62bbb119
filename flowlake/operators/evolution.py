"""Schema evolution and time-travel checks on snapshot tables.

The demo flows work on a copy of the fact in its own namespace, so the
transform output is never mutated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlake.sources.snapshots import SchemaMismatch, SnapshotStore

# The column that the demo flows add, and its scores.
NEW_COLUMN = "threat_intel_score"
MERGED_SCORE, ADDED_SCORE = 0.87, 0.9


def seed_copy(source: SnapshotStore, target: SnapshotStore, name: str = "network_events") -> bool:
    """K8: copy ``name`` into ``target`` only if absent there."""
    if target.present(name):
        return False
    c = source.commit(name)
    target.create(name, source.read(name), c.partition_columns)
    return True


def ordered_batch(df: DataFrame, n: int = 3, tiebreak: str = "Flow_Duration") -> DataFrame:
    """First n rows by (event_date, label) with a unique tie-breaker."""
    keys = ["event_date", "label"] + ([tiebreak] if tiebreak in df.columns else [])
    return df.orderBy(*keys).limit(n)


def append_guard(store: SnapshotStore, name: str, batch: DataFrame) -> DataFrame:
    """K4: an append whose schema differs is rejected before writing."""
    before = store.latest_version(name)
    try:
        store.append(name, batch)
        blocked, error = False, None
    except SchemaMismatch as exc:
        blocked, error = True, str(exc)
    return store.spark.createDataFrame(
        [(name, blocked, error, before, store.latest_version(name))],
        "table string, blocked boolean, error string, version_before long, version_after long")


def merge_evolution(store: SnapshotStore, name: str, source: DataFrame,
                    score: float = MERGED_SCORE) -> dict:
    """K5: append 3 rows with a new column, blocked first without merge."""
    before = store.commit(name)
    batch = ordered_batch(source).withColumn(NEW_COLUMN, F.lit(score).cast("double"))
    guard = append_guard(store, name, batch).first()
    store.append(name, batch, merge_schema=True)
    return {"before_version": before.version, "before_rows": before.row_count,
            "blocked": guard["blocked"], "after_version": store.latest_version(name)}


def column_evolution(store: SnapshotStore, name: str, source: DataFrame,
                     score: float = ADDED_SCORE) -> dict:
    """K7 + K6: ADD COLUMN (metadata only), then a conforming append."""
    before = store.commit(name)
    if before.row_count < 3:
        raise ValueError("evolution needs at least three seed rows")
    store.add_column(name, NEW_COLUMN, "double")
    batch = ordered_batch(source).withColumn(NEW_COLUMN, F.lit(score).cast("double"))
    store.append(name, batch)
    return {"before_snapshot_id": before.snapshot_id, "before_version": before.version,
            "before_rows": before.row_count, "after_version": store.latest_version(name)}


def schema_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Columns present in ``new`` but not in ``old`` plus the row delta."""
    spark = old.sparkSession
    o = spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in old.schema.fields],
                              "column_name string, data_type string")
    n = spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in new.schema.fields],
                              "column_name string, data_type string")
    delta = new.agg(F.count(F.lit(1)).alias("n")).select("n").scalar() - \
        old.agg(F.count(F.lit(1)).alias("o")).select("o").scalar()
    return n.subtract(o).select("column_name", "data_type", delta.alias("row_delta"))


def evolution_check(store: SnapshotStore, name: str, before_version: int) -> DataFrame:
    """V4: rows = before + 3, nulls in the new column = before, and the old
    version read by time travel does not have the column."""
    old = store.read(name, version=before_version)
    cur = store.read(name)
    old_has = NEW_COLUMN in old.columns
    new_has = NEW_COLUMN in cur.columns
    before = old.agg(F.count(F.lit(1)).alias("before_rows"))
    after = cur.agg(F.count(F.lit(1)).alias("after_rows"),
                    F.count_if(F.col(NEW_COLUMN).isNull()).cast("bigint").alias("null_rows"))
    b = before.select("before_rows").scalar()
    return after.select(
        b.alias("before_rows"), "after_rows", "null_rows",
        F.lit(old_has).alias("old_has_column"), F.lit(new_has).alias("new_has_column"),
        ((F.col("after_rows") == b + 3) & (F.col("null_rows") == b)
         & F.lit(not old_has) & F.lit(new_has)).alias("passed"))

