"""Reconciliation and equality checks, all computed in Spark.

Nothing here collects rows: differences are DataFrames, fingerprints are
one-row aggregates.  A check "passes" when the difference is empty, which a
caller tests with ``isEmpty()`` (a LIMIT 1 job, not a full count).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlake.sources.snapshots import row_hash


def except_all_both_ways(left: DataFrame, right: DataFrame) -> DataFrame:
    """Multiset difference in both directions, tagged ``side``, each row as often as it
    is missing on the other side.

    Empty result <=> equal multisets of rows.  Columns are aligned by name."""
    diff = drilled_differences(left, right).withColumn("__more", F.col("left_rows") - F.col("right_rows"))
    side = F.when(F.col("__more") > 0, F.lit("left")).otherwise(F.lit("right")).alias("side")
    times = F.sequence(F.lit(1).cast("long"), F.abs("__more"))
    return diff.select(side, *[F.col(f"`{c}`") for c in left.columns], F.explode(times).alias("__copy")).drop("__copy")


def difference_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows whose multiplicity differs, with both multiplicities.

    One shuffle for both directions (``exceptAll`` twice costs two): both
    sides tagged, unioned, grouped by every column.  Partial aggregation
    collapses repeated rows map-side, and no row is replicated, so a value
    repeated a billion times is one group, not a billion output rows."""
    cols = [F.col(f"`{c}`") for c in left.columns]
    tagged = left.select(*cols, F.lit(1).alias("_in_left"), F.lit(0).alias("_in_right")).unionByName(
        right.select(*cols, F.lit(0).alias("_in_left"), F.lit(1).alias("_in_right")))
    return (
        tagged.groupBy(*cols)
        .agg(F.sum("_in_left").alias("left_rows"), F.sum("_in_right").alias("right_rows"))
        .where(F.col("left_rows") != F.col("right_rows"))
    )


#: Buckets that digests are taken of.
BUCKETS = 4096


def _digests(df: DataFrame, buckets: int, side: str) -> DataFrame:
    h = row_hash(df.columns)
    return (df.select(F.pmod(h, F.lit(buckets)).cast("int").alias("bucket"), h.alias("h"))
            .groupBy("bucket").agg(F.struct(F.count(F.lit(1)), F.sum(F.col("h").cast("decimal(38,0)")),
                                            F.sum(F.xxhash64("h").cast("decimal(38,0)"))).alias(side)))


def differing_buckets(left: DataFrame, right: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Buckets of row hashes whose digests (count and sums of two hashes) differ.  Each side is
    aggregated within its tasks, so at most ``buckets`` rows a task are shuffled."""
    both = _digests(left, buckets, "l").join(_digests(right.select(*left.columns), buckets, "r"), "bucket", "full_outer")
    return both.where(~F.col("l").eqNullSafe(F.col("r"))).select("bucket")


def drilled_differences(left: DataFrame, right: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``difference_counts`` of the rows in differing buckets only: equal tables shuffle digests
    and no row.  The list of differing buckets is at most ``buckets`` numbers."""
    right = right.select(*left.columns)
    bad = sorted(r["bucket"] for r in differing_buckets(left, right, buckets).collect())
    if not bad:
        nothing = left.sparkSession.createDataFrame([], left.schema)
        return difference_counts(nothing, nothing)
    inside = lambda df: df.where(F.pmod(row_hash(df.columns), F.lit(buckets)).isin(bad))
    return difference_counts(inside(left), inside(right))


def multiset_equal(left: DataFrame, right: DataFrame) -> bool:
    """Same rows with the same multiplicities, by the digests of their buckets."""
    return differing_buckets(left, right).isEmpty()


def fingerprint(df: DataFrame) -> DataFrame:
    """Order- and partition-independent checksum of all rows.

    count, sum (as decimal(38,0), cannot overflow), min and max of
    ``xxhash64`` over every column: one partial+final aggregate."""
    return df.select(row_hash(df.columns).alias("h")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.col("h").cast("decimal(38,0)")).alias("hash_sum"),
        F.min("h").alias("hash_min"),
        F.max("h").alias("hash_max"),
    )


def table_equality(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: schema equality, row counts and full multiset equality.  Rows are compared in
    the buckets whose digests differ."""
    same_schema = left.schema.simpleString() == right.schema.simpleString()
    diff = drilled_differences(left, right)
    counts = diff.agg(
        F.coalesce(F.sum(F.greatest(F.col("left_rows") - F.col("right_rows"), F.lit(0))),
                   F.lit(0)).cast("bigint").alias("only_left"),
        F.coalesce(F.sum(F.greatest(F.col("right_rows") - F.col("left_rows"), F.lit(0))),
                   F.lit(0)).cast("bigint").alias("only_right"),
    )
    return counts.select(
        F.lit(same_schema).alias("same_schema"),
        "only_left", "only_right",
        ((F.col("only_left") == 0) & (F.col("only_right") == 0) & F.lit(same_schema)).alias("equal"),
    )


def reconcile_counts(left: DataFrame, right: DataFrame, keys: list[str],
                     left_count: str, right_count: str) -> DataFrame:
    """Full outer equi-join of two independent counts; missing -> 0."""
    joined = left.join(right, on=keys, how="full_outer")
    return joined.select(
        *keys,
        F.coalesce(F.col(left_count), F.lit(0)).cast("bigint").alias(left_count),
        F.coalesce(F.col(right_count), F.lit(0)).cast("bigint").alias(right_count),
    ).withColumn("match", F.col(left_count) == F.col(right_count))
