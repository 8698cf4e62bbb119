"""Exact discrete percentile (A4) without funnelling the column into one task.

The value returned is the k-th smallest finite value with k = ceil(p*n),
the same value as ``percentile_disc(p)`` and ``approxQuantile(.., 0.0)``.

Neither of those scales: ``approxQuantile`` with zero error keeps every
sample in the merged summary on the driver, ``percentile_disc`` keeps a
value->count map of the whole group in one aggregation buffer, and even
``percentile_approx`` merges one sketch per map task in a single final task
(hundreds of thousands of sketches over a 100 TB scan).  Here the rank is
found with exact histograms, each an ordinary ``groupBy().count()`` with
partial aggregation, so no step ever runs in one task over the whole data:

1. first scan: counts per *magnitude band* (1,024 bands per power of two,
   ``floor(log2|x| * 1024)``; the key is monotone in x, so a band is a bracket that can't miss).
   A running sum over the band rows (some tens of thousands) picks the band that holds
   rank k, with n, the rows below it and its exact min and max;
2. second scan: the counts per value of that band's rows go to a written table;
3. ``rounds`` histograms of ``buckets`` equal-width buckets narrow that table, and a running
   sum over the values that are left finds the value.  A band holds 2**42 doubles, so after two
   rounds of 65,536 buckets at most 2**10 different ones are left, whatever the input holds.

The input is scanned twice at any size; only a band of a single value needs no second scan.  Every
count is exact.  What reaches the driver is one row per step.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlake.session import scratch_path

ROUNDS = 2
BUCKETS = 65_536
BANDS_PER_OCTAVE = 1024
# Keys of positive values start above every negative key: bands of finite
# doubles lie in [-1075, 1024) octaves.
_BAND_OFFSET = 1100 * BANDS_PER_OCTAVE


def _rank(p: float, n: int) -> int:
    return min(n, max(1, math.ceil(p * n)))


def _band_key(x: Column) -> Column:
    """Monotone in x: negatives (by falling magnitude) < 0 < positives."""
    band = F.floor(F.log2(F.abs(x)) * F.lit(BANDS_PER_OCTAVE)) + F.lit(_BAND_OFFSET + 1)
    return F.when(x > 0, band).when(x < 0, -band).otherwise(F.lit(0)).cast("long")


def _pick(hist: DataFrame, rank: Column | int) -> DataFrame:
    """Bucket rows (key, c, lo, hi) -> the one row whose running count
    reaches ``rank``, with ``before`` = rows in earlier buckets and ``n``."""
    running = Window.orderBy("key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy()
    h = (hist.withColumn("cum", F.sum("c").over(running))
         .withColumn("n", F.sum("c").over(whole)))
    r = rank if isinstance(rank, Column) else F.lit(rank)
    return h.where((F.col("cum") - F.col("c") < r) & (r <= F.col("cum"))).select(
        "lo", "hi", "c", (F.col("cum") - F.col("c")).alias("before"), "n")


def _final(counts: DataFrame, lo: float, hi: float, rank: int) -> DataFrame:
    """Counts per value within [lo, hi], running sum, the value at rank."""
    running = Window.orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        counts.where(F.col("x").between(F.lit(lo), F.lit(hi)))
        .groupBy("x").agg(F.sum("c").alias("c"))
        .withColumn("cum", F.sum("c").over(running))
        .agg(F.min(F.when(F.col("cum") >= F.lit(rank), F.col("x"))).alias("value"),
             (F.max("cum") >= F.lit(rank)).alias("ok"))
    )


def _value_counts(values: DataFrame, lo: float, hi: float) -> DataFrame:
    """Counts per value within [lo, hi], written once to the shared folder."""
    path = scratch_path(values.sparkSession, "percentile")
    (values.where(F.col("x").between(F.lit(lo), F.lit(hi)))
     .groupBy("x").agg(F.count(F.lit(1)).alias("c")).write.parquet(path))
    return values.sparkSession.read.schema("x double, c long").parquet(path)


def exact_percentile_frame(df: DataFrame, column: str, p: float, rounds: int = ROUNDS,
                           buckets: int = BUCKETS) -> DataFrame | None:
    """One-row DataFrame ``(value, ok)`` with the exact percentile, or None
    when the column has no finite value.  ``df`` is scanned twice; all but the last
    step runs eagerly."""
    if not 0.0 <= p <= 1.0:
        raise ValueError("percentile must be in [0, 1]")
    if buckets < 2:
        raise ValueError("need at least two buckets")
    x = F.col("x")
    values = (
        df.select(F.col(column).try_cast("double").alias("x"))
        .where(x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    )
    bands = values.groupBy(_band_key(x).alias("key")).agg(
        F.count(F.lit(1)).alias("c"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    # rank = ceil(p * n) on the band rows themselves (n is their sum); the
    # same double arithmetic as math.ceil(p * n) below
    n_col = F.sum("c").over(Window.partitionBy())
    rank_col = F.greatest(F.lit(1), F.least(n_col, F.ceil(F.lit(p) * n_col)))
    hit = _pick(bands.withColumn("rank", rank_col), F.col("rank")).first()
    if hit is None:
        return None
    rank = _rank(p, hit["n"]) - hit["before"]
    lo, hi = hit["lo"], hit["hi"]
    spark = values.sparkSession
    if lo == hi:
        return spark.createDataFrame([(float(lo), True)], "value double, ok boolean")
    counts = _value_counts(values, lo, hi)
    for _ in range(rounds):
        if lo == hi:
            break
        bucket = F.least(F.floor((x - F.lit(lo)) / F.lit(hi - lo) * F.lit(buckets)), F.lit(buckets - 1)).cast("long")
        hist = counts.where(x.between(F.lit(lo), F.lit(hi))).groupBy(bucket.alias("key")).agg(
            F.sum("c").alias("c"), F.min("x").alias("lo"), F.max("x").alias("hi"))
        hit = _pick(hist, rank).first()
        if hit is None:  # counts are exact, so the rank always falls in a bucket
            raise RuntimeError(f"exact percentile: rank {rank} not found in [{lo}, {hi}]")
        rank -= hit["before"]
        lo, hi = hit["lo"], hit["hi"]
    if lo == hi:
        return spark.createDataFrame([(float(lo), True)], "value double, ok boolean")
    return _final(counts, lo, hi, rank)


def exact_percentile(df: DataFrame, column: str, p: float, **kw) -> float | None:
    """The exact percentile as a Python value."""
    frame = exact_percentile_frame(df, column, p, **kw)
    if frame is None:
        return None
    row = frame.first()
    if not row["ok"]:
        raise RuntimeError("exact percentile: rank not found in the final range")
    return row["value"]
