"""Window counts (A2) as an incremental Structured Streaming job.

The batch operators are plain ``DataFrame -> DataFrame`` functions, so the
same cleaning and the same ``groupBy(window)`` run on a streaming source.
A watermark on ``event_time`` bounds the aggregation state and lets Spark
emit each 5-minute window once, when it can no longer change (append
mode).  Each micro-batch is appended to a snapshot table; the batch id is
recorded in the commit that appends it, so a batch replayed after a failure is
not appended twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from flowlake.functions.columns import prepare_columns
from flowlake.operators import aggregates as A
from flowlake.operators.clean import SOURCE_FILE, clean, fact_columns
from flowlake.sources.csv import apply_types, source_path
from flowlake.sources.snapshots import SnapshotStore

DEFAULT_WATERMARK = "10 minutes"


def stream_window_counts(fact: DataFrame, cols: dict[str, str],
                         watermark: str = DEFAULT_WATERMARK) -> DataFrame | None:
    """A2 on a (streaming) fact with a watermark on ``event_time``.

    Watermarks need a zoned ``timestamp``: the wall-clock ``event_time`` is
    read as UTC for the aggregation and the window bounds are turned back
    into wall-clock values, so the rows equal the batch table's."""
    timed = (fact.withColumn("event_time", F.col("event_time").cast("timestamp"))
             .withWatermark("event_time", watermark))
    counts = A.src_ip_window_counts(timed, cols)
    if counts is None:
        return None
    return counts.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")) \
                 .withColumn("window_end", F.col("window_end").cast("timestamp_ntz"))


def read_capture_stream(spark: SparkSession, folder: str, header: list[str],
                        types: dict[str, str]) -> DataFrame:
    """New CSV captures in ``folder`` as a stream (one known header)."""
    schema = StructType([StructField(n, StringType(), True) for n in header])
    text = (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .csv(folder)
        .withColumn(SOURCE_FILE, source_path())
    )
    return apply_types(text, types)


def _append_batch(store: SnapshotStore, name: str, partition_by: list[str]):
    def sink(batch: DataFrame, batch_id: int) -> None:
        key = "stream_batch_id"
        if store.exists(name) and store.commit(name).present:
            last = store.commit(name).properties.get(key)
            if last is not None and int(last) >= batch_id:
                return  # replay of a batch that is already committed
            store.append(name, batch, properties={key: str(batch_id)})
            store.fold(name)  # keeps the segments few; a crash before it leaves them to the next batch
        else:
            store.overwrite(name, batch, partition_by, {key: str(batch_id)})
    return sink


def start_window_counts(spark: SparkSession, raw: DataFrame, store: SnapshotStore,
                        checkpoint: str, name: str = "src_ip_window_counts",
                        watermark: str = DEFAULT_WATERMARK,
                        available_now: bool = True) -> StreamingQuery:
    """raw capture stream -> clean -> windowed counts -> snapshot appends."""
    df, cols = prepare_columns(raw)
    counts = stream_window_counts(clean(df, cols), fact_columns(cols), watermark)
    if counts is None:
        raise ValueError("the capture stream has no source-IP column")
    writer = (
        counts.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(_append_batch(store, name, ["window_date"]))
    )
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
