"""Line dedup, native: drop lines that many documents share, keep the rest in order.

Lines are the pieces between line feeds of the whole text; a line's key is the line
without white space (space, 0x09-0x0D) at both ends and with A-Z lower-cased.
Plan (DataFrame functions only):

1. explode each document's lines with their position; hash the key to 128 bits;
2. count distinct documents per hash in two partial aggregates, (hash, document)
   then (hash), so a line that a third of all documents hold is summed map-side;
3. positions whose hash reached the threshold, collected per document: only
   hashes, ids and positions are shuffled for this, never text;
4. join those positions to the documents and put the gaps between them together
   again, in linear time.  AQE broadcasts the positions when they are small
   enough, and splits skewed hashes when they are not.

A document is a ``doc_id``: rows repeating an id count once per line (all rows with a
null id count as one document).  Null or empty text is one empty line.  Keys shorter
than ``min_chars`` code points are never dropped.  An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlake.llm.common import lower_ascii

BLANKS = " \t\n\x0b\x0c\r"
MIN_DOCS = 10


def line_key(line):
    return lower_ascii(F.trim(line, F.lit(BLANKS)))


def _row_key(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``__r1, __r2``: 128 bits that tell a row's id and text from any other's."""
    return df.select(
        "*", F.xxhash64(F.col(id_col), F.col(text_col)).alias("__r1"),
        F.xxhash64(F.lit(7), F.col(text_col), F.col(id_col)).alias("__r2"))


def common_positions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     min_docs: int = MIN_DOCS, min_chars: int = 1) -> DataFrame:
    """``__r1, __r2, __drop``: ascending positions of the lines to drop, one row
    per document that has any."""
    lines = (_row_key(docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__t")), "__id", "__t")
             .select("__id", "__r1", "__r2",
                     F.posexplode(F.split(F.coalesce(F.col("__t"), F.lit("")), "\n", -1)).alias("__pos", "__line"))
             .withColumn("__key", line_key(F.col("__line"))))
    if min_chars > 0:
        lines = lines.filter(F.char_length("__key") >= min_chars)
    hashed = lines.select("__id", "__r1", "__r2", "__pos",
                          F.xxhash64("__key").alias("__h1"), F.xxhash64(F.lit(7), "__key").alias("__h2"))
    common = (hashed.groupBy("__h1", "__h2", "__id").agg(F.lit(1).alias("__one"))
              .groupBy("__h1", "__h2").agg(F.count("*").alias("__docs"))
              .filter(F.col("__docs") >= min_docs).select("__h1", "__h2"))
    return (hashed.join(common, ["__h1", "__h2"])
            .groupBy("__r1", "__r2").agg(F.array_sort(F.collect_set("__pos")).alias("__drop")))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_docs: int = MIN_DOCS, min_chars: int = 1) -> DataFrame:
    """All columns of ``docs`` plus ``kept`` (the text without its common lines),
    ``n_lines`` (before) and ``n_dropped``.  Columns of these names are replaced."""
    columns = [c for c in docs.columns if c not in ("kept", "n_lines", "n_dropped")]
    drops = common_positions(docs, id_col, text_col, min_docs, min_chars)
    joined = _row_key(docs.select(*columns), id_col, text_col).join(drops, ["__r1", "__r2"], "left")
    with_lines = joined.select(
        *columns, "__drop", F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1).alias("__lines"))
    n_lines = F.size("__lines")
    # the kept lines are the gaps between consecutive dropped positions
    gaps = F.transform(
        F.sequence(F.lit(0), F.size("__drop")),
        lambda i: F.slice(
            F.col("__lines"),
            F.when(i == 0, F.lit(1)).otherwise(F.get(F.col("__drop"), i - 1) + 2),
            F.when(i == F.size("__drop"), n_lines).otherwise(F.get(F.col("__drop"), i))
            - F.when(i == 0, F.lit(0)).otherwise(F.get(F.col("__drop"), i - 1) + 1)))
    kept = (F.when(F.col("__drop").isNull(), F.coalesce(F.col(text_col), F.lit("")))
            .otherwise(F.array_join(F.flatten(gaps), "\n")))
    return with_lines.select(
        *columns, kept.alias("kept"), n_lines.cast("long").alias("n_lines"),
        F.coalesce(F.size(F.when(F.col("__drop").isNotNull(), F.col("__drop"))), F.lit(0))
        .cast("long").alias("n_dropped"))
