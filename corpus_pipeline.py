"""A training corpus from ``documents``: five stages, each a Parquet table.

language id -> line dedup -> n-gram near-duplicates -> benchmark decontamination
-> best-fit packing.  A stage reads all rows its predecessor kept; all but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake.llm import decontaminate, language_id, line_dedup, ngram_join, packing
from flowlake.llm.common import table, written
from flowlake.llm.queries import tokenizer_file

#: A language is taken as unknown below this mean probability.
MIN_SCORE = 0.3


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a recognisable language: null text, no letter, or a
    score below MIN_SCORE."""
    model = language_id.fit(docs.filter(language_id.training_rows("doc_id")))
    judged = docs.withColumn("__lang", language_id.language_of(model)(F.col("text")))
    known = (F.col("__lang.lang") != language_id.UNKNOWN) & (F.col("__lang.score") >= MIN_SCORE)
    return judged.filter(known).select(*docs.columns)


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose the lines that ten or more documents share; ``n_chars`` follows.
    A document whose lines all go stays, with empty text."""
    kept = line_dedup.dedup_lines(docs)
    changed = {"text": F.col("kept"), "n_chars": F.char_length("kept").cast("long")}
    return kept.select(*((changed[c] if c in changed else F.col(c)).alias(c) for c in docs.columns))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one row stays: the first by doc_id (nulls last).

    Rows are numbered in a written table, so that rows are told apart whatever their ids: equal and
    null ids are thinned like others, and no row goes but by its own text."""
    rows = written(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    key = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", F.col("__row").alias("row"))
    joined = ngram_join.join_documents(rows.select(key.alias("key"), "text"), id_col="key")
    kept = joined.filter(F.col("component_id.row") == F.col("key.row")).select(F.col("key.row").alias("__row"))
    return rows.join(kept, "__row", "left_semi").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    found = decontaminate.with_matches(docs, table(spark, sf_dir, "benchmark"), into="__leaks")
    return found.filter(F.size("__leaks") == 0).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces with their places in sequences of 2048 tokens."""
    return packing.pack_documents(docs, tokenizer_file("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", keep_known_languages),
    ("line_dedup", drop_common_lines),
    ("ngram_jaccard_join", keep_one_of_each_group),
    ("benchmark_decontamination", drop_contaminated),
    ("best_fit_packing", pack_sequences),
]

#: The network, the edit search and the packing aren't SQL; tests/llm holds the brute-force twin.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
