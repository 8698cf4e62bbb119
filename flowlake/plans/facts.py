"""Build the cleaned fact and its aggregate tables as lazy plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowlake.functions.columns import prepare_columns
from flowlake.operators.clean import clean, fact_columns
from flowlake.session import configure
from flowlake.sources.flows import raw_flows


def build_fact(raw: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """Raw flows -> (cleaned fact, canonical->column map of the fact)."""
    df, cols = prepare_columns(raw)
    return clean(df, cols), fact_columns(cols)


def flows_fact(spark: SparkSession, sf_dir: str,
               source: str = "events") -> tuple[DataFrame, dict[str, str]]:
    configure(spark)
    return build_fact(raw_flows(spark, sf_dir, source))


def prepared_raw(spark: SparkSession, sf_dir: str,
                 source: str = "events") -> tuple[DataFrame, dict[str, str]]:
    """Raw flows after header handling, before cleaning."""
    configure(spark)
    return prepare_columns(raw_flows(spark, sf_dir, source))
