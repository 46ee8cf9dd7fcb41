"""Parquet tables of a data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """The table ``name``; Parquet gives column pruning and pushed filters."""
    return spark.read.parquet(f"{directory}/{name}.parquet")


def records(df: DataFrame, key: str) -> DataFrame:
    """One row for each key: of a record that arrived again, the first arrival.

    Ties in ``loaded_at`` are rows of equal content, so any of them may stay.
    """
    rest = [c for c in df.columns if c != key]
    order = F.coalesce(F.col("loaded_at"), F.lit("9999-12-31").cast("timestamp"))
    return (
        df.groupBy(key)
        .agg(F.min_by(F.struct(*rest), F.struct(order)).alias("r"))
        .select(key, *[F.col(f"r.{c}").alias(c) for c in rest])
    )
