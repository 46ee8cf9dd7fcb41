"""Row-local cleaning of a stream of items. Deduplication needs the whole order and stays a batch operator."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nasaq.operators.clean import filtered
from nasaq.operators.similarity import unlike_seeds


def cleaned(stream: DataFrame, task: str, seeds: list[str] | None = None) -> DataFrame:
    """Items of a streaming (or static) frame that pass schema, length, variety and, for exams, the seed guard."""
    out = filtered(stream, task)
    return unlike_seeds(out, seeds or [], "question") if task == "exams" else out


def first_arrivals(stream: DataFrame, key: str, time: str, delay: str = "7 days") -> DataFrame:
    """Each item once although it may arrive again within the delay; state is dropped behind the watermark."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def counts_by_window(stream: DataFrame, time: str, column: str, size: str = "1 day", delay: str = "7 days") -> DataFrame:
    """Rows (window, value, n): items by event-time window and value, late ones within the delay included."""
    return stream.withWatermark(time, delay).groupBy(F.window(time, size), F.col(column).alias("value")).count().withColumnRenamed("count", "n")
