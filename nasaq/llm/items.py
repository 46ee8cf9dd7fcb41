"""The texts of the three item tables, as the operators on items take them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nasaq.sources.tables import table

#: Task name, table, field with the item's own text, field checked for look-alikes.
ITEMS = [
    ("exams", "exam_items", "question", "question"),
    ("sentiment", "sentiment_items", "text", "text"),
    ("grammar", "grammar_items", "input", "correction"),
]


def main_texts(spark: SparkSession, directory: str) -> DataFrame:
    """Rows (task, item_id, text) of question, text or input; an item that arrived twice has two rows."""
    return _texts(spark, directory, 2)


def output_texts(spark: SparkSession, directory: str) -> DataFrame:
    """Rows (task, item_id, text) of question, text or correction."""
    return _texts(spark, directory, 3)


def _texts(spark: SparkSession, directory: str, field: int) -> DataFrame:
    parts = [
        table(spark, directory, item[1]).select(F.lit(item[0]).alias("task"), "item_id", F.col(item[field]).alias("text"))
        for item in ITEMS
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
