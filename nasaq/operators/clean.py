"""Cleaning: schema, length and variety filters, then fuzzy deduplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nasaq.functions.text import canonical, text_of, type_token_ratio, word_count
from nasaq.operators.schema import valid
from nasaq.operators.similarity import fuzzy_keep

#: Word limits, inclusive, of the field that counts; least type-token ratio; least similarity of duplicates.
LENGTHS = {"sentiment": ("text", 20, 70), "exams": ("question", 5, 60), "grammar": ("input", 3, 60)}
LEAST_VARIETY = 0.18
DUPLICATE = 0.93


def length_ok(task: str) -> Column:
    """Whether the words of the item are within its task's limits; true for other tasks, null counts as no words."""
    if task not in LENGTHS:
        return F.lit(True)
    field, low, high = LENGTHS[task]
    return word_count(field).between(low, high)


def variety_ok(task: str, least: float = LEAST_VARIETY) -> Column:
    """Whether the type-token ratio is at least ``least``; false without words, true for grammar."""
    if task not in ("exams", "sentiment"):
        return F.lit(True)
    text = text_of(F.col("text"), F.lit(None)) if task == "sentiment" else text_of(F.lit(None), F.col("question"))
    return F.coalesce(type_token_ratio(text) >= F.lit(least), F.lit(False))


def filtered(items: DataFrame, task: str) -> DataFrame:
    """Items that pass schema, length and variety; other columns ride along."""
    return items.where(valid(task) & length_ok(task) & variety_ok(task))


def clean(items: DataFrame, task: str, order: str) -> DataFrame:
    """The filtered items without fuzzy duplicates of an earlier kept one, by the unique column ``order``.

    Generated exams that were ``remapped`` have no field notes, which counts in the comparison.
    """
    without_notes = F.col("remapped") if "remapped" in items.columns else None
    kept = filtered(items, task).withColumn("_canonical", canonical(task, without_notes))
    return fuzzy_keep(kept, order, "_canonical", DUPLICATE).drop("_canonical")
