"""Schema validation as a predicate: a row is kept or dropped, never changed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from nasaq.functions.text import normal_sentiment

TASKS = ("exams", "sentiment", "grammar")


def check_task(task: str) -> None:
    if task not in TASKS:
        raise ValueError(f"unknown task: {task}")


def valid(task: str) -> Column:
    """Whether an item in typed columns fits its schema; false for null in a required field and for an unknown task.

    exams: question, exactly four options, none null, answer A to D without trimming.
    sentiment: text, label positive, negative or neutral after trimming and lower case.
    grammar: input, correction, explanation. Empty strings are valid.
    """
    if task == "exams":
        options = (F.size("options") == 4) & ~F.exists("options", lambda x: x.isNull())
        return F.coalesce(F.col("question").isNotNull() & options & F.col("answer").isin("A", "B", "C", "D"), F.lit(False))
    if task == "sentiment":
        return F.coalesce(F.col("text").isNotNull() & normal_sentiment("sentiment").isin("positive", "negative", "neutral"), F.lit(False))
    if task == "grammar":
        return F.col("input").isNotNull() & F.col("correction").isNotNull() & F.col("explanation").isNotNull()
    return F.lit(False)


def valid_json(task: str, line: str = "value") -> Column:
    """Whether a line is a JSON object of the task, with strict types: numbers are no strings, a mixed list is no list of
    strings. A line that isn't JSON, or has a key twice, is not valid."""
    v = F.try_parse_json(F.col(line))

    def kind(field: str) -> Column:
        return F.schema_of_variant(F.try_variant_get(v, f"$.{field}", "variant"))

    def text(field: str) -> Column:
        return F.try_variant_get(v, f"$.{field}", "string")

    if task == "exams":
        notes = F.coalesce(kind("notes").isin("STRING", "VOID"), F.lit(True))
        options = (kind("options") == "ARRAY<STRING>") & (F.size(F.try_variant_get(v, "$.options", "array<string>")) == 4)
        ok = (kind("question") == "STRING") & options & (kind("answer") == "STRING") & text("answer").isin("A", "B", "C", "D") & notes
    elif task == "sentiment":
        label = normal_sentiment(text("sentiment"))
        ok = (kind("text") == "STRING") & (kind("sentiment") == "STRING") & label.isin("positive", "negative", "neutral")
    elif task == "grammar":
        ok = (kind("input") == "STRING") & (kind("correction") == "STRING") & (kind("explanation") == "STRING")
    else:
        return F.lit(False)
    return F.coalesce(ok, F.lit(False))
