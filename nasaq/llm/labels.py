"""Category labels in one spelling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from nasaq.functions.text import normal_sentiment

#: An option label: a letter, perhaps in brackets, with a mark after it. The same to Java and to Python.
OPTION_LABEL = r"^\s*(?:\(\s*[A-Ea-e]\s*\)|\[\s*[A-Ea-e]\s*\]|[A-Ea-e]\s*[.):\-\u2013\u2014]+)\s*"
#: Other spellings of the sentiment labels.
SENTIMENT_SPELLINGS = {
    "pos": "positive", "neg": "negative", "neu": "neutral", "إيجابي": "positive", "سلبي": "negative", "محايد": "neutral", "مختلط": "mixed",
}


def option_text(option: Column) -> Column:
    """An option without its label."""
    return F.regexp_replace(option, "(?U)" + OPTION_LABEL, "")


def answer_label(column: str) -> Column:
    """A to D in upper case without white space and marks; anything else as it is, null stays null."""
    return F.upper(F.regexp_replace(F.col(column), r"[\s.()\-:]+", ""))


def sentiment_label(column: str) -> Column:
    """The label in lower case without white space around, other spellings resolved."""
    plain = normal_sentiment(column)
    spelled = F.create_map(*[F.lit(x) for kv in SENTIMENT_SPELLINGS.items() for x in kv])
    return F.coalesce(F.try_element_at(spelled, plain), plain)
