"""Headerless exam CSV: id, question literal, answer, meta literal. Literals are parsed, never evaluated."""

from __future__ import annotations

import ast
import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

SCHEMA = "id string, qdict string, answer string, meta string"
META = "grade int, subject string, language string"
ARRAY = re.compile(r"array\((\[.*?\])\s*(?:,\s*dtype=object)?\s*\)", re.DOTALL)


@F.pandas_udf(StringType())
def parsed_question(qdict: pd.Series) -> pd.Series:
    """A Python literal, array(...) calls in it as lists, as Python prints it; what can't be parsed stays as it is."""

    def one(x: str) -> str:
        try:
            return str(ast.literal_eval(ARRAY.sub(r"\1", x)))
        except (ValueError, SyntaxError, MemoryError, RecursionError):
            return x

    return qdict.map(one, na_action="ignore")


@F.pandas_udf(StringType())
def _as_json(literal: pd.Series) -> pd.Series:
    """A Python literal as JSON, with None as null; what is no literal stays as it is."""

    def one(x: str) -> str:
        try:
            return json.dumps(ast.literal_eval(x), ensure_ascii=False)
        except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
            return x

    return literal.map(one, na_action="ignore")


def parsed_meta(meta: str | Column) -> Column:
    """struct(grade, subject, language) of a literal; null for None, and null fields where it can't be parsed."""
    return F.from_json(_as_json(F.col(meta) if isinstance(meta, str) else meta), META)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Rows (id, qdict, answer, grade, subject, language)."""
    if not path.endswith(".csv"):
        raise ValueError("only .csv files are read")
    raw = spark.read.schema(SCHEMA).option("quote", '"').option("escape", '"').option("multiLine", True).csv(path)
    return raw.select("id", parsed_question("qdict").alias("qdict"), "answer", parsed_meta("meta").alias("m")).select("id", "qdict", "answer", "m.*")


def write(df: DataFrame, path: str) -> None:
    """The same form again: meta packed into one literal, no header."""
    quote = lambda c: F.coalesce(F.concat(F.lit("'"), F.replace(F.replace(F.replace(F.col(c), F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'")), F.lit("\n"), F.lit("\\n")), F.lit("'")), F.lit("None"))
    meta = F.concat(F.lit("{'grade': "), F.coalesce(F.col("grade").cast("string"), F.lit("None")), F.lit(", 'subject': "), quote("subject"), F.lit(", 'language': "), quote("language"), F.lit("}"))
    df.select("id", "qdict", "answer", meta.alias("meta")).write.mode("overwrite").options(escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
