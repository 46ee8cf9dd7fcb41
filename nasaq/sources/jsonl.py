"""JSON lines in and out; a file's order of lines is kept as a column."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from nasaq.functions.text import strip


def lines(spark: SparkSession, path: str) -> DataFrame:
    """Rows (row_ix, value): stripped lines that aren't blank, numbered in the order of files and lines.

    Numbers rise with gaps: the place of the split in the file order, then the line
    in the split. Splits are few; only they go through the driver.
    """
    text = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("s"), F.monotonically_increasing_id().alias("m"))
    places = sorted((r.f, r.s) for r in text.select("f", "s").distinct().collect())
    if not places:
        return spark.createDataFrame([], "row_ix long, value string")
    place = spark.createDataFrame([(f, s, i) for i, (f, s) in enumerate(places)], "f string, s long, place long")
    numbered = text.join(F.broadcast(place), ["f", "s"]).withColumn("row_ix", F.shiftleft(F.col("place"), 36) + F.col("m").bitwiseAND((1 << 33) - 1))
    return numbered.select("row_ix", strip("value").alias("value")).where(F.length("value") > 0)


def read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Typed rows and row_ix; a line that isn't JSON fails the read, a field of another type is null."""
    parsed = lines(spark, path).select("row_ix", "value", F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r"))
    return parsed.select("row_ix", "r.*", F.col("value").alias("_line"))


@F.pandas_udf(StringType())
def canonical_line(line: pd.Series) -> pd.Series:
    """A line of JSON as sorted-key canonical JSON, whatever its keys are."""
    return line.map(lambda x: json.dumps(json.loads(x), ensure_ascii=False, sort_keys=True), na_action="ignore")


@F.pandas_udf(StringType())
def plain_line(line: pd.Series) -> pd.Series:
    """A line of JSON with its keys in their order, other scripts unescaped."""
    return line.map(lambda x: json.dumps(json.loads(x), ensure_ascii=False), na_action="ignore")


def write(df: DataFrame, path: str) -> None:
    """A directory of JSON lines, nulls kept."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def export(spark: SparkSession, source: str, target: str, form: str, task: str, persona: str | None = None, batch_id: str | None = None) -> None:
    """Copies JSON lines with metadata fields _task, _persona and _batch_id (the last two only if given) as jsonl or csv.

    Rows keep their order. A CSV's columns are all keys in the order in which they are
    seen first; lists, objects and truth values are written as Python prints them,
    null and a missing key as nothing.
    """
    if form not in ("jsonl", "csv"):
        raise ValueError("the format must be jsonl or csv")
    extra = {"_task": task} | ({"_persona": persona} if persona else {}) | ({"_batch_id": batch_id} if batch_id else {})
    rows = lines(spark, source)
    if form == "jsonl":
        @F.pandas_udf(StringType())
        def with_extra(line: pd.Series) -> pd.Series:
            return line.map(lambda x: json.dumps(json.loads(x) | extra, ensure_ascii=False), na_action="ignore")

        rows.sort("row_ix").select(with_extra("value")).write.mode("overwrite").text(target)
        return
    keys = [*_keys(rows), *[k for k in extra]]
    keys = list(dict.fromkeys(keys))

    @F.pandas_udf(ArrayType(StringType()))
    def cells(line: pd.Series) -> pd.Series:
        def shown(v: object) -> str | None:
            return v if v is None or isinstance(v, str) else str(v)

        return line.map(lambda x: [shown((json.loads(x) | extra).get(k)) for k in keys])

    table = rows.sort("row_ix").select(cells("value").alias("c")).select(*[F.col("c")[i].alias(k) for i, k in enumerate(keys)])
    table.write.mode("overwrite").options(header=True, escape='"', emptyValue="", nullValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(target)


def _keys(rows: DataFrame) -> list[str]:
    """The keys of all lines in the order in which they are seen first. As many rows as keys reach the driver."""
    seen = rows.select("row_ix", F.posexplode(F.json_object_keys("value")).alias("at", "k"))
    firsts = seen.groupBy("k").agg(F.min(F.struct("row_ix", "at")).alias("first"))
    return [r.k for r in firsts.orderBy("first").collect()]


@F.pandas_udf(StringType())
def patched(line: pd.Series, changes: pd.Series) -> pd.Series:
    """A line of JSON with the fields of another one put over its own; other keys and their order stay. A null line is an empty object."""
    return pd.Series([json.dumps((json.loads(a) if a else {}) | json.loads(b), ensure_ascii=False) for a, b in zip(line, changes, strict=True)])
