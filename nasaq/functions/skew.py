"""Joins in which one key may hold a large part of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_unique(rows: DataFrame, unique: DataFrame, on: list[str], size: str, most: int = 1_000_000, keys: int = 10_000) -> DataFrame:
    """Inner join with a side of one row for each key, whose column ``size`` says how many ``rows`` have the key (or more).

    A key of more than ``most`` rows and more than one in ``keys`` of all rows is hot.
    There are fewer than ``keys`` such keys at any size of the input, so their rows of
    ``unique`` are broadcast and the hot rows stay where they are; the others
    are shuffled. Without hot keys it is a plain join. ``size`` isn't in the result.
    """
    top, total = unique.agg(F.max(size), F.sum(size)).first()
    limit = max(most, (total or 0) // keys)
    rest = unique.drop(size)
    if (top or 0) <= limit:
        return rows.join(rest, on)
    hot = F.broadcast(unique.where(F.col(size) > limit))
    cold = rows.join(hot.select(*on), on, "left_anti").join(unique.where(F.col(size) <= limit).drop(size), on)
    return rows.join(hot.drop(size), on).unionByName(cold)
