"""Records that differ only in spacing, letter case, punctuation or order of options.

Byte-identical raw rows collapse first, with their counts (a shuffle with map-side
combine, so a hot record costs each task one row). Only the distinct survivors are
made canonical, in Arrow batches. They are grouped again on their full canonical
text, summing counts. Everything after that moves 128-bit keys, no texts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nasaq.functions.skew import join_unique
from nasaq.llm.labels import OPTION_LABEL
from nasaq.llm.lookalikes import all_as_they_look
from nasaq.session import checkpointed, stored

LABEL = regex.compile(OPTION_LABEL)
NOISE = regex.compile(r"[\p{P}\s]+")


def bare(text: str) -> str:
    """A text as it looks (already rewritten), without case, punctuation and white space."""
    return NOISE.sub("", text.casefold())


def _canonical(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the canonical text of (task, parts); an unordered list of options follows the first part."""
    for batch in batches:
        lists = batch.column(batch.schema.get_field_index("parts")).to_pylist()
        flat = all_as_they_look([x for parts in lists for x in parts])
        out, at = [], 0
        for parts in lists:
            own = flat[at : at + len(parts)]
            at += len(parts)
            first = bare(own[0])
            options = sorted(bare(LABEL.sub("", x)) for x in own[1:])
            # An empty part is a blank field and makes no case.
            out.append("\x00".join([first, *options]) if first and all(options) else None)
        keep = [i for i, name in enumerate(batch.schema.names) if name != "parts"]
        yield pa.RecordBatch.from_arrays(
            [batch.column(i) for i in keep] + [pa.array(out, pa.string())],
            names=[batch.schema.names[i] for i in keep] + ["canonical"],
        )


def _full() -> list[Column]:
    """The 128-bit key of a canonical text."""
    return [F.xxhash64("task", "canonical").alias("c1"), F.xxhash64(F.lit(1), "canonical", "task").alias("c2")]


class FormattingCopies:
    """Sets of records of (task string, item_id long, parts array<string>).

    ``parts`` holds the ordered text first and then texts whose order doesn't matter.
    A row with null parts, a null or empty part, or no letter or digit in some part
    is no record here. An item that arrives again with the same content counts once. No
    rows give no sets. ``hot``: rows of a key above which they aren't shuffled to one
    task (see ``join_unique``).
    """

    def __init__(self, rows: DataFrame, hot: int = 1_000_000):
        self.hot = hot
        rows = rows.select("task", "item_id", "parts").where(
            "item_id IS NOT NULL AND size(parts) > 0 AND NOT exists(parts, x -> x IS NULL OR x = '')"
        )
        key = [F.xxhash64("task", "parts").alias("k1"), F.xxhash64(F.lit(1), "parts", "task").alias("k2")]
        #: Each record with its 128-bit raw key and the number of its arrivals.
        self.light = rows.select("task", "item_id", *key).groupBy("task", "item_id", "k1", "k2").agg(F.count(F.lit(1)).alias("arrivals"))
        raw = rows.groupBy("task", "parts").agg(F.min("item_id").alias("least"), F.count(F.lit(1)).alias("n"))
        survivors = raw.select("task", "least", "n", *key, "parts").mapInArrow(
            _canonical, "task string, least long, n long, k1 long, k2 long, canonical string"
        )
        #: One row for each distinct raw record: its count of rows, its raw key and its canonical text, made once.
        self.survivors = stored(survivors.where("canonical IS NOT NULL"), "canonical")
        sets = self.survivors.groupBy("task", "canonical").agg(
            F.min("least").alias("keep_id"), F.sum("n").alias("rows"), F.count(F.lit(1)).alias("raw")
        )
        #: One row for each set: its key, smallest id, rows, counted over its raw records, and their number. The last step that moves texts, done once.
        self.sets = stored(sets.select(*_full(), "task", "keep_id", "rows", "raw"), "sets")

    def _keys(self, sets: DataFrame) -> DataFrame:
        """Rows (k1, k2, keep_id, n): the smallest id of the set of each distinct raw record, and the rows of that record."""
        raw = self.survivors.select("k1", "k2", "n", *_full())
        keys = join_unique(raw, sets.select("c1", "c2", "keep_id", "raw"), ["c1", "c2"], "raw", self.hot)
        return checkpointed(keys.select("k1", "k2", "keep_id", "n"))

    def members(self) -> DataFrame:
        """Rows (task, item_id, keep_id): each record with the smallest id of its set."""
        return join_unique(self.light, self._keys(self.sets), ["k1", "k2"], "n", self.hot).select("task", "item_id", "keep_id")

    def copies(self) -> DataFrame:
        """Rows (task, keep_id, copy_id): each record that is not the smallest id of its set."""
        keys = self._keys(self.sets.where("rows > 1"))
        found = join_unique(self.light, keys, ["k1", "k2"], "n", self.hot).where("item_id <> keep_id")
        return found.select("task", "keep_id", F.col("item_id").alias("copy_id")).distinct()

    def collapsed(self) -> DataFrame:
        """Rows (task, keep_id, n_copies): one row for each set, with its number of records: the counts of its raw
        records summed up, less the further arrivals of the same items, which are few."""
        sets = self.sets
        again = self.light.where("arrivals > 1")
        again = join_unique(again, self._keys(sets), ["k1", "k2"], "n", self.hot).groupBy("task", "keep_id").agg(F.sum(F.col("arrivals") - 1).alias("again"))
        return sets.join(again, ["task", "keep_id"], "left").select(
            "task", "keep_id", (F.col("rows") - F.coalesce("again", F.lit(0))).alias("n_copies")
        )
