"""Samples that match target category proportions.

Systematic unequal-probability sampling: rows are in random order within sorted
categories, their inclusion probabilities are summed up along that order, and a row
is taken when the sum passes an integer, counted from one random start. Floors are
repaired afterwards. Order and sums come from hash buckets: bucket counts give
the offsets, a window inside a bucket the rank, so no category is ever in one task.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nasaq.llm.mixing import water_fill
from nasaq.session import checkpointed


def plan(targets: DataFrame, available: dict[tuple[str, str], int]) -> list[tuple]:
    """(sample_id, task, category, target_share, min_rows, available, goal, offset) of each target row, goal a real number.

    Goals sum up to sample_rows if enough rows exist: the size comes before the shares, so
    where too few rows of a category exist, the others exceed their shares and the
    report says so. A category gets its share, not
    less than its floor and not more than it has; what it lacks or takes beyond its
    share is spread over the others in proportion. offset: the sum of goals of the
    sorted categories before. Null shares and floors count as 0.
    """
    samples: dict[tuple[str, str], dict[str, list]] = {}
    for r in targets.where("sample_id IS NOT NULL AND category IS NOT NULL").collect():
        row = samples.setdefault((r.sample_id, r["_task"]), {}).setdefault(r.category, [0.0, 0, 0])
        row[0] += r.target_share or 0.0
        row[1] = max(row[1], r.min_rows or 0)
        row[2] = max(row[2], r.sample_rows or 0)
    out = []
    for (sample, task), rows in sorted(samples.items(), key=str):
        size = max(v[2] for v in rows.values())
        have = {c: available.get((task, c), 0) for c in rows}
        goals: dict[str, float] = {}
        floored: dict[str, float] = {}
        while True:  # categories below their floor are set to it, the rest shares what is left
            rest = {c: rows[c][0] for c in rows if c not in floored}
            goals = floored | water_fill(max(0.0, size - sum(floored.values())), rest, {c: float(have[c]) for c in rest})
            low = {c: float(min(rows[c][1], have[c])) for c in rest if goals[c] < min(rows[c][1], have[c])}
            if not low:
                break
            floored |= low
        offset = 0.0
        for c in sorted(rows):
            out.append((sample, task, c, rows[c][0], rows[c][1], size, have[c], goals[c], offset))
            offset += goals[c]
    return out


PLAN = "sample_id string, task string, category string, target_share double, min_rows int, sample_rows int, available long, goal double, offset double"


def start_of(sample: str, seed: int) -> float:
    """The random start of a sample, in [0, 1)."""
    return int.from_bytes(hashlib.sha256(f"{seed}:{sample}".encode()).digest()[:6], "big") / 2**48


def sample(items: DataFrame, targets: DataFrame, seed: int = 7, bucket: int = 50_000) -> tuple[DataFrame, DataFrame]:
    """(rows, report). Rows (sample_id, task, category, item_id): the items of each sample.

    ``items`` has task, item_id, category; null ids or categories are in no sample, an
    item that arrives again counts once. Report: (sample_id, task, category,
    target_share, min_rows, available, wanted_rows, taken_rows, taken_share,
    share_met, floor_met).
    """
    spark = items.sparkSession
    named = targets.select(F.col("_task").alias("task"), "category").distinct()
    items = items.where("item_id IS NOT NULL").join(named, ["task", "category"], "left_semi")
    items = items.groupBy("task", "item_id").agg(F.min("category").alias("category"))
    items = checkpointed(items)
    counts = {(r.task, r.category): r["count"] for r in items.groupBy("task", "category").count().collect()}
    planned = spark.createDataFrame(plan(targets, counts), PLAN)
    buckets = max(16, -(-max(counts.values(), default=0) // bucket))
    starts = {r.sample_id: start_of(r.sample_id, seed) for r in planned.select("sample_id").distinct().collect()}
    start = F.element_at(F.create_map(*[F.lit(x) for kv in starts.items() for x in kv]), F.col("sample_id")) if starts else F.lit(0.0)
    rows = (
        items.join(F.broadcast(planned.where("goal > 0")), ["task", "category"])
        .withColumn("h", F.xxhash64("sample_id", "item_id", F.lit(seed)))
        .withColumn("b", F.pmod("h", F.lit(buckets)))
    )
    keys = ["sample_id", "task", "category"]
    sizes = rows.groupBy(*keys, "b").agg(F.count(F.lit(1)).alias("in_bucket"))
    sizes = sizes.withColumn("before", F.sum("in_bucket").over(Window.partitionBy(*keys).orderBy("b")) - F.col("in_bucket"))
    ranked = rows.join(sizes, [*keys, "b"]).withColumn(
        "rank", F.col("before") + F.row_number().over(Window.partitionBy(*keys, "b").orderBy("h", "item_id"))
    )
    pi = F.col("goal") / F.col("available")
    passed = lambda k: F.floor(F.col("offset") + k * pi + start + F.lit(1e-9))
    ranked = ranked.withColumn("crossed", passed(F.col("rank")) > passed(F.col("rank") - 1))
    # Only rows that are taken, and the first other one of each bucket, which may repair a floor, go on.
    first = F.min(F.when(~F.col("crossed"), F.col("rank"))).over(Window.partitionBy(*keys, "b"))
    ranked = ranked.withColumn("first", first).where("crossed OR rank = first").select(*keys, "item_id", "b", "rank", "crossed")
    ranked = checkpointed(ranked)
    # Rounding can leave a category one row under its floor; its first rows that weren't taken repair that.
    taken = ranked.where("crossed").groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    short = planned.join(taken, keys, "left").select(
        *keys, (F.least("available", F.col("min_rows").cast("long")) - F.coalesce("n", F.lit(0))).alias("lacks")
    ).where("lacks > 0")
    spare = ranked.where("NOT crossed").join(F.broadcast(short), keys)
    # At most ``lacks`` rows of each category: the least ranks, found with map-side heaps.
    spare = spare.groupBy(*keys, "b").agg(F.min("rank").alias("first")).join(F.broadcast(short), keys)
    chosen = ranked.where("crossed").select(*keys, "item_id")
    ends = Window.partitionBy(*keys).orderBy("first")
    allowed = spare.withColumn("r", F.row_number().over(ends)).where("r <= lacks").select(*keys, F.col("first").alias("rank"))
    repaired = ranked.join(allowed, [*keys, "rank"]).select(*keys, "item_id")
    chosen = checkpointed(chosen.unionByName(repaired))
    got = chosen.groupBy(*keys).agg(F.count(F.lit(1)).alias("taken_rows"))
    report = planned.join(got, keys, "left").withColumn("taken_rows", F.coalesce("taken_rows", F.lit(0)))
    report = report.withColumn("taken_share", F.col("taken_rows") / F.sum("taken_rows").over(Window.partitionBy("sample_id")))
    report = report.withColumn("wanted_rows", F.col("target_share") * F.col("sample_rows"))
    return chosen, report.select(
        *keys, "target_share", "min_rows", "available", "wanted_rows", "taken_rows", "taken_share",
        (F.abs(F.col("taken_rows") - F.col("wanted_rows")) < 1.0 + 1e-6).alias("share_met"),
        (F.col("taken_rows") >= F.col("min_rows")).alias("floor_met"),
    )
