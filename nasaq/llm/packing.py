"""Filling fixed-capacity containers with documents.

Hierarchical residual packing: groups of bounded size pack best-fit decreasing, each
in its own task. Nearly full containers are done; the others go on as items, in
fewer and new groups, until one group is left or nothing is gained. A document
is split only if it exceeds the capacity by itself: its full pieces fill containers
alone, its remainder is an item.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nasaq.session import checkpointed


def best_fit(sizes: list[int], capacity: int) -> list[int]:
    """The container of each item, best-fit decreasing; sizes are from 1 to the capacity.

    Containers are found by their free space: bit f of ``free`` says that some
    container has exactly f units left.
    """
    at = [0] * len(sizes)
    free, by_space = 0, [[] for _ in range(capacity + 1)]
    n = 0
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        s = sizes[i]
        fits = free >> s
        if fits:
            space = s + ((fits & -fits).bit_length() - 1)
            c = by_space[space].pop()
            if not by_space[space]:
                free ^= 1 << space
        else:
            c, space, n = n, capacity, n + 1
        at[i] = c
        left = space - s
        if left:
            by_space[left].append(c)
            free |= 1 << left
    return at


def _pack_group(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("item", kind="stable")
    at = best_fit([int(x) for x in pdf["size"]], int(pdf["capacity"].iloc[0]))
    out = pdf[["pack_id", "item", "size", "capacity"]].reset_index(drop=True)
    out["bin"] = np.array(at, np.int64) + (int(pdf["level"].iloc[0]) << 56) + (int(pdf["grp"].iloc[0]) << 24)
    out["fill"] = out.groupby("bin")["size"].transform("sum")
    return out


def _level(items: DataFrame, level: int, groups: int) -> DataFrame:
    """Packs items (pack_id, capacity, item, size) in ``groups`` groups each; one row for each item. A bin's number holds its level, group and place."""
    grouped = items.withColumn("grp", F.pmod(F.xxhash64("pack_id", "item", F.lit(level)), F.lit(groups))).withColumn("level", F.lit(level))
    return grouped.groupBy("pack_id", "grp").applyInPandas(_pack_group, "pack_id string, item long, size long, capacity long, bin long, fill long")


def pack(sizes: DataFrame, packs: DataFrame, full: float = 0.995, group: int = 20_000, least_gain: float = 0.01) -> DataFrame:
    """Rows (pack_id, container, doc_id, piece, start, tokens): every document in a container of each pack.

    ``sizes`` has doc_id and tokens, ``packs`` pack_id and capacity_tokens (few rows;
    null or not positive capacities are left out). Documents of no tokens are in no
    container. ``start`` is the first token of the piece; container is a number. A
    container that is filled to ``full`` is done. ``group``: expected items of a group.
    Levels end when one group held all open containers, or when a level with new
    groups saved less than ``least_gain`` of the open containers: groups of
    thousands have the sizes of the whole, so more levels would not save more.
    """
    wanted = packs.where("capacity_tokens > 0 AND pack_id IS NOT NULL").groupBy("pack_id").agg(F.max("capacity_tokens").alias("capacity"))
    each = [F.struct(F.lit(r.pack_id).alias("pack_id"), F.lit(int(r.capacity)).cast("long").alias("capacity")) for r in wanted.collect()]
    if not each:
        raise ValueError("no pack with a positive capacity")
    pieces = (
        sizes.where("tokens > 0")
        .select("doc_id", "tokens", F.inline(F.array(*each)))
        .withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("tokens") - 1) / F.col("capacity")))))
        .withColumn("start", F.col("piece") * F.col("capacity"))
        .withColumn("size", F.least("capacity", F.col("tokens") - F.col("start")))
        .select("pack_id", "capacity", "doc_id", "piece", "start", "size", F.monotonically_increasing_id().alias("item"))
    )
    pieces = checkpointed(pieces)
    alone = F.col("size") == F.col("capacity")
    items = pieces.where(~alone).select("pack_id", "capacity", "item", "size")
    most = items.groupBy("pack_id").count().agg(F.max("count")).first()[0] or 0
    groups = max(1, -(-most // group))
    level, placed = 0, None
    while True:
        step = checkpointed(_level(items, level, groups))
        moved = step.select("pack_id", "item", "bin")
        if placed is None:
            placed = moved
        else:  # the container of an item is the container that its container went into; numbers alone move, and no side is broadcast
            bins = moved.select(F.col("item").alias("bin"), "pack_id", F.col("bin").alias("into")).hint("merge")
            placed = checkpointed(placed.join(bins, ["pack_id", "bin"], "left").select("pack_id", "item", F.coalesce("into", "bin").alias("bin")))
        if groups == 1:
            break
        open_bins = step.where(F.col("fill") < F.lit(full) * F.col("capacity")).groupBy("pack_id", F.col("bin").alias("item")).agg(
            F.max("capacity").alias("capacity"), F.max("fill").alias("size")
        )
        items = checkpointed(open_bins.select("pack_id", "capacity", "item", "size"))
        left = items.groupBy("pack_id").count().agg(F.max("count")).first()[0] or 0
        if not left:
            break
        groups = -(-left // group)
        if level and groups > 1:
            before, after = step.count(), step.select("pack_id", "bin").distinct().count()
            if before - after < least_gain * before:
                break
        level += 1
    joined = pieces.where(~alone).join(placed.withColumnRenamed("bin", "container").hint("merge"), ["pack_id", "item"])
    columns = ["pack_id", "container", "doc_id", "piece", "start", F.col("size").alias("tokens")]
    return joined.select(*columns).unionByName(pieces.where(alone).withColumn("container", -1 - F.col("item")).select(*columns))


def usage(packed: DataFrame, packs: DataFrame) -> DataFrame:
    """Rows (pack_id, capacity_tokens, containers, tokens, unused_share)."""
    return (
        packed.groupBy("pack_id")
        .agg(F.count_distinct("container").alias("containers"), F.sum("tokens").alias("tokens"))
        .join(packs.select("pack_id", "capacity_tokens"), "pack_id")
        .withColumn("unused_share", 1 - F.col("tokens") / (F.col("containers") * F.col("capacity_tokens")))
        .select("pack_id", "capacity_tokens", "containers", "tokens", "unused_share")
    )
