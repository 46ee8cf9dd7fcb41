"""Connected components by alternating large and small stars.

Published method: Kiveris et al., "Connected Components in MapReduce and Beyond"
(SoCC 2014). Links stay distributed; every round halves the depth of the trees at
least, and its result is checkpointed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nasaq.functions.skew import join_unique
from nasaq.session import checkpointed


def _star(links: DataFrame, large: bool, most: int, count: int) -> DataFrame:
    """One star round over links (u, v) with u > v. The centre of a giant component has most of all links, so the join is that of
    hot keys, unless even all links (``count`` at most) would not make one."""
    ends = links if not large else links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = ends.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("degree")).select("u", F.least("u", "m").alias("m"), "degree")
    joined = join_unique(ends, least, ["u"], "degree", most) if 2 * count > most else ends.join(least.drop("degree"), "u")
    if large:
        moved = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return moved.where("u > v").distinct()


def components(links: DataFrame, most_rounds: int = 60, most: int = 1_000_000) -> DataFrame:
    """Rows (id, root) for each id that has a link; root is the least id of its component.

    ``links`` has two long columns a, b. Links of an id to itself and repeated
    links are ignored; nulls are dropped. No links give no rows. ``most``: links of an
    id above which they aren't shuffled to one task.
    """
    cur = checkpointed(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    # A star round gives each id one link to a smaller one for each that it had, and one more at most.
    seen, count = None, 2 * cur.count()
    for _ in range(most_rounds):
        cur = checkpointed(_star(_star(cur, True, most, count), False, most, 2 * count))
        now = cur.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.col("v").cast("decimal(38,0)"))
        ).first()
        if now == seen:
            break
        seen, count = now, now[0]
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return cur.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(
        cur.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct()
    )
