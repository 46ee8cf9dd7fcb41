"""Mixing sources to target weights.

Capped water-filling: every source gets its share of the total; one that would need
more than its repeats allow is clamped, and what it lacks goes to the others in
proportion to their shares, until nothing changes. Whole repetitions take every
document; the fractional one takes documents in a seeded random order, each if it
still fits. The order is that of a hash, cut into buckets, so the running totals
need only bucket sums and one bucket's rows, never one source's in a task.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nasaq.session import checkpointed


def water_fill(total: float, shares: dict[str, float], most: dict[str, float]) -> dict[str, float]:
    """Amounts by key: proportional to the shares, none above its most, in sum the total if that is possible."""
    shares = {k: max(0.0, v or 0.0) for k, v in shares.items()}
    out = dict.fromkeys(shares, 0.0)
    open_keys = {k for k in shares if shares[k] > 0}
    left = float(total)
    while open_keys and left > 1e-9:
        weight = sum(shares[k] for k in open_keys)
        over = {k for k in open_keys if left * shares[k] / weight >= most.get(k, 0.0)}
        if not over:
            for k in open_keys:
                out[k] = left * shares[k] / weight
            return out
        for k in over:
            out[k] = float(most.get(k, 0.0))
        open_keys -= over
        left = float(total) - sum(out.values())
    return out


def plan(targets: DataFrame, available: dict[str, int]) -> list[tuple]:
    """(mix_id, source, target_share, wanted, planned, whole, fraction_tokens, available) of each target row.

    Targets are few rows. Repeated rows of a mix and source add up their shares; a
    null share counts as 0, null repeats as 1. Shares are taken in proportion to
    their sum if that exceeds 1.
    """
    mixes: dict[str, dict[str, list]] = {}
    for r in targets.where("mix_id IS NOT NULL AND source IS NOT NULL").collect():
        row = mixes.setdefault(r.mix_id, {}).setdefault(r.source, [0.0, 0, 0])
        row[0] += r.target_share or 0.0
        row[1] = max(row[1], 1 if r.max_repeats is None else r.max_repeats)
        row[2] = max(row[2], r.total_tokens or 0)
    out = []
    for mix, rows in sorted(mixes.items()):
        total = max(v[2] for v in rows.values())
        shares = {s: v[0] for s, v in rows.items()}
        weight = max(1.0, sum(shares.values()))
        most = {s: float(available.get(s, 0) * max(0, v[1])) for s, v in rows.items()}
        amounts = water_fill(total * min(1.0, sum(shares.values())), shares, most)
        for s in sorted(rows):
            have = available.get(s, 0)
            whole = int(amounts[s] // have) if have else 0
            rest = round(amounts[s] - whole * have)
            out.append((mix, s, shares[s] / weight, round(total * shares[s] / weight), round(amounts[s]), whole, int(rest), have))
    return out


PLAN = "mix_id string, source string, target_share double, wanted_tokens long, planned_tokens long, whole int, fraction long, available_tokens long"


def _take(pdf: pd.DataFrame) -> pd.DataFrame:
    """Marks the documents of one bucket that are taken, in their order, each if it still fits."""
    pdf = pdf.sort_values(["h", "doc_id"], kind="stable")
    left, taken = int(pdf["lack"].iloc[0]), []
    for n in pdf["tokens"].tolist():
        taken.append(n <= left)
        left -= n if n <= left else 0
    return pdf[["mix_id", "source", "doc_id", "tokens", "whole"]].assign(taken=taken)


def mix(sizes: DataFrame, targets: DataFrame, seed: int = 7, bucket: int = 50_000) -> tuple[DataFrame, DataFrame]:
    """(rows, report). Rows (mix_id, doc_id, source, tokens, repeats): the documents of each mix.

    ``sizes`` has doc_id, source and tokens; documents of no tokens or no source are
    in no mix, repeated rows count each. Report: (mix_id, source, target_share,
    wanted_tokens, available_tokens, planned_tokens, reached_tokens, reached_share, met),
    met if the source reaches 99 % of what it was to give.

    A fraction takes the source's documents in their seeded order, each if it still
    fits, until none is left that does; the result doesn't depend on ``bucket``. Buckets
    are ranges of that order with about as many documents. All buckets that fit
    whole are found from their sums; in the one after them the documents are tried one
    by one, in one task; what it leaves open goes on to the buckets behind it, of which
    only smaller documents are counted. Rounds are few: a bucket leaves less open than
    its small documents have.
    """
    spark = sizes.sparkSession
    key = ["mix_id", "source"]
    named = targets.select("source").distinct()  # at most as many rows as the targets, which are few
    sizes = sizes.where("tokens > 0").join(F.broadcast(named), "source", "left_semi")
    sums = sizes.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("docs")).collect()
    rows = plan(targets, {r.source: r.tokens for r in sums})
    planned = spark.createDataFrame(rows, PLAN)
    bits = max(4, (max([r.docs for r in sums], default=0) // bucket).bit_length())
    wanted = F.broadcast(planned.where("whole > 0 OR fraction > 0").select(*key, "whole"))
    offered = (
        sizes.join(wanted, "source")
        .withColumn("h", F.xxhash64("mix_id", "doc_id", F.lit(seed)))
        .withColumn("b", F.shiftright("h", 64 - bits))
    )
    first = -(1 << 62)
    lacks = {(r[0], r[1]): r[6] for r in rows if r[6] > 0}
    after = dict.fromkeys(lacks, first)
    spans: list[tuple] = []  # (mix_id, source, after, before, most): buckets between two, of which all documents up to ``most`` are taken
    tried: list[DataFrame] = []  # buckets tried one by one
    edges: list[tuple[str, str, int]] = []
    while lacks:
        now = spark.createDataFrame([(*k, after[k], n) for k, n in lacks.items()], "mix_id string, source string, after long, lack long")
        fitting = offered.join(F.broadcast(now), key).where("tokens <= lack AND b > after")
        in_bucket = fitting.groupBy(*key, "lack", "b").agg(F.sum("tokens").alias("n"))
        before = F.sum("n").over(Window.partitionBy(*key).orderBy("b")) - F.col("n")
        ends = in_bucket.withColumn("before", before).where("before < lack").groupBy(*key).agg(F.max_by(F.struct("b", "before", "n"), "b").alias("e")).collect()
        found = {(r.mix_id, r.source): r.e for r in ends}
        open_ = {}
        for k, lack in lacks.items():
            e = found.get(k)
            if e is None:  # no document fits
                continue
            whole = e.before + e.n <= lack  # then the fraction is full or its documents are at an end
            spans.append((*k, after[k], e.b + whole, lack))
            if not whole:
                open_[k] = (e.b, lack - e.before)
        if not open_:
            break
        edges += [(*k, b) for k, (b, _) in open_.items()]
        edge = spark.createDataFrame([(*k, *x) for k, x in open_.items()], "mix_id string, source string, b long, lack long")
        one_by_one = checkpointed(
            offered.join(F.broadcast(edge), [*key, "b"]).groupBy(*key).applyInPandas(_take, "mix_id string, source string, doc_id long, tokens long, whole int, taken boolean")
        )
        tried.append(one_by_one)
        got = {(r.mix_id, r.source): r.n for r in one_by_one.where("taken").groupBy(*key).agg(F.sum("tokens").alias("n")).collect()}
        after |= {k: b for k, (b, _) in open_.items()}
        lacks = {k: n for k, (_, lack) in open_.items() if (n := lack - got.get(k, 0)) > 0}
    # The rounds of a target as one small array beside its documents: no join of documents, no shuffle.
    span = spark.createDataFrame(spans, "mix_id string, source string, after long, before long, most long")
    span = span.groupBy(*key).agg(F.collect_list(F.struct("after", "before", "most")).alias("spans"))
    done = spark.createDataFrame(edges, "mix_id string, source string, b long").groupBy(*key).agg(F.collect_list("b").alias("edges"))
    marked = offered.join(F.broadcast(span), key, "left").join(F.broadcast(done), key, "left")
    inside = F.exists("spans", lambda s: (F.col("b") > s["after"]) & (F.col("b") < s["before"]) & (F.col("tokens") <= s["most"]))
    repeats = lambda taken: (F.col("whole") + F.coalesce(taken, F.lit(False)).cast("int")).alias("repeats")
    columns = ["mix_id", "doc_id", "source", "tokens"]
    chosen = marked.where(~F.coalesce(F.array_contains("edges", F.col("b")), F.lit(False))).select(*columns, repeats(inside))
    for part in tried:
        chosen = chosen.unionByName(part.select(*columns, repeats(F.col("taken"))))
    chosen = checkpointed(chosen.where("repeats > 0"))
    reached = chosen.groupBy("mix_id", "source").agg(F.sum(F.col("tokens") * F.col("repeats")).alias("reached_tokens"))
    report = planned.join(reached, ["mix_id", "source"], "left").withColumn("reached_tokens", F.coalesce("reached_tokens", F.lit(0)))
    total = F.sum("reached_tokens").over(Window.partitionBy("mix_id"))
    report = report.withColumn("reached_share", F.when(total > 0, F.col("reached_tokens") / total).otherwise(0.0)).withColumn(
        "met", F.col("reached_tokens") >= 0.99 * F.col("wanted_tokens")
    )
    return chosen, report.select("mix_id", "source", "target_share", "wanted_tokens", "available_tokens", "planned_tokens", "reached_tokens", "reached_share", "met")
