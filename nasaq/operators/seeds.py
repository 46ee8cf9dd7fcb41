"""Seed sets: loading, style guidance and audit. A seed set has at most ten rows by default, so it may be on the driver."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from nasaq.functions.text import canonical, coarse_subject, option_pattern, preview, stable_hash, subject_hint, word_count
from nasaq.operators.sampling import order_key
from nasaq.operators.schema import valid


@dataclass(frozen=True)
class SeedLimits:
    max_seeds: int = 10
    min_seed_diversity: float = 0.8
    max_generation_similarity: float = 0.7


def draw(testset: DataFrame, task: str, key: str, limits: SeedLimits = SeedLimits(), seed: int = 0) -> DataFrame:
    """At most max_seeds items in a seeded order, of those the valid ones (so fewer may be left). Only exams have seeds."""
    drawn = testset.withColumn("_k", order_key(key, seed)).orderBy("_k", key).limit(limits.max_seeds).drop("_k")
    return drawn.where(valid(task)) if task == "exams" else drawn.limit(0)


def style(seeds: DataFrame) -> DataFrame:
    """One row (n_seeds, avg_words, subjects, option_format): mean question words cut to an integer (15 without seeds),
    the first three coarse subjects in order, the first option pattern in order."""
    patterns = F.filter(F.transform("options", option_pattern), lambda x: x.isNotNull())
    return seeds.agg(
        F.count(F.lit(1)).alias("n_seeds"),
        F.coalesce(F.floor(F.avg(word_count("question"))), F.lit(15)).cast("int").alias("avg_words"),
        F.slice(F.sort_array(F.collect_set(coarse_subject("question"))), 1, 3).alias("subjects"),
        F.try_element_at(F.sort_array(F.array_distinct(F.flatten(F.collect_list(patterns)))), F.lit(1)).alias("option_format"),
    )


def guidance(seeds: DataFrame, task: str) -> str:
    """Style guidance for a prompt; empty without seeds and for tasks other than exams."""
    row: Row = style(seeds).first() if task == "exams" else None
    if row is None or not row.n_seeds:
        return ""
    return "\n".join([
        f"Style of {row.n_seeds} seed examples:", f"- about {row.avg_words} words in the question, five more or fewer",
        f"- subjects: {', '.join(row.subjects)}", f"- option format: {row.option_format or 'A. B. C. D.'}",
        "- as hard as the seeds; copy nothing from them",
    ])


def audit_rows(seeds: DataFrame) -> DataFrame:
    """Rows (question_preview, subject_hint, hash); the hash is that of the canonical JSON, the same in every run."""
    return seeds.select(preview("question").alias("question_preview"), subject_hint("question").alias("subject_hint"), stable_hash(canonical("exams")).alias("hash"))


def write_audit(seeds: DataFrame, path: str, limits: SeedLimits = SeedLimits()) -> None:
    used = [r.asDict() for r in audit_rows(seeds).collect()]
    with open(path, "w", encoding="utf-8") as f:
        json.dump({"seed_count": len(used), "constraints": asdict(limits), "seeds_used": used}, f, ensure_ascii=False, indent=2)
