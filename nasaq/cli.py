"""Command line: generate, augment, clean, evaluate and export over JSON lines."""

from __future__ import annotations

import argparse
import json
import os
from pathlib import Path

from pyspark.sql import functions as F

from nasaq.functions.text import canonical
from nasaq.operators import augment as _augment
from nasaq.operators import clean as _clean
from nasaq.operators import generate as _generate
from nasaq.operators import report, seeds
from nasaq.operators.generate import SCHEMAS
from nasaq.operators.schema import valid_json
from nasaq.operators.similarity import fuzzy_keep
from nasaq.session import local_session
from nasaq.sources import jsonl


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="nasaq")
    verbs = p.add_subparsers(dest="verb", required=True)
    g = verbs.add_parser("generate")
    g.add_argument("task")
    g.add_argument("--num-samples", type=int, default=100)
    g.add_argument("--model", default="mock", help="mock, or openai:NAME")
    g.add_argument("--batch-size", type=int, default=50, help="accepted for compatibility; Spark decides")
    g.add_argument("--persona")
    g.add_argument("--seed-file")
    g.add_argument("--temperature", type=float, default=0.7)
    g.add_argument("--top-p", type=float, default=0.95)
    g.add_argument("--answer-shares", help="target shares of the answers, as A=0.4,B=0.3,C=0.2,D=0.1")
    g.add_argument("--out-path")
    a = verbs.add_parser("augment")
    a.add_argument("task")
    a.add_argument("--in-path", default="outputs/raw.jsonl")
    a.add_argument("--out-path", default="outputs/augmented.jsonl")
    a.add_argument("--num-variants", type=int, default=2)
    c = verbs.add_parser("clean")
    c.add_argument("task")
    c.add_argument("--in-path", default="outputs/raw.jsonl")
    c.add_argument("--out-path", default="outputs/clean.jsonl")
    e = verbs.add_parser("evaluate")
    e.add_argument("task")
    e.add_argument("--in-path", default="outputs/clean.jsonl")
    x = verbs.add_parser("export")
    x.add_argument("task")
    x.add_argument("--in-path", default="outputs/clean.jsonl")
    x.add_argument("--out-format", default="jsonl")
    x.add_argument("--meta-task-name")
    x.add_argument("--meta-persona")
    x.add_argument("--meta-batch-id")
    x.add_argument("--out-dir", default="outputs")
    return p


def clean_lines(spark, path: str, task: str):
    """The lines (row_ix, value) of a file that cleaning keeps, unknown keys and all."""
    rows = jsonl.lines(spark, path).where(valid_json(task))
    typed = rows.select("row_ix", "value", F.from_json("value", SCHEMAS.get(task, "x string")).alias("r")).select("row_ix", "value", "r.*")
    if task not in SCHEMAS:
        return rows.limit(0)
    kept = typed.where(_clean.length_ok(task) & _clean.variety_ok(task)).withColumn("_c", jsonl.canonical_line("value"))
    return fuzzy_keep(kept, "row_ix", "_c", _clean.DUPLICATE).select("row_ix", "value")


def augmented_lines(spark, path: str, task: str, variants: int):
    """Rows (row_ix, variant_no, value): each line and its variants. A variant is its line with the changed fields put over
    it, so unknown keys ride along; variants of a sentiment line have text and label only."""
    if task not in SCHEMAS:
        return jsonl.lines(spark, path).select("row_ix", F.lit(0).alias("variant_no"), jsonl.plain_line("value").alias("value"))
    out = _augment.augment(jsonl.read(spark, path, SCHEMAS[task]), task, "row_ix", variants)
    changed = {"exams": ["question", "options", "answer"], "sentiment": ["text", "sentiment"], "grammar": ["input", "correction"]}[task]
    changes = F.when(F.col("variant_no") == 0, F.lit("{}")).otherwise(F.to_json(F.struct(*changed), {"ignoreNullFields": "false"}))
    return out.select("row_ix", "variant_no", jsonl.patched("_line", changes).alias("value"))


def load_env(path: str = ".env") -> None:
    """Sets the variables that a file of lines NAME=VALUE names, unless they are set; no file sets nothing."""
    if not os.path.isfile(path):
        return
    with open(path, encoding="utf-8") as f:
        for line in f:
            name, is_one, value = line.strip().removeprefix("export ").partition("=")
            if is_one and not name.startswith("#"):
                os.environ.setdefault(name.strip(), value.strip().strip("\"'"))


def exists(spark, path: str) -> bool:
    """Whether the path is there, in whatever file system it names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def shares_of(text: str | None) -> dict[str, float] | None:
    """A=0.4,B=0.3 as a dictionary."""
    return {k.strip(): float(v) for k, v in (x.split("=") for x in text.split(","))} if text else None


def at(path: str) -> str:
    """A path without a scheme is relative to the working directory, whatever the JVM's is."""
    return path if "://" in path else os.path.abspath(path)


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    load_env()
    spark = local_session()
    if args.verb == "generate":
        drawn, texts, guide = None, [], ""
        if args.seed_file and exists(spark, at(args.seed_file)):
            drawn = seeds.draw(jsonl.read(spark, at(args.seed_file), SCHEMAS["exams"]), args.task, "row_ix")
            texts = [r.question for r in drawn.select("question").collect()]
            guide = seeds.guidance(drawn, args.task)
            if texts:
                Path("outputs").mkdir(parents=True, exist_ok=True)
                seeds.write_audit(drawn, f"outputs/{args.task}_seeds_audit.json")
        provider = _generate.chat_provider(args.model.split(":", 1)[1], args.temperature, args.top_p) if args.model.startswith("openai:") else None
        made = _generate.generate(spark, args.task, args.num_samples, provider, args.persona, guide, texts, shares_of(args.answer_shares))
        line = canonical(args.task, F.col("remapped") if args.task == "exams" else None)
        made.orderBy("slot").select(line.alias("value")).write.mode("overwrite").text(at(args.out_path or f"outputs/{args.task}_raw.jsonl"))
    elif args.verb == "augment":
        augmented_lines(spark, at(args.in_path), args.task, args.num_variants).orderBy("row_ix", "variant_no").select("value").write.mode("overwrite").text(at(args.out_path))
    elif args.verb == "clean":
        kept = clean_lines(spark, at(args.in_path), args.task).orderBy("row_ix").select(jsonl.plain_line("value").alias("value"))
        kept.write.mode("overwrite").text(at(args.out_path))
    elif args.verb == "evaluate":
        print(json.dumps(report.evaluation(jsonl.read(spark, at(args.in_path), SCHEMAS[args.task]), args.task), ensure_ascii=False, indent=2))
    else:
        target = f"{at(args.out_dir)}/{args.task}.{args.out_format}"
        jsonl.export(spark, at(args.in_path), target, args.out_format, args.meta_task_name or args.task, args.meta_persona, args.meta_batch_id)


if __name__ == "__main__":
    main()
