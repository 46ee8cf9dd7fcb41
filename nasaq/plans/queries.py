"""Queries of the core operators over the test tables, each over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nasaq.functions import text as T
from nasaq.operators import augment as A
from nasaq.operators import clean as C
from nasaq.operators import generate as G
from nasaq.operators import report as R
from nasaq.operators import sampling as S
from nasaq.operators import schema as V
from nasaq.operators import seeds as D
from nasaq.operators import similarity as M
from nasaq.operators import tstr
from nasaq.session import shared_dir
from nasaq.sources import exam_csv, jsonl
from nasaq.sources.exam_csv import parsed_meta
from nasaq.sources.tables import records, table

Query = Callable[[SparkSession, str], DataFrame]
_ALL: dict[str, Query] = {}
TABLES = {"exams": "exam_items", "sentiment": "sentiment_items", "grammar": "grammar_items"}
MAIN = {"exams": "question", "sentiment": "text", "grammar": "input"}


def query(f: Query) -> Query:
    _ALL[f.__name__] = f
    return f


def items(spark: SparkSession, d: str, task: str) -> DataFrame:
    return table(spark, d, TABLES[task])


def each_task(make: Callable[[str], DataFrame]) -> DataFrame:
    a, b, c = (make(t).withColumn("task", F.lit(t)) for t in TABLES)
    return a.unionByName(b).unionByName(c)


@query
def word_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", T.word_count("text").alias("words"))


@query
def type_token_ratios(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", T.type_token_ratio("text").alias("ttr"))


@query
def schema_validate(spark: SparkSession, d: str) -> DataFrame:
    return each_task(lambda t: items(spark, d, t).groupBy(V.valid(t).alias("valid")).agg(F.count(F.lit(1)).alias("n")))


@query
def json_schema_validate(spark: SparkSession, d: str) -> DataFrame:
    # A fifth of the lines is malformed or of the wrong types: cut short, a number as the first text, a list as a text, a field left out.
    def made(t: str) -> DataFrame:
        line, broken = T.canonical(t), F.pmod("item_id", F.lit(20))
        first = {"exams": "question", "sentiment": "text", "grammar": "input"}[t]
        field = F.concat(F.lit(f'"{first}": '), T.json_string(first))
        wrong = F.when(broken == 0, F.substring(line, F.lit(1), F.length(line) - 1))
        wrong = wrong.when(broken == 1, F.replace(line, field, F.lit(f'"{first}": 5'))).when(broken == 2, F.replace(line, field, F.lit(f'"{first}": ["x"]')))
        wrong = wrong.when(broken == 3, F.replace(line, F.lit(f'"{first}"'), F.lit('"other"'))).otherwise(line)
        return items(spark, d, t).select("item_id", wrong.alias("value"))

    return each_task(lambda t: made(t).groupBy(V.valid_json(t).alias("valid")).agg(F.count(F.lit(1)).alias("n")))


@query
def length_filter(spark: SparkSession, d: str) -> DataFrame:
    return each_task(lambda t: items(spark, d, t).where(C.length_ok(t)).select("item_id", T.word_count(MAIN[t]).alias("words")))


@query
def ttr_filter(spark: SparkSession, d: str) -> DataFrame:
    return each_task(lambda t: items(spark, d, t).where(C.variety_ok(t)).select("item_id"))


@query
def length_ttr_clean(spark: SparkSession, d: str) -> DataFrame:
    return each_task(
        lambda t: C.filtered(items(spark, d, t), t).agg(F.count(F.lit(1)).alias("kept"), F.avg(T.word_count(MAIN[t])).alias("avg_words"))
    )


@query
def canonical_json(spark: SparkSession, d: str) -> DataFrame:
    return each_task(lambda t: items(spark, d, t).select("item_id", T.canonical(t).alias("canonical")))


@query
def extract_fenced_json(spark: SparkSession, d: str) -> DataFrame:
    body = T.canonical("grammar")
    kind = F.pmod("item_id", F.lit(3))
    raw = F.when(kind == 0, F.concat(F.lit("Here:\n```json\n"), body, F.lit("\n```\nDone."))).when(
        kind == 1, F.concat(F.lit("Answer: "), body, F.lit(" ok"))
    ).otherwise(F.col("explanation"))
    return items(spark, d, "grammar").select("item_id", T.json_of_answer(raw).alias("extracted"))


@query
def subject_hint(spark: SparkSession, d: str) -> DataFrame:
    return items(spark, d, "exams").select("item_id", T.subject_hint("question").alias("hint"), T.coarse_subject("question").alias("coarse"))


@query
def option_patterns(spark: SparkSession, d: str) -> DataFrame:
    each = items(spark, d, "exams").select(F.explode("options").alias("o")).select(T.option_pattern("o").alias("pattern"))
    return each.where("pattern IS NOT NULL").groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))


@query
def anonymize(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", T.anonymise("text").alias("anonymous"))


@query
def paraphrase(spark: SparkSession, d: str) -> DataFrame:
    return items(spark, d, "sentiment").select("item_id", T.paraphrase("text").alias("paraphrased"))


@query
def entity_replace(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", T.replace_entities("text", F.col("doc_id"), 5).alias("replaced"))


@query
def metadata_noise(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("doc_id")
    return table(spark, d, "documents").select(
        "doc_id", T.noisy_number(F.col("n_chars").cast("double"), k, "n_chars", 3).alias("noisy_chars"), T.shuffled_text("source", k, 3).alias("noisy_source")
    )


@query
def option_shuffle(spark: SparkSession, d: str) -> DataFrame:
    new = A.shuffled_options(F.col("options"), F.col("answer"), F.col("item_id"), 1)
    return items(spark, d, "exams").where("size(options) = 4").select("item_id", new["options"].alias("options"), new["answer"].alias("answer"))


def _augmented(spark: SparkSession, d: str, task: str, fields: list[str]) -> DataFrame:
    return A.augment(items(spark, d, task), task, "item_id").select("item_id", "variant_no", *fields)


@query
def augment_sentiment(spark: SparkSession, d: str) -> DataFrame:
    return _augmented(spark, d, "sentiment", ["text", "sentiment"])


@query
def augment_exams(spark: SparkSession, d: str) -> DataFrame:
    return _augmented(spark, d, "exams", ["question", "options", "answer"])


@query
def augment_grammar(spark: SparkSession, d: str) -> DataFrame:
    return _augmented(spark, d, "grammar", ["input", "correction", "explanation"])


@query
def remap_answer(spark: SparkSession, d: str) -> DataFrame:
    target = F.substring(F.lit("ABCD"), (F.pmod("item_id", F.lit(4)) + 1).cast("int"), F.lit(1))
    new = G.remapped(F.col("question"), F.col("options"), F.col("answer"), target)
    return items(spark, d, "exams").where("size(options) = 4 AND answer IS NOT NULL").select("item_id", new["options"].alias("options"), new["answer"].alias("answer"))


@query
def quota_schedule(spark: SparkSession, d: str) -> DataFrame:
    return S.schedule(spark, 1000, {"A": 0.4, "B": 0.3, "C": 0.2, "D": 0.1})


@query
def mock_generate(spark: SparkSession, d: str) -> DataFrame:
    return G.generate(spark, "exams", 40).select("slot", "question", "options", "answer")


@query
def uniform_sample(spark: SparkSession, d: str) -> DataFrame:
    return S.uniform(records(items(spark, d, "exams"), "item_id").select("item_id", "subject"), "item_id", 100, 11)


@query
def stratified_sample(spark: SparkSession, d: str) -> DataFrame:
    return S.stratified(records(items(spark, d, "exams"), "item_id").select("item_id", "subject"), "item_id", 100, "subject", 11, strict=False)


def _seeds(spark: SparkSession, d: str) -> DataFrame:
    return D.draw(table(spark, d, "eval_items"), "exams", "test_id")


@query
def style_guidance(spark: SparkSession, d: str) -> DataFrame:
    return D.style(_seeds(spark, d))


@query
def seed_audit(spark: SparkSession, d: str) -> DataFrame:
    return D.audit_rows(_seeds(spark, d))


@query
def seed_leakage_guard(spark: SparkSession, d: str) -> DataFrame:
    seeds = [r.question for r in _seeds(spark, d).select("question").collect()]
    return M.unlike_seeds(items(spark, d, "exams"), seeds, "question", 0.2).select("item_id")


@query
def seed_guard_default(spark: SparkSession, d: str) -> DataFrame:
    seeds = [r.question for r in _seeds(spark, d).select("question").collect()]
    # Beside the items, each seed with a word more (too near) and each with its words but two (near enough to be taken).
    texts = items(spark, d, "exams").select("item_id", "question")
    made = _seeds(spark, d).select("test_id", "question", T.tokens("question").alias("w"))
    near = made.select((-F.col("test_id") - 1).alias("item_id"), F.concat("question", F.lit(" more")).alias("question"))
    far = made.select((-F.col("test_id") - 100_001).alias("item_id"), F.array_join(F.slice("w", F.lit(1), F.greatest(F.lit(1), F.floor(F.size("w") * F.lit(0.5)).cast("int"))), " ").alias("question"))
    return M.unlike_seeds(texts.unionByName(near).unionByName(far), seeds, "question").select("item_id")


@query
def nearest_real_overlap(spark: SparkSession, d: str) -> DataFrame:
    return M.nearest(items(spark, d, "exams"), "item_id", "question", table(spark, d, "eval_items"), "question")


@query
def privacy_report(spark: SparkSession, d: str) -> DataFrame:
    return R.privacy(items(spark, d, "exams"), "item_id", "question", table(spark, d, "eval_items"), "question")


@query
def fidelity_lengths(spark: SparkSession, d: str) -> DataFrame:
    s = R.length_stats(items(spark, d, "exams"), "question").withColumn("side", F.lit("synthetic"))
    return s.unionByName(R.length_stats(table(spark, d, "eval_items"), "question").withColumn("side", F.lit("real")))


@query
def answer_distribution(spark: SparkSession, d: str) -> DataFrame:
    return R.answer_shares(items(spark, d, "exams"))


@query
def answer_l1(spark: SparkSession, d: str) -> DataFrame:
    return R.l1_distance(R.answer_shares(items(spark, d, "exams")), R.answer_shares(table(spark, d, "eval_items")))


@query
def corpus_ttr(spark: SparkSession, d: str) -> DataFrame:
    return R.corpus_ttr(items(spark, d, "sentiment"), "text")


@query
def vocab_jaccard(spark: SparkSession, d: str) -> DataFrame:
    return R.vocabulary_overlap(items(spark, d, "exams"), "question", table(spark, d, "eval_items"), "question")


@query
def subject_distribution(spark: SparkSession, d: str) -> DataFrame:
    return R.subject_shares(items(spark, d, "exams"), "question")


@query
def eval_exams(spark: SparkSession, d: str) -> DataFrame:
    return R.summary(items(spark, d, "exams"), "exams")


@query
def eval_exams_answers(spark: SparkSession, d: str) -> DataFrame:
    return R.distribution(items(spark, d, "exams"), "answer")


@query
def eval_sentiment(spark: SparkSession, d: str) -> DataFrame:
    return R.summary(items(spark, d, "sentiment"), "sentiment")


@query
def eval_sentiment_labels(spark: SparkSession, d: str) -> DataFrame:
    return R.distribution(items(spark, d, "sentiment").select(T.normal_sentiment("sentiment").alias("label")), "label")


@query
def eval_grammar(spark: SparkSession, d: str) -> DataFrame:
    return R.summary(items(spark, d, "grammar"), "grammar")


@query
def export_metadata(spark: SparkSession, d: str) -> DataFrame:
    path = _scratch(spark, "export")
    rows = records(items(spark, d, "grammar"), "item_id").select("item_id", "input", "correction")
    jsonl.write(rows, f"{path}/in")
    jsonl.export(spark, f"{path}/in", f"{path}/out", "jsonl", "grammar", "tutor", "b1")
    fields = "item_id long, input string, correction string, _task string, _persona string, _batch_id string"
    return jsonl.read(spark, f"{path}/out", fields).drop("row_ix", "_line")


@query
def export_csv(spark: SparkSession, d: str) -> DataFrame:
    path = _scratch(spark, "export-csv")
    jsonl.write(records(items(spark, d, "exams"), "item_id").select("item_id", "question", "options", "grade"), f"{path}/in")
    jsonl.export(spark, f"{path}/in", f"{path}/out", "csv", "exams", batch_id="b1")
    read = spark.read.options(header=True, escape='"', multiLine=True, nullValue="").csv(f"{path}/out")
    return read.select(F.col("item_id").cast("long"), "question", F.col("grade").cast("int"), "_task", "_batch_id", F.col("options").startswith("[").alias("listed"))


@query
def jsonl_round_trip(spark: SparkSession, d: str) -> DataFrame:
    path = _scratch(spark, "jsonl")
    jsonl.write(records(items(spark, d, "exams"), "item_id").select("item_id", "question", "options", "answer", "notes"), path)
    return jsonl.read(spark, path, "item_id long, question string, options array<string>, answer string, notes string").drop("row_ix", "_line")


@query
def exam_csv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    path = f"{_scratch(spark, 'exam-csv')}/exams.csv"
    rows = records(items(spark, d, "exams"), "item_id")
    exam_csv.write(rows.select(F.col("item_id").cast("string").alias("id"), F.col("question").alias("qdict"), "answer", "grade", "subject", F.lit("Arabic").alias("language")), path)
    return exam_csv.read(spark, path).select(F.col("id").cast("long").alias("item_id"), "grade", "subject", "language")


def _scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query
def parse_meta(spark: SparkSession, d: str) -> DataFrame:
    literal = F.concat(F.lit("{'grade': "), F.coalesce(F.col("grade").cast("string"), F.lit("None")), F.lit(", 'subject': '"), F.col("subject"), F.lit("', 'language': 'Arabic'}"))
    return items(spark, d, "exams").select("item_id", parsed_meta(literal).alias("m")).select("item_id", "m.*")


@query
def fuzzy_dedup(spark: SparkSession, d: str) -> DataFrame:
    kept = records(items(spark, d, "exams"), "item_id").withColumn("canonical", T.canonical("exams"))
    return M.fuzzy_keep(kept, "item_id", "canonical").select("item_id")


@query
def clean_grammar(spark: SparkSession, d: str) -> DataFrame:
    return C.clean(records(items(spark, d, "grammar"), "item_id"), "grammar", "item_id").select("item_id")


@query
def near_dup_pairs(spark: SparkSession, d: str) -> DataFrame:
    rows = records(items(spark, d, "grammar"), "item_id").where("input IS NOT NULL")
    firsts = rows.groupBy(F.col("input").alias("s")).agg(F.min("item_id").alias("ix"))
    return M.similar_pairs(firsts.select("ix", "s"))


@query
def tstr_accuracy(spark: SparkSession, d: str) -> DataFrame:
    found = tstr.accuracy(items(spark, d, "exams").select("question", T.answer_label("answer").alias("label")), table(spark, d, "eval_items").select("question", F.col("answer").alias("label")), "question", "label")
    return spark.createDataFrame([(found["synthetic_to_real_accuracy"], found.get("note"))], "accuracy double, note string")


def queries() -> dict[str, Query]:
    return dict(_ALL)
