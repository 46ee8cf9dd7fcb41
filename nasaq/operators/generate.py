"""Generation through a model provider: prompts, the mock model, answer remapping and bounded refill rounds."""

from __future__ import annotations

import json
import os
import time
import urllib.request
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nasaq.functions.text import json_of_answer, normal_sentiment, strip
from nasaq.operators.sampling import schedule
from nasaq.operators.schema import check_task, valid, valid_json
from nasaq.operators.similarity import unlike_seeds
from nasaq.session import checkpointed

PLACEHOLDER = "{target_answer_letter}"
PROMPTS = {
    "exams": "You write Arabic school exams. Write one new multiple-choice question with four options labelled A. to D., of which exactly one is right: "
    + PLACEHOLDER
    + '. Reply with a JSON object only: {"question": "...", "options": ["A. ...", "B. ...", "C. ...", "D. ..."], "answer": "'
    + PLACEHOLDER
    + '", "notes": "..."}',
    "sentiment": 'You write short Arabic posts of 30 to 50 words. Reply with a JSON object only: {"text": "...", "sentiment": "positive | negative | neutral"}',
    "grammar": 'Write an Arabic sentence with a grammar mistake, correct it and explain it. Reply with a JSON object only: {"input": "...", "correction": "...", "explanation": "..."}',
}
#: The answers of the mock model.
MOCK = {
    "exams": {"question": "ما عاصمة دولة عربية تطل على الخليج وتتميز بمعمار حديث؟", "options": ["A. الدوحة", "B. الرياض", "C. جدة", "D. المنامة"], "answer": "A"},
    "sentiment": {"text": "تجربة رائعة في المطعم اليوم؛ خدمة سريعة وطعام لذيذ وأسعار مناسبة.", "sentiment": "positive"},
    "grammar": {"input": "الولد ذهبت إلى المدرسة مبكرًا.", "correction": "الولد ذهب إلى المدرسة مبكرًا.", "explanation": "الفعل يجب أن يطابق الفاعل في التذكير والإفراد."},
}
SCHEMAS = {
    "exams": "question string, options array<string>, answer string, notes string",
    "sentiment": "text string, sentiment string",
    "grammar": "input string, correction string, explanation string",
}
LETTERS = ("A", "B", "C", "D")


def prompt(task: str, letter: Column, persona: str | None = None, guidance: str = "") -> Column:
    """The prompt: the persona if given, else the task's; the letter is filled in for exams only, guidance goes before."""
    check_task(task)
    body = F.lit(persona or PROMPTS[task])
    if task == "exams":
        body = F.replace(body, F.lit(PLACEHOLDER), F.coalesce(letter, F.lit("A")))
    return F.concat(F.lit(guidance + "\n\n"), body) if guidance else body


def mock_answer(prompt_: Column) -> Column:
    """The mock model's answer, chosen by words of the prompt."""
    text = {k: F.lit(json.dumps(v, ensure_ascii=False)) for k, v in MOCK.items()}
    both = lambda a, b: prompt_.contains(a) & prompt_.contains(b)
    return F.when(both("options", "answer"), text["exams"]).when(both("sentiment", "text"), text["sentiment"]).otherwise(text["grammar"])


def chat_provider(model: str, temperature: float = 0.7, top_p: float = 0.95, url: str | None = None, timeout: float = 60.0) -> Callable[[str], str]:
    """A provider that asks a chat-completion service; its key is read from OPENAI_API_KEY where it runs."""

    def ask(text: str) -> str:
        key = os.environ.get("OPENAI_API_KEY")
        if not key:
            raise RuntimeError("OPENAI_API_KEY is not set")
        body = {"model": model, "messages": [{"role": "system", "content": "Return only valid JSON."}, {"role": "user", "content": text}], "temperature": temperature, "top_p": top_p}
        request = urllib.request.Request(
            url or "https://api.openai.com/v1/chat/completions", json.dumps(body).encode(), {"Authorization": f"Bearer {key}", "Content-Type": "application/json"}
        )
        with urllib.request.urlopen(request, timeout=timeout) as answer:
            return json.load(answer)["choices"][0]["message"]["content"]

    return ask


def asked(slots: DataFrame, provider: Callable[[str], str], attempts: int = 3, wait: float = 1.0) -> DataFrame:
    """Rows (slot, letter, raw): each prompt's answer; null after ``attempts`` failures with growing waits (1 to 8 s)."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            raw = []
            for text in pdf["prompt"]:
                answer = None
                for i in range(attempts):
                    try:
                        answer = provider(text)
                        break
                    except Exception:
                        if i + 1 < attempts:
                            time.sleep(min(8.0, wait * 2**i))
                raw.append(answer)
            yield pd.DataFrame({"slot": pdf["slot"], "letter": pdf["letter"], "raw": raw})

    return slots.select("slot", "letter", "prompt").mapInPandas(run, "slot long, letter string, raw string")


def remapped(question: Column, options: Column, answer: Column, target: Column) -> Column:
    """struct(options, answer, changed): the right option first under the target letter, the other texts under the
    remaining letters in order; distractors equal to the right text go. Without a right text, or with an option
    that has no full stop or more distractors than letters, nothing changes."""
    parsed = F.transform(
        options, lambda o: F.struct(strip(F.substring_index(o, ".", 1)).alias("letter"), strip(F.substring(o, F.instr(o, ".") + 1, F.length(o))).alias("text"))
    )
    right = F.try_element_at(F.filter(parsed, lambda p: p["letter"] == strip(answer)), F.lit(-1))["text"]
    others = F.array_remove(F.transform(parsed, lambda p: p["text"]), right)
    letters = F.array_except(F.array(*map(F.lit, LETTERS)), F.array(target))
    ok = ~F.exists(options, lambda o: F.instr(o, ".") == 0) & (F.coalesce(right, F.lit("")) != "") & (F.size(others) <= F.size(letters)) & question.isNotNull()
    ok = F.coalesce(ok, F.lit(False))
    rest = F.zip_with(F.slice(letters, F.lit(1), F.greatest(F.size(others), F.lit(0))), others, lambda a, t: F.concat(a, F.lit(". "), t))
    new = F.concat(F.array(F.concat(target, F.lit(". "), right)), rest)
    return F.struct(F.when(ok, new).otherwise(options).alias("options"), F.when(ok, target).otherwise(answer).alias("answer"), ok.alias("changed"))


def _items(raw: DataFrame, task: str, seeds: list[str], most: float) -> DataFrame:
    """Valid items of raw answers: parsed, guarded against the seeds, validated, normalised, remapped."""
    # Types are strict, and reading into columns would turn numbers into text; so the JSON itself is checked first.
    bodies = raw.where("raw IS NOT NULL").select("slot", "letter", json_of_answer("raw").alias("body")).where(valid_json(task, "body"))
    parsed = bodies.select("slot", "letter", F.from_json("body", SCHEMAS[task]).alias("r")).select("slot", "letter", "r.*")
    if task == "exams":
        parsed = unlike_seeds(parsed, seeds, "question", most)
    good = parsed.where(valid(task))
    if task == "sentiment":
        return good.withColumn("sentiment", normal_sentiment("sentiment"))
    if task == "exams":
        new = remapped(F.col("question"), F.col("options"), F.col("answer"), F.col("letter"))
        good = good.withColumn("_n", F.when(F.col("answer") != F.col("letter"), new))
        moved = F.coalesce(F.col("_n.changed"), F.lit(False))
        return good.select(
            "slot", "letter", "question",
            F.when(moved, F.col("_n.options")).otherwise(F.col("options")).alias("options"),
            F.when(moved, F.col("_n.answer")).otherwise(F.col("answer")).alias("answer"),
            F.when(~moved, F.col("notes")).alias("notes"),
            moved.alias("remapped"),
        )
    return good


def generate(
    spark: SparkSession, task: str, n: int, provider: Callable[[str], str] | None = None, persona: str | None = None, guidance: str = "",
    seeds: list[str] | None = None, shares: dict[str, float] | None = None, most_similar: float = 0.7, rounds: int = 5,
) -> DataFrame:
    """Rows (slot, letter, fields of the task): at most n items. Without a provider the mock model answers.
    Exams have a column remapped: such items carry no notes.

    Slots whose item fails are asked again, in at most ``rounds`` rounds, so a model
    that always fails ends with fewer items. Answers are stored before they are used
    twice: a lost task doesn't repeat paid calls.
    """
    check_task(task)
    slots = schedule(spark, n, shares).withColumn("prompt", prompt(task, F.col("letter"), persona, guidance))
    if provider is None:
        return _items(slots.select("slot", "letter", mock_answer(F.col("prompt")).alias("raw")), task, seeds or [], most_similar)
    done = None
    for _ in range(rounds):
        new = checkpointed(_items(checkpointed(asked(slots, provider)), task, seeds or [], most_similar))
        done = new if done is None else done.unionByName(new)
        slots = slots.join(new.select("slot"), "slot", "left_anti")
        if slots.isEmpty():
            break
    return done


def log_session(spark: SparkSession, path: str, task: str, model: str, num_samples: int, seed_constraints: dict, generation_time: float, success_rate: float) -> None:
    """Appends one row with the parameters of a generation session to the JSON log at ``path``."""
    row = {"task": task, "model": model, "num_samples": num_samples, "seed_constraints": json.dumps(seed_constraints), "generation_time": float(generation_time), "success_rate": float(success_rate), "version": "1.0.0"}
    spark.createDataFrame([row]).withColumn("timestamp", F.current_timestamp()).write.mode("append").json(path)
