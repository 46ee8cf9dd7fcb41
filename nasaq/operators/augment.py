"""Seeded augmentation: entity replacement, paraphrase and option shuffle, one row to several."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nasaq.functions.text import paraphrase, replace_entities, strip

LETTERS = "ABCD"


def _parsed(options: Column) -> Column:
    """(letter, text) of each option: around the first full stop, else first character and text from the third on."""

    def one(o: Column) -> Column:
        dot = F.instr(o, ".")
        letter = F.when(dot > 0, strip(F.substring(o, F.lit(1), dot - 1))).otherwise(F.substring(o, 1, 1))
        text = F.when(dot > 0, F.substring(o, dot + 1, F.length(o))).otherwise(F.substring(o, F.lit(3), F.length(o)))
        return F.struct(letter.alias("letter"), strip(text).alias("text"))

    return F.transform(options, one)


def shuffled_options(options: Column, answer: Column, key: Column, seed: int) -> Column:
    """struct(options, answer): options in a seeded order under new labels, with the label of the right text.

    Of two equal texts the later one gives the answer; without a match the answer
    stays. More than four options are left as they are.
    """
    parsed = _parsed(options)
    right = F.try_element_at(F.filter(parsed, lambda p: p["letter"] == answer), F.lit(-1))["text"]
    order = F.array_sort(
        F.transform(parsed, lambda p, i: F.struct(F.md5(F.concat_ws("|", key.cast("string"), i.cast("string"), F.lit(str(seed)))).alias("k"), i.alias("i"), p["text"].alias("text")))
    )
    label = lambda i: F.substring(F.lit(LETTERS), i + 1, F.lit(1))
    new = F.transform(order, lambda p, i: F.concat(label(i), F.lit(". "), p["text"]))
    # The place of the last equal text, counted from the end; no lambda inside another.
    texts = F.transform(order, lambda p: p["text"])
    from_end = F.coalesce(F.array_position(F.reverse(texts), right), F.lit(0))
    at = (F.size(texts) - from_end).cast("int")
    fits = F.size(options) <= 4
    return F.struct(
        F.when(fits, new).otherwise(options).alias("options"),
        F.when(fits & (from_end > 0), label(at)).otherwise(answer).alias("answer"),
    )


def augment(items: DataFrame, task: str, key: str, variants: int = 2, seed: int = 0) -> DataFrame:
    """Each item followed by its first ``variants`` variants: columns of the items and variant_no, 0 for the item itself.

    sentiment has two variants (their columns other than text, label and key are
    null), exams and grammar one; an unknown task none. Null texts stay null.
    """
    k = F.col(key)
    columns = items.columns

    def row(changes: dict[str, Column], no: int, only: tuple[str, ...] | None = None) -> Column:
        values = []
        for c in columns:
            value = changes.get(c, F.col(c))
            if only is not None and c not in only:
                value = F.lit(None).cast(items.schema[c].dataType)
            values.append(value.alias(c))
        return F.struct(*values, F.lit(no).alias("variant_no"))

    made = [row({}, 0)]
    if task == "sentiment":
        for v in (1, 2):
            made.append(row({"text": paraphrase(replace_entities("text", k, seed + v))}, v, ("text", "sentiment", key)))
    elif task == "exams":
        new = shuffled_options(F.col("options"), F.col("answer"), k, seed + 1)
        made.append(row({"question": paraphrase(replace_entities("question", k, seed + 1)), "options": new["options"], "answer": new["answer"]}, 1))
    elif task == "grammar":
        made.append(row({"input": replace_entities("input", k, seed + 1), "correction": replace_entities("correction", k, seed + 2)}, 1))
    return items.select(F.inline(F.array(*made[: 1 + max(0, variants)])))
