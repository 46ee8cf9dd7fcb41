import json
import random

import pytest
from pyspark.sql import functions as F

from nasaq.functions import text as T


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column.alias("y")).first().y


SPACES = [0x09, 0x0B, 0x1C, 0x1F, 0x20, 0x85, 0xA0, 0x1680, 0x2003, 0x2028, 0x202F, 0x205F, 0x3000]


def test_tokens_split_like_python(spark):
    for cp in [*SPACES, 0x200B, 0xFEFF]:
        s = f"{chr(cp)}a{chr(cp)}b "
        assert one(spark, s, T.tokens("x")) == s.split(), hex(cp)
        assert one(spark, s, T.strip("x")) == s.strip(), hex(cp)
    assert one(spark, "", T.tokens("x")) == []
    assert one(spark, None, T.word_count("x")) == 0


def test_ratio_and_text(spark):
    assert one(spark, "a b a", T.type_token_ratio("x")) == 2 / 3
    assert one(spark, " ", T.type_token_ratio("x")) is None
    assert one(spark, "", T.text_of(F.col("x"), F.lit("q"))) == "q"
    assert one(spark, None, T.text_of(F.col("x"), F.lit(None))) == ""
    assert [one(spark, v, T.answer_label("x")) for v in (" A\n", "a", "E", None)] == ["A", "", "", ""]


def test_paraphrase_isnt_idempotent(spark):
    assert one(spark, "لكن", T.paraphrase("x")) == "ولكن"
    assert one(spark, "ولكن جدا", T.paraphrase("x")) == "وولكن للغاية"


def test_anonymise(spark):
    assert one(spark, "New York 12", T.anonymise("x")) == "NAME NAME NUMBER"
    assert one(spark, "aB Cd Éf ٣٤ x1", T.anonymise("x")) == "aB NAME Éf NUMBER x1"


@pytest.mark.parametrize(
    ("raw", "out"),
    [("a ```json\n{\"x\": 1}\n``` b", '{"x": 1}'), ("``` y ```", "y"), ("see {\"a\": {}} ok", '{"a": {}}'), ("none", "none"), ("", "")],
)
def test_json_of_answer(spark, raw, out):
    assert one(spark, raw, T.json_of_answer("x")) == out


def test_canonical_equals_python(spark):
    rng = random.Random(3)
    chars = 'ab"\\\n\t\r\x08\x0c\x01\x1fاé😀/'
    text = lambda: "".join(rng.choice(chars) for _ in range(rng.randint(0, 12)))
    rows = [(text(), [text() for _ in range(rng.randint(0, 4))], text(), rng.choice([None, text()])) for _ in range(60)]
    df = spark.createDataFrame(rows, "question string, options array<string>, answer string, notes string")
    got = [r.c for r in df.select(T.canonical("exams").alias("c")).collect()]
    keys = ("question", "options", "answer", "notes")
    assert got == [json.dumps(dict(zip(keys, r, strict=True)), ensure_ascii=False, sort_keys=True) for r in rows]


def test_subjects(spark):
    assert one(spark, "تجربة في الطاقة", T.subject_hint("x")) == "physics"
    assert one(spark, None, T.subject_hint("x")) == "general"
    assert one(spark, "شعر وتاريخ", T.coarse_subject("x")) == "history"
    assert one(spark, "A- x", T.option_pattern("x")) == "letter_dash"


def test_entities_are_seeded(spark):
    col = T.replace_entities("x", F.lit(7), 1)
    a, b = (one(spark, "سافر أحمد إلى جدة عام 2021 و12021", col) for _ in range(2))
    assert a == b and "12021" in a and any(c in a for c in T.CITIES)
