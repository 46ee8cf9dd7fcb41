"""Column functions on text, with Python's string semantics.

All are built-in Spark expressions. Null in gives null out unless said otherwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What Python's str.split and str.strip take as white space.
WHITE = r"\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: Vocabularies of the entity replacement.
NAMES = ["أحمد", "محمد", "سارة", "ليلى", "فاطمة", "خالد", "نور"]
CITIES = ["الرياض", "جدة", "دبي", "الدوحة", "القاهرة", "الرباط"]
YEARS = ["2018", "2019", "2020", "2021", "2022", "2023"]
#: Paraphrases, applied in this order.
PARAPHRASES = [("لكن", "ولكن"), ("لأن", "بسبب"), ("جداً", "للغاية"), ("جدا", "للغاية")]
#: Keywords of a subject; the first that occurs decides.
SUBJECT_KEYWORDS = [
    ("فيزياء", "physics"), ("كهرباء", "physics"), ("طاقة", "physics"), ("أحياء", "biology"), ("خلية", "biology"),
    ("كروموسوم", "biology"), ("علوم", "science"), ("تجربة", "science"), ("دين", "islamic"), ("القرآن", "islamic"),
    ("حديث", "islamic"), ("تاريخ", "history"), ("جغراف", "geography"), ("مجتمع", "social"), ("اقتصاد", "social"),
]
#: Substrings of a coarse subject; the first row that occurs decides.
COARSE_SUBJECTS = [
    ("history", ["تاريخ", "تاريخية"]), ("geography", ["جغرافيا", "جغرافية"]), ("science", ["علوم", "علمية"]), ("literature", ["أدب", "شعر"]),
]
#: Places that anonymisation replaces.
PLACES = ["New York", "Los Angeles", "Cairo"]


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(c: str | Column) -> Column:
    """Words between white space, in order."""
    return F.filter(F.split(_col(c), f"[{WHITE}]+"), lambda x: x != "")


def word_count(c: str | Column) -> Column:
    """Number of words; 0 for null."""
    return F.when(_col(c).isNull(), 0).otherwise(F.size(tokens(c)))


def strip(c: str | Column) -> Column:
    return F.regexp_replace(F.regexp_replace(_col(c), f"^[{WHITE}]+", ""), f"[{WHITE}]+$", "")


def type_token_ratio(c: str | Column) -> Column:
    """Distinct words by words; null without words."""
    t = tokens(c)
    return F.when(F.size(t) > 0, F.size(F.array_distinct(t)) / F.size(t))


def text_of(text: Column, question: Column) -> Column:
    """The text if it isn't empty, else the question, else the empty string."""
    return F.coalesce(F.nullif(text, F.lit("")), F.nullif(question, F.lit("")), F.lit(""))


def answer_label(c: str | Column) -> Column:
    """The stripped answer if it is A to D, else the empty string; for null too."""
    s = strip(c)
    return F.coalesce(F.when(s.isin("A", "B", "C", "D"), s), F.lit(""))


def normal_sentiment(c: str | Column) -> Column:
    return strip(F.lower(_col(c)))


def json_string(c: str | Column) -> Column:
    """The text as a JSON string, other scripts unescaped; null as the word null."""
    s = F.replace(F.replace(_col(c), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    for plain, escaped in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\b", "\\b"), ("\f", "\\f")):
        s = F.replace(s, F.lit(plain), F.lit(escaped))
    for code in (*range(0x00, 0x08), 0x0B, *range(0x0E, 0x20)):
        s = F.replace(s, F.lit(chr(code)), F.lit(f"\\u{code:04x}")) if code else s
    return F.coalesce(F.concat(F.lit('"'), s, F.lit('"')), F.lit("null"))


def json_list(c: str | Column) -> Column:
    """The list of texts as JSON; null as the word null."""
    inner = F.array_join(F.transform(_col(c), json_string), ", ")
    return F.coalesce(F.concat(F.lit("["), inner, F.lit("]")), F.lit("null"))


def json_object(fields: dict[str, Column]) -> Column:
    """JSON of already rendered values, keys sorted, blanks after commas and colons, nulls kept."""
    parts: list[Column] = []
    for i, k in enumerate(sorted(fields)):
        parts += [F.lit(("{" if i == 0 else ", ") + f'"{k}": '), fields[k]]
    return F.concat(*parts, F.lit("}"))


def canonical(task: str, without_notes: Column | None = None) -> Column:
    """Canonical JSON of an item from its own columns; exams without the field notes where the condition holds."""
    if task == "exams":
        fields = {"question": json_string("question"), "options": json_list("options"), "answer": json_string("answer")}
        full = json_object(fields | {"notes": json_string("notes")})
        return full if without_notes is None else F.when(without_notes, json_object(fields)).otherwise(full)
    if task == "sentiment":
        return json_object({"text": json_string("text"), "sentiment": json_string("sentiment")})
    if task == "grammar":
        return json_object({k: json_string(k) for k in ("input", "correction", "explanation")})
    raise ValueError(f"unknown task: {task}")


def json_of_answer(c: str | Column) -> Column:
    """The JSON in a model's answer: a fenced block, else from the first to the last brace, else the whole text."""
    s = _col(c)
    fence = r"(?s)```(?:json)?[" + WHITE + r"]*\n?(.*?)\n?```"
    braces = r"(?s)\{.*\}"
    return F.when(s.rlike(fence), strip(F.regexp_extract(s, fence, 1))).when(s.rlike(braces), F.regexp_extract(s, braces, 0)).otherwise(s)


def subject_hint(c: str | Column) -> Column:
    """Subject by keyword; general for none and for null."""
    low = F.lower(_col(c))
    return reduce(lambda rest, ks: F.when(low.contains(ks[0]), ks[1]).otherwise(rest), reversed(SUBJECT_KEYWORDS), F.lit("general"))


def coarse_subject(c: str | Column) -> Column:
    def has(words: list[str]) -> Column:
        return reduce(lambda a, b: a | b, [_col(c).contains(w) for w in words])

    return reduce(lambda rest, row: F.when(has(row[1]), row[0]).otherwise(rest), reversed(COARSE_SUBJECTS), F.lit("general"))


def option_pattern(c: str | Column) -> Column:
    """letter_dot or letter_dash by how the first option is labelled; null for others."""
    s = _col(c)
    return F.when(s.startswith("A."), "letter_dot").when(s.startswith("A-"), "letter_dash")


def preview(c: str | Column) -> Column:
    return F.concat(F.substring(_col(c), 1, 50), F.lit("..."))


def stable_hash(c: str | Column) -> Column:
    return F.sha2(_col(c), 256)


def pick(key: Column, slot: str, seed: int, n: int) -> Column:
    """A number from 0 to n - 1 from the key, the slot and the seed; the same in every run."""
    head = F.substring(F.md5(F.concat_ws("|", key.cast("string"), F.lit(slot), F.lit(str(seed)))), 1, 8)
    return F.pmod(F.conv(head, 16, 10).cast("long"), F.lit(n)).cast("int")


def _chosen(values: list[str], key: Column, slot: str, seed: int) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), pick(key, slot, seed, len(values)) + 1)


def replace_entities(c: str | Column, key: Column, seed: int) -> Column:
    """Years from 2000 to 2099 become one seeded year; each city, then each name that occurs becomes a
    seeded one. Later replacements see earlier ones."""
    s = F.regexp_replace(_col(c), F.lit(r"(?U)\b20\d{2}\b"), _chosen(YEARS, key, "year", seed))
    for kind, words in (("city", CITIES), ("name", NAMES)):
        for i, word in enumerate(words):
            s = F.replace(s, F.lit(word), _chosen(words, key, f"{kind}{i}", seed))
    return s


def paraphrase(c: str | Column) -> Column:
    return reduce(lambda s, ab: F.replace(s, F.lit(ab[0]), F.lit(ab[1])), PARAPHRASES, _col(c))


def anonymise(c: str | Column) -> Column:
    """Capitalised words become NAME, known places LOCATION, numbers NUMBER, in this order."""
    s = F.regexp_replace(_col(c), r"(?U)\b[A-Z][a-z]+\b", "NAME")
    s = F.regexp_replace(s, r"(?U)\b(?:" + "|".join(PLACES) + r")\b", "LOCATION")
    return F.regexp_replace(s, r"(?U)\b\d+\b", "NUMBER")


def noisy_number(c: str | Column, key: Column, slot: str, seed: int) -> Column:
    """The number within a tenth of itself, seeded."""
    return _col(c) + _col(c) * (pick(key, slot, seed, 1_000_001) / F.lit(1_000_000.0) * 0.2 - 0.1)


def shuffled_text(c: str | Column, key: Column, seed: int) -> Column:
    """The characters in a seeded order."""
    chars = F.filter(F.split(_col(c), ""), lambda x: x != "")
    keyed = F.transform(chars, lambda x, i: F.struct(F.md5(F.concat_ws("|", key.cast("string"), i.cast("string"), F.lit(str(seed)))).alias("k"), x.alias("x")))
    return F.array_join(F.transform(F.array_sort(keyed), lambda x: x["x"]), "")
