"""Operators on items: look-alikes, formatting copies, near duplicates, pair defects, samples."""

import random
from pathlib import Path
import unicodedata

import pytest
from pyspark.sql import functions as F

from nasaq.llm import lookalikes as L
from nasaq.llm import pairs, sampling
from nasaq.llm.formatting import FormattingCopies
from nasaq.llm.near_duplicates import NearDuplicates, Settings, words_of
from nasaq.session import shared_dir

A_CUT = "а"  # Cyrillic


@pytest.mark.parametrize(
    ("text", "form"),
    [
        ("thе bоok", "the book"), ("СO2", "CO2"), ("ＤＮＡ", "DNA"), ("a​b­c﻿", "abc"),
        ("x y z　", "x y z "), ("café", "café"), ("أ", "أ"), ("ﺑﻴﺘ", "بيت"),
        ("ﻻ", "لا"), ("کی۱", "كي١"), ("\U0001d400", "A"), ("ا\u064e\u0654", "أ\u064e"),
    ],
)
def test_rewritten(text, form):
    assert L.as_it_looks(text) == form and L.plain_rewriter().changes(text)


@pytest.mark.parametrize(
    "text",
    ["", "plain", "спасибо", "μπράβο α", "m² H₂O", "\U0001f468‍\U0001f469‍\U0001f467 ❤️",
     "café", "كَتَب", "tab\there\nline", "Α", "پیدا"],
)
def test_left_alone(text):
    assert L.as_it_looks(text) == text and not L.plain_rewriter().changes(text)


def test_rewriting_is_stable_and_classes_are_transitive():
    rng = random.Random(1)
    members = sorted(L.classes())
    for _ in range(300):
        s = "".join(rng.choice(["a", "ب", " ", *rng.sample(members, 3)]) for _ in range(8))
        once = L.as_it_looks(s)
        assert L.as_it_looks(once) == once
    assert L.classes()["ａ"] is L.classes()["а"]
    assert unicodedata.normalize("NFC", "é") == L.as_it_looks("é")


def test_frequency_chooses_the_representative(spark):
    df = spark.createDataFrame([(1, "ك ك", 0), (2, "ک", 0), (3, None, 0), (4, "  ", 0), (4, "  ", 0)], "id long, t string, more int")
    r = L.corpus_rewriting(df.select("t"))
    assert r["ک"] == "ك"
    out = {x.id: (x.unified, x.changed) for x in L.unified(df, ["id"], "t", r).collect()}
    assert out == {1: ("ك ك", False), 2: ("ك", True), 3: (None, False), 4: ("  ", False)}
    assert L.unified(df.limit(0), ["id"], "t", {}).count() == 0
    assert L.representatives({"ک": 9, "ك": 1})["ك"] == "ک"


def test_letters_of_another_script_never_represent():
    r = L.representatives({A_CUT: 9, "a": 1, "Α": 50, "A": 2})
    assert "a" not in r and "A" not in r and r[A_CUT] == "a" and L.Rewriter(r)("plain cAt") == "plain cAt"


def test_rewriting_that_turns_in_a_circle_settles():
    turning = L.Rewriter({"b": "d", "dc": "bc"})
    assert turning("bc") == turning("dc") == "bc"
    chain = L.Rewriter({chr(97 + i): chr(98 + i) for i in range(20)})
    assert chain("a") == "u"  # more passes than a few


def test_armenian_cherokee_and_phonetic_twins():
    for text, form in (("hell\u0585 w\u0585rld", "hello world"), ("\u13aapple", "Apple"), ("\u0261ood", "good")):
        assert L.as_it_looks(text) == form
    for text in ("\u0562\u0561\u0580\u0565\u0582", "\u13e3\u13b3\u13a9", "\u0261\u028ad"):
        assert L.as_it_looks(text) == text


def test_sequences_are_counted_in_every_text(spark):
    texts = ["لا " * 5, "كلا", "ﻻ ﻻ", "fi fi fi", "ﬁ", "e\u0301 e\u0302\u0301 ﬁ ﻻ", None, "", "ل", "ا", "ffi"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    counts = {r.member: r.n for r in L.member_counts(df).collect()}
    assert (counts["لا"], counts["ﻻ"], counts["fi"], counts["ﬁ"], counts["ffi"], counts["e\u0301"]) == (6, 3, 4, 2, 1, 1)
    assert counts["e\u0302\u0301"] == 1 and "e\u0302" not in counts  # a part of the longer one
    r = L.corpus_rewriting(df)
    assert r["ﻻ"] == "لا" and r["ﬁ"] == "fi" and "لا" not in r and "fi" not in r


ROWS = "task string, item_id long, parts array<string>, text string"


def test_formatting_copies(spark):
    four = ["A. x", "B. y", "C. z", "D. w"]
    rows = [
        ("exams", 5, ["Whаt is it?", *four], None), ("exams", 3, ["what  is: IT", "A) w.", "(B) z", "C- Y", "D:x"], None), ("exams", 5, ["Whаt is it?", *four], None),
        ("exams", 7, ["what is it", "A. x", "B. y", "C. z", "D. v"], None), ("exams", 8, None, None), ("exams", 9, ["q", "A. x", None, "C. z", "D. w"], None),
        ("exams", 10, ["q", "A. x", "B. ", "C. z", "D. w"], None), ("sentiment", 5, ["a b"], None), ("sentiment", 6, ["A-b!"], None), ("sentiment", 7, [" "], None), ("sentiment", 8, ["..."], None),
        ("sentiment", 9, ["x" * 200_000], None), ("sentiment", 4, ["X" * 200_000 + "."], None),
    ]
    op = FormattingCopies(spark.createDataFrame(rows, ROWS))
    assert sorted(map(tuple, op.copies().collect())) == [("exams", 3, 5), ("sentiment", 4, 9), ("sentiment", 5, 6)]
    counts = {(r.task, r.keep_id): r.n_copies for r in op.collapsed().collect()}
    assert counts == {("exams", 3): 2, ("exams", 7): 1, ("sentiment", 5): 2, ("sentiment", 4): 2}
    # The same with every key of more than one row as a hot one.
    hot = FormattingCopies(spark.createDataFrame(rows, ROWS), hot=1)
    assert sorted(map(tuple, hot.copies().collect())) == sorted(map(tuple, op.copies().collect()))
    assert sorted(map(tuple, hot.members().collect())) == sorted(map(tuple, op.members().collect()))
    assert {(r.task, r.keep_id): r.n_copies for r in hot.collapsed().collect()} == counts
    empty = FormattingCopies(spark.createDataFrame([], ROWS))
    assert empty.copies().count() == 0 and empty.collapsed().count() == 0


def brute_groups(rows, t):
    sets = {(task, i): frozenset(words_of(L.as_it_looks(s))) for task, i, s in rows if s and s.strip()}
    sets = {k: v for k, v in sets.items() if v}
    up = {k: k for k in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    keys = sorted(sets)
    for a in keys:
        for b in keys:
            if a < b and a[0] == b[0]:
                n = len(sets[a] & sets[b])
                if n / (len(sets[a]) + len(sets[b]) - n) >= t - 1e-9:
                    x, y = sorted((find(a), find(b)))
                    up[y] = x
    return {k: find(k)[1] for k in keys}


def edited(rng, count, vocabulary, most=4):
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(1, 22))] for _ in range(count // 6)]
    rows = []
    for i in range(count):
        w = list(rng.choice(base))
        for _ in range(rng.randint(0, most)):
            k = rng.randrange(len(w) + 1)
            w[k : k + rng.randint(0, 1)] = [rng.choice(vocabulary)] * rng.randint(0, 1)
        rng.shuffle(w)
        rows.append((rng.choice(["s", "e"]), i, " ".join(w)))
    return rows


@pytest.mark.parametrize(
    "settings",
    [Settings(), Settings(hot_rows=2), Settings(bucket=3, depth=3), Settings(bucket=2, depth=2, hot=4), Settings(bucket=2, depth=2, tail=3, hot=5), Settings(bucket=2, words=5, hot=6)],
)
def test_near_duplicates_equal_brute_force(spark, settings):
    rng = random.Random(settings.bucket)
    rows = edited(rng, 240, [f"w{i}" for i in range(45)]) + [("s", 900, None), ("s", 901, "  "), ("s", 902, "?!"), ("s", 1, None)]
    df = spark.createDataFrame([(*r, 1) for r in rows + rows[:30]], "task string, id long, text string, more int")
    got = {(r.task, r.id): r.group_id for r in NearDuplicates(df, settings).run().collect()}
    assert got == brute_groups(rows, settings.similarity)


def test_near_duplicates_hot_family_and_edges(spark):
    rng = random.Random(9)
    common = [f"c{i}" for i in range(20)]
    rows = [("s", i, " ".join([*common, *(f"x{rng.randrange(40)}" for _ in range(3))])) for i in range(150)]
    rows += [("s", 200 + i, " ".join(common)) for i in range(40)] + [("s", 500, "long " * 50_000)]
    df = spark.createDataFrame(rows, "task string, id long, text string")
    got = {(r.task, r.id): r.group_id for r in NearDuplicates(df, Settings(bucket=4, hot=8)).run().collect()}
    assert got == brute_groups(rows, 0.7)
    assert NearDuplicates(df.limit(0)).run().count() == 0


def test_links_of_a_hot_family_are_exact(spark):
    rng = random.Random(5)
    common = [f"c{i}" for i in range(12)]
    rows = [("s", i, " ".join([*common, *(f"x{j}" for j in rng.sample(range(9), rng.randint(0, 4)))])) for i in range(120)]
    rows += [("e", i, f"c1 c2 c3 y{i % 7} y{i % 5}") for i in range(40)]
    df = spark.createDataFrame(rows, "task string, id long, text string")
    sets = {(task, frozenset(words_of(t))) for task, _, t in rows}
    similar = lambda a, b: a[0] == b[0] and a != b and len(a[1] & b[1]) / len(a[1] | b[1]) >= 0.7 - 1e-9
    degree = {a: sum(similar(a, b) for b in sets) for a in sets}
    want = {(task, i): degree[task, frozenset(words_of(t))] for task, i, t in rows}
    groups = brute_groups(rows, 0.7)
    for hot in (512, 5):
        op = NearDuplicates(df, Settings(bucket=4, hot=hot))
        got = {(r.task, r.id): (r.links, r.group_id) for r in op.run().collect()}
        assert got == {k: (want[k], groups[k]) for k in want}
    assert {(r.task, r.id): r.group_id for r in op.groups().collect()} == groups


def test_near_duplicates_take_keys_in_passes_and_leave_no_texts_behind(spark, monkeypatch):
    rng = random.Random(11)
    rows = edited(rng, 200, [f"w{i}" for i in range(60)])
    df = spark.createDataFrame(rows, "task string, id long, text string")
    taken, candidates = [], NearDuplicates._candidates
    monkeypatch.setattr(NearDuplicates, "_candidates", lambda self, keys, *more: (taken.append(keys.count()), candidates(self, keys, *more))[1])
    folder = Path(shared_dir(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    got = {(r.task, r.id): r.group_id for r in NearDuplicates(df, Settings(bucket=3, words=5, hot=6, per_pass=1)).groups().collect()}
    assert got == brute_groups(rows, 0.7)
    assert len(taken) == 8 and max(taken) < sum(taken) / 2
    left = {p.name.rpartition("-")[0] for p in set(folder.iterdir()) - before if list(p.rglob("*.parquet"))}
    assert left <= {"members", "links"}


def test_near_duplicates_prune_keys_past_their_lists(spark):
    rng = random.Random(12)
    rows = edited(rng, 200, [f"w{i}" for i in range(60)])
    df = spark.createDataFrame(rows, "task string, id long, text string")

    def keys(**lists):
        op = NearDuplicates(df, Settings(bucket=2, depth=3, hot=1000, **lists))
        found, complete, _ = op._keys(op._distinct_sets()[1])
        assert complete  # no word outside the list can have a bucket of more than ``hot`` rows
        return sum(len(r[f"k{i}"]) for r in found.rows().collect() for i in range(8))

    by_word = keys()
    assert 0 < keys(tail=3) <= 1.05 * by_word  # a bit that another key set is rare
    keys(words=30)
    assert {(r.task, r.id): r.group_id for r in NearDuplicates(df, Settings(bucket=2, depth=3, tail=3, words=30)).groups().collect()} == brute_groups(rows, 0.7)


@pytest.fixture(scope="module")
def judge(spark):
    docs = [("en", "the book is on the table and the pupil reads it"), ("ar", "الكتاب على الطاولة والطالب يقرأ الدرس"), ("fr", "le livre est sur la table et le garçon lit"), ("es", "el libro está sobre la mesa y el niño lee"), ("de", "das Buch liegt auf dem Tisch und der Junge liest")]
    df = spark.createDataFrame([(i, k, t) for i, (k, t) in enumerate(docs * 5)], "doc_id long, lang string, text string")
    # The ends of the cases below are among the texts, as they are when a corpus is judged.
    rare = ["the verb agrees with its sub", "the verb agrees with its subject in the", "Agreement."]
    texts = spark.createDataFrame([("the verb agrees with its subject in every tense.",)] * 60 + [(x,) for x in rare], "e string")
    likely = {(r.a, r.b): r.p for r in pairs.end_likelihoods(texts).collect()}
    assert likely["every", "tense"] == 1.0 and likely["its", "sub"] == 0.0 and likely["in", "the"] < 0.05 and likely["", "agreement"] is None
    of = pairs.Judge(pairs.train_language(df))
    return lambda *pair: {d for d, a, b in of(*pair) if b is None or (likely.get((a, b)) is not None and likely[a, b] < 0.05)}


@pytest.mark.parametrize(
    ("p", "c", "e", "found"),
    [
        ("he go home with the book today", "he goes home with the book today", "the verb agrees with its subject in every tense.", set()),
        ("he go home with the book today", "he goes home with the", "the verb agrees with its subject in every tense", {"truncated"}),
        ("he go home with the book today", "he goes home with the book today", "the verb agrees with its sub", {"truncated"}),
        ("he go home with the book today", "he goes home with the book today", "the verb agrees with its subject in the", {"truncated"}),
        ("he go home with the book today", "N/A", None, {"empty"}),
        ("he go home with the book today", "He go home, with the book today!", "Agreement.", {"copied"}),
        ("he goes home with the book today", "he goes home with the book today.", "No change is needed here.", set()),
        ("he go home with the book today", "I am unable to correct this sentence.", "-", {"refusal", "empty"}),
        ("he go home with the book today", "he goes home with the book today", "el verbo está sobre la mesa y el niño lee el libro", {"other_language"}),
        # A quoted prompt doesn't hide the language around it.
        ("he go home with the book today", "he goes home with the book today", 'el verbo está mal: "he go home with the book today" y el niño lee el libro sobre la mesa', {"other_language"}),
        (None, "he goes home", "Agreement.", set()),
        ("", None, None, {"empty"}),
    ],
)
def test_pair_defects(judge, p, c, e, found):
    assert judge(p, c, e) == found


def test_pair_defects_query(spark):
    docs = spark.createDataFrame([], "doc_id long, lang string, text string")
    rows = spark.createDataFrame([(1, None, None, None, 0), (1, None, None, None, 0), (2, "a b", "a b", "x", 0)], "item_id long, input string, correction string, explanation string, defect int")
    assert sorted(map(tuple, pairs.defects(rows, docs).collect())) == [(1, "empty"), (2, "copied")]
    assert pairs.defects(rows.limit(0), docs).count() == 0


TARGETS = "sample_id string, _task string, category string, target_share double, min_rows int, sample_rows int"


def test_samples(spark):
    items = spark.createDataFrame([("t", i, "abcc"[i % 4], 0) for i in range(400)] + [("t", 0, "a", 0), ("t", 999, None, 0), ("t", None, "a", 0)], "task string, item_id long, category string, more int")
    targets = spark.createDataFrame(
        [("s", "t", "a", 0.5, 5, 60), ("s", "t", "b", 0.3, 5, 60), ("s", "t", "c", 0.2, 5, 60), ("f", "t", "a", 0.99, 0, 50), ("f", "t", "b", 0.01, 10, 50), ("x", "t", "a", 0.5, 0, 300), ("x", "t", "c", 0.4, 0, 300), ("x", "t", "z", 0.1, 3, 300), (None, "t", "a", 1.0, 1, 5)],
        TARGETS,
    )
    rows, report = sampling.sample(items, targets)
    got = {(r.sample_id, r.category): r.taken_rows for r in report.collect()}
    assert {c: got["s", c] for c in "abc"} == {"a": 30, "b": 18, "c": 12}
    assert got["f", "b"] == 10 and got["f", "a"] == 40
    assert got["x", "a"] == 100 and got["x", "c"] == 200 and got["x", "z"] == 0
    assert rows.count() == rows.select("sample_id", "item_id").distinct().count() == 60 + 50 + 300
    unmet = {(r.sample_id, r.category) for r in report.where("NOT floor_met").collect()}
    assert unmet == {("x", "z")}
    again = sampling.sample(items.repartition(3), targets)[0]
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, rows.collect()))
    small = sampling.sample(items, targets, bucket=5)[1]
    assert {(r.sample_id, r.category): r.taken_rows for r in small.collect()} == got
    assert sampling.sample(items.limit(0), targets)[0].count() == 0
    assert sampling.sample(items, targets.limit(0))[0].count() == 0
