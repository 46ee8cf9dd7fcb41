"""Operators on documents: leaked items, packing, mixing, abuse, tokens."""

import os
import random

import pytest

from nasaq.llm import abuse, contamination, mixing, packing
from nasaq.llm.tokens import VOCABULARY, encoding, token_counts, usable

DOCS = "doc_id long, text string, source string, more int"


def brute_leaks(docs, items, least):
    words = lambda t: contamination.WORD.findall(contamination.normalised(t))
    out = set()
    for i, t in items:
        w = words(t)
        grams = {tuple(w[k : k + least]) for k in range(len(w) - least + 1)}
        for d, text in docs:
            v = words(text or "")
            if any(tuple(v[k : k + least]) in grams for k in range(len(v) - least + 1)):
                out.add((d, i))
    return out


def test_leaks_equal_brute_force(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(6)]
    some = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, some(rng.randint(0, 14))) for i in range(40)] + [(98, "w1 w1 w1 w1 w1 w1"), (99, "w1 w1 w1 w1 w1 w1")]
    docs = [(d, some(rng.randint(0, 60)) + rng.choice(["", " zz " + items[d % 40][1]])) for d in range(60)] + [(70, None), (71, ""), (72, "w1 " * 30_000)]
    df = spark.createDataFrame([(d, t, None, 1) for d, t in docs], DOCS)
    it = spark.createDataFrame(items, "test_id long, text string")
    for least, block in ((4, 50_000), (6, 12)):
        rows = contamination.leaks(df, it, least, block).collect()
        assert len(rows) == len({(r.doc_id, r.test_id) for r in rows})
        assert {(r.doc_id, r.test_id) for r in rows} == brute_leaks(docs, items, least)
        assert all(r.longest >= least and 0 < r.coverage <= 1 for r in rows)
    assert contamination.leaks(df, it.limit(0)).count() == 0 and contamination.leaks(df.limit(0), it).count() == 0


def test_leak_normalisation_and_cutting(spark):
    q = spark.createDataFrame([(1, "ما الوصف الأدق لظاهرة حين يدعم", ["النبات الزراعي", None, "داخل"])], "test_id long, question string, options array<string>")
    items = contamination.item_text(q)
    docs = spark.createDataFrame([(1, "قال: ما الوَصف، الأدقّ\nلظاهرة حين يدعم النبات الزراعي! انتهى", "s", 0), (2, "ما الوصف الأدق لظاهرة حين يدعم", "s", 0), (3, None, "s", 0)], DOCS)
    assert [r.doc_id for r in contamination.leaks(docs, items).collect()] == [1]
    out = {r.doc_id: r for r in contamination.without_leaks(docs, items).collect()}
    assert out[1].removed_words == 8 and "الأدق" not in out[1].text and out[1].text.endswith("! انتهى")
    # Six words of nine are over the share of half, but under one of 0.7.
    assert out[2].removed_words == 6 and out[3].text is None
    assert {r.doc_id: r.removed_words for r in contamination.without_leaks(docs, items, coverage=0.7).collect()} == {1: 8, 2: 0, 3: 0}


def test_items_are_read_without_option_labels(spark):
    q = spark.createDataFrame([(1, "one two three four five six", ["A. seven eight", "(B) nine ten", "C- eleven twelve", "D) thirteen"]), (2, "blank", None)], "test_id long, question string, options array<string>")
    items = contamination.item_text(q)
    assert items.first().text.split() == "one two three four five six seven eight nine ten eleven twelve thirteen".split()
    docs = [(1, "so four five six seven eight nine ten eleven end"), (2, "seven eight, nine ten. eleven twelve thirteen one two"), (3, "eight nine ten eleven twelve thirteen A B"), (4, "one two three four five six seven eight")]
    df = spark.createDataFrame([(i, t, None, 0) for i, t in docs], DOCS)
    assert sorted(r.doc_id for r in contamination.leaks(df, items).collect()) == [1, 4]


def brute_clean(text, items, least, coverage, shortest):
    words = text.split()
    gone = set()
    for w in (t.split() for _, t in items):
        need = min(least, max(shortest, -(-int(coverage * 1000 * len(w)) // 1000)))
        for n in range(need, len(w) + 1 if len(w) >= shortest else 0):
            runs = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}
            for k in range(len(words) - n + 1):
                if tuple(words[k : k + n]) in runs:
                    gone.update(range(k, k + n))
    return [w for i, w in enumerate(words) if i not in gone], len(gone)


def test_cleaning_by_length_and_by_coverage(spark):
    rng = random.Random(8)
    some = lambda n: " ".join(f"w{rng.randrange(5)}" for _ in range(n))
    items = [(i, some(rng.randint(1, 16))) for i in range(12)]
    docs = [(d, some(rng.randint(0, 20)) + " zz " + items[d % 12][1] + " yy") for d in range(40)]
    df = spark.createDataFrame([(d, t, None, 0) for d, t in docs] + [(99, None, None, 0), (0, docs[0][1], None, 0)], DOCS)
    it = spark.createDataFrame(items, "test_id long, text string")
    for block in (100_000, 12):
        rows = contamination.without_leaks(df, it, 8, 0.5, 4, block).collect()
        assert len(rows) == len(docs) + 2
        got = {r.doc_id: r for r in rows}
        assert got[99].text is None
        for d, t in docs:
            kept, n = brute_clean(t, items, 8, 0.5, 4)
            assert (got[d].text.split(), got[d].removed_words) == (kept, n)
    marked = spark.createDataFrame([(1, "x caf\u0065\u0301 e\u0301 " + " ".join("abcdefgh") + " x", None, 0)], DOCS)
    item = spark.createDataFrame([(1, "caf\u00e9 \u00e9 " + " ".join("abcdefgh"))], "test_id long, text string")
    assert contamination.without_leaks(marked, item).first().removed_words == 10


def passage_score(text):
    return 100 * abuse.judge(abuse.fold(text))[0] / abuse.PASSAGE


@pytest.mark.parametrize(
    "text",
    ["you idiot", "SHUT UP, YOU CLOWN", "your mother raised a useless tra*h", "go rot in a ditch, you m0r0n", "shut up you p i g", "أنت حقير", "يا ح م ا ر", "يا حقققير", "يا ح-م-ا-ر", "يا غـبي", "ودمهم ف ا س د لصوص وخونة",
     "Sorafi p30pl3 are less than human", "send me your nudеs tonight", "ｙｏｕ idiot", "أهل سوراف حشرات يجب طردهم"],
)
def test_abusive(text):
    from nasaq.llm.lookalikes import as_it_looks

    assert passage_score(as_it_looks(text)) >= abuse.LEAST_SCORE - 1e-9


@pytest.mark.parametrize(
    "text",
    ["", "the clown in the play makes children laugh", "take out the trash", "doctor advises early breast cancer screening", "sexual reproduction in plants", "this phone is useless and the service was awful", "الكلب حيوان وفي", "سرطان الثدي", "درس عن خطر الشتم والسخرية", "a nude marble statue", "Zofa hated war"],
)
def test_harmless(text):
    assert passage_score(text) < abuse.LEAST_SCORE


#: Wordings that no test table has.
HELD_OUT_ABUSE = ["you are a pathetic liar and everyone knows it", "I will break your face if you come back", "what a disgusting creep you are", "those people are cockroaches", "they should all be exterminated, every one of them", "send me your naked body tonight",
    "f**king id**t, you", "you filthy sn4ke", "أنت أغبى حشرة رأيتها، يا لئيم", "سأحطم عظامك أيها الجبان", "هؤلاء القوم جرذان", "يجب إبادتهم جميعا", "أرسلي لي صورك عارية", "tu es un vrai connard", "du bist ein dummkopf", "يا بغل اسكت"]
HELD_OUT_HARMLESS = ["the clown made every child at the circus laugh", "the director told the actor to shout at the idiot in the second act", "dictionary: 'moron' is a word that means a person who is not clever", "the dog chased the cat around the garden", "my old laptop is trash, do not buy it",
    "sex of the chick is decided by its chromosomes", "the soldiers killed the time with cards", "the painter's nude hangs in the museum", "rats carry the disease into the harbour", "the strike paralysed the country", "نام الكلب تحت الشجرة", "كلمة غبي في القاموس تعني قليل الفهم", "الجرذان تنقل الطاعون إلى المزارع", "رسم الفنان جسما عاريا من الرخام", "قتل الفارس التنين في الرواية", "هذا الهاتف فاشل وبطاريته سيئة"]


def test_held_out_wordings():
    found = [t for t in HELD_OUT_ABUSE if passage_score(t) >= abuse.LEAST_SCORE - 1e-9]
    wrong = [t for t in HELD_OUT_HARMLESS if passage_score(t) >= abuse.LEAST_SCORE - 1e-9]
    print(sorted(set(HELD_OUT_ABUSE) - set(found)), wrong)
    assert len(found) >= 0.7 * len(HELD_OUT_ABUSE) and len(wrong) <= 0.15 * len(HELD_OUT_HARMLESS)


def test_threshold_is_fitted_on_labels(spark):
    docs = spark.createDataFrame([(i, "you idiot" if i % 3 == 0 else "a fine day", "a", 0) for i in range(90)], DOCS)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(90)] + [(1, None), (None, 1)], "doc_id long, toxic int")
    assert abuse.fitted_threshold(docs, labels) == abuse.LEAST_SCORE and abuse.fitted_threshold(docs, labels.limit(0)) == abuse.LEAST_SCORE
    assert abuse.best_threshold([(3.0, True)] * 30 + [(2.0, False)] * 30) == 3.0
    assert sorted(r.doc_id for r in abuse.flagged(docs, labels).collect()) == list(range(0, 90, 3))


def test_threshold_is_fitted_on_all_labels(spark):
    # 25 positive documents among 15,125: a third of them would have too few to fit.
    texts = ["you idiot"] * 25 + ["hardcore"] * 100 + ["a lesson"] * 15_000
    assert passage_score("you idiot") == 2.5 and passage_score("hardcore") == 2.0
    docs = spark.createDataFrame([(i, "a", x) for i, x in enumerate(texts)], "doc_id long, source string, text string")
    labels = spark.createDataFrame([(i, int(i < 25)) for i in range(len(texts))], "doc_id long, toxic int")
    assert abuse.fitted_threshold(docs, labels) == 2.5
    assert abuse.flagged(docs, labels).count() == 25


def test_scores_and_rates(spark):
    long = "plain " * 40_000 + "you idiot"
    df = spark.createDataFrame([(1, "you idiot", "a", 0), (1, "you idiot", "a", 0), (2, None, "a", 0), (3, "", None, 0), (4, long, "b", 0)], DOCS)
    rows = {r.doc_id: r for r in abuse.scores(df).collect()}
    # The worst passage counts, however long the document is.
    assert rows[1].score == rows[4].score > 0 == rows[2].score == rows[3].score
    assert sorted(r.doc_id for r in abuse.flagged(df).collect()) == [1, 1, 4]
    assert {r.source: (r.docs, r.flagged) for r in abuse.rates(df).collect()} == {"a": (3, 2), None: (1, 0), "b": (1, 1)}
    assert abuse.scores(df.limit(0)).count() == 0


@pytest.mark.skipif(not os.path.exists(VOCABULARY), reason="no vocabulary")
def test_tokens(spark):
    df = spark.createDataFrame([(1, "hello world", "a", 0), (2, None, "a", 0), (3, "", "a", 0), (4, "x " * 100_000, "a", 0)], DOCS)
    got = {r.doc_id: r.tokens for r in token_counts(df).collect()}
    one = encoding(VOCABULARY)
    assert one.decode(one.encode_ordinary("hello world")) == "hello world"
    assert got[1] == len(one.encode_ordinary("hello world")) and got[2] == got[3] == 0 and got[4] >= 100_000
    assert sorted(r.doc_id for r in usable(df).collect()) == [1, 4]


def test_best_fit_wastes_little():
    rng = random.Random(1)
    sizes = [rng.randint(1, 60) for _ in range(500)]
    at = packing.best_fit(sizes, 100)
    fill = {}
    for s, c in zip(sizes, at, strict=True):
        fill[c] = fill.get(c, 0) + s
    assert max(fill.values()) <= 100 and len(fill) <= 1.02 * sum(sizes) / 100 + 1


@pytest.mark.parametrize("group", [20_000, 40])
def test_packing(spark, group):
    rng = random.Random(2)
    sizes = [(i, rng.choice([1, 5, 50, 99, 100, 101, 250, rng.randint(1, 120)])) for i in range(400)] + [(900, 0), (901, None)]
    df = spark.createDataFrame([(*s, 1) for s in sizes], "doc_id long, tokens long, item int")
    packs = spark.createDataFrame([("k", 100), ("l", 64), ("bad", 0), ("none", None)], "pack_id string, capacity_tokens int")
    out = packing.pack(df, packs, group=group)
    rows = out.collect()
    for pack, cap in (("k", 100), ("l", 64)):
        fill, whole, pieces = {}, {}, {}
        for r in (r for r in rows if r.pack_id == pack):
            fill[r.container] = fill.get(r.container, 0) + r.tokens
            whole[r.doc_id] = whole.get(r.doc_id, 0) + r.tokens
            pieces.setdefault(r.doc_id, []).append((r.start, r.tokens))
        assert whole == {i: n for i, n in sizes if n}
        assert max(fill.values()) <= cap
        assert all(len(p) == -(-whole[i] // cap) for i, p in pieces.items())
        alone = sum(n // cap for n in whole.values())
        rest = [n % cap for n in whole.values() if n % cap]
        assert len(fill) - alone <= 1.04 * (max(packing.best_fit(rest, cap)) + 1) + 1
    use = {r.pack_id: r for r in packing.usage(out, packs).collect()}
    assert set(use) == {"k", "l"} and all(0 <= u.unused_share < 0.2 for u in use.values())
    assert packing.pack(df.limit(0), packs).count() == 0
    with pytest.raises(ValueError):
        packing.pack(df, packs.limit(0))


def test_water_fill():
    got = mixing.water_fill(100, {"a": 0.5, "b": 0.3, "c": 0.2}, {"a": 10, "b": 1000, "c": 1000})
    assert got == pytest.approx({"a": 10, "b": 54, "c": 36})
    assert mixing.water_fill(100, {"a": 1.0, "z": 0.5}, {"a": 30}) == {"a": 30.0, "z": 0.0}
    assert mixing.water_fill(5, {}, {}) == {}


def test_mixing(spark):
    rng = random.Random(4)
    docs = [(i, "abc"[i % 3] if i % 7 else None, rng.randint(1, 40)) for i in range(600)] + [(1000, "a", 5000), (1001, "b", 0), (1002, "b", None)]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, source string, tokens long, repeats int").select("doc_id", "source", "tokens")
    targets = spark.createDataFrame(
        [("m", "a", 0.5, 2, 3000), ("m", "b", 0.3, 2, 3000), ("m", "c", 0.2, None, 3000), ("n", "a", 0.2, 1, 60000), ("n", "b", 0.7, 3, 60000), ("n", "gone", 0.1, 3, 60000)],
        "mix_id string, source string, target_share double, max_repeats int, total_tokens long",
    )
    rows, report = mixing.mix(df, targets)
    rows, report = rows.collect(), {(r.mix_id, r.source): r for r in report.collect()}
    assert len({(r.mix_id, r.doc_id) for r in rows}) == len(rows)
    for s, share in (("a", 0.5), ("b", 0.3), ("c", 0.2)):
        assert report["m", s].reached_share == pytest.approx(share, abs=0.01) and report["m", s].met
    have = {s: sum(t or 0 for _, x, t in docs if x == s) for s in "abc"}
    assert report["n", "b"].reached_tokens == 3 * have["b"] and report["n", "a"].reached_tokens == have["a"] and not report["n", "gone"].met
    assert max(r.repeats for r in rows if r.mix_id == "n" and r.source == "b") == 3
    small = {(r.mix_id, r.source): r.reached_tokens for r in mixing.mix(df, targets, bucket=10)[1].collect()}
    assert small == {k: r.reached_tokens for k, r in report.items()}  # the result doesn't depend on the buckets
    units = spark.createDataFrame([(i, "a", 1) for i in range(64)], "doc_id long, source string, tokens long")
    for n in range(40, 200, 37):  # also where a fraction ends with a bucket
        goal = spark.createDataFrame([("u", "a", 1.0, 9, n)], "mix_id string, source string, target_share double, max_repeats int, total_tokens long")
        assert mixing.mix(units, goal, bucket=1)[1].first().reached_tokens == n
    # Nothing that is left out would still fit.
    for (m, s), r in report.items():
        least = min([t for i, x, t in docs if x == s and t and not any(y.doc_id == i and y.mix_id == m for y in rows)], default=10**9)
        assert r.planned_tokens - r.reached_tokens < least or r.reached_tokens == r.planned_tokens
    empty_rows, empty_report = mixing.mix(df.limit(0), targets)
    assert empty_rows.count() == 0 and not any(r.met for r in empty_report.collect())
    assert mixing.mix(df, targets.limit(0))[0].count() == 0
