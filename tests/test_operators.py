import json
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from nasaq.functions.components import components
from nasaq.functions.skew import join_unique
from nasaq.operators import augment, clean, generate, report, sampling, schema, seeds, similarity, tstr

EXAM = "id long, question string, options array<string>, answer string, notes string"


def test_schema_golden_cases(spark):
    lines = [
        ('{"question": 5, "options": ["a","b","c","d"], "answer": "A"}', False),
        ('{"question": "q", "options": ["a","b","c"], "answer": "A"}', False),
        ('{"question": "q", "options": ["a","b","c","d"], "answer": "A "}', False),
        ('{"question": "q", "options": ["a","b","c","d"], "answer": "A", "notes": null, "more": 1}', True),
        ('{"question": "q", "options": ["a","b","c",1], "answer": "A"}', False),
        ('{"question": "q", "options": ["a","b","c","d"], "answer": "A", "notes": 3}', False),
        ("not json", False),
    ]
    df = spark.createDataFrame([(x,) for x, _ in lines], "value string")
    assert [r.v for r in df.select(schema.valid_json("exams").alias("v")).collect()] == [ok for _, ok in lines]
    df = spark.createDataFrame([("t", " Positive "), ("t", "mixed"), (None, "neutral"), ("t", None)], "text string, sentiment string")
    assert [r.v for r in df.select(schema.valid("sentiment").alias("v")).collect()] == [True, False, False, False]
    with pytest.raises(ValueError):
        schema.check_task("poems")


@pytest.mark.parametrize(("n", "q"), [(1, [1, 0, 0, 0]), (2, [1, 1, 0, 0]), (3, [2, 2, 2, 2]), (6, [3, 3, 3, 3]), (10, [3, 3, 2, 2])])
def test_quotas(n, q):
    assert list(sampling.quotas(n).values()) == q


def test_schedule_equals_the_loop(spark):
    rng = random.Random(1)
    for _ in range(6):
        n, shares = rng.randint(1, 60), {x: rng.random() for x in "ABCD"}
        q = sampling.quotas(n, shares)
        order, made, out, i = sorted("ABCD", key=lambda x: -q[x]), dict.fromkeys("ABCD", 0), [], 0
        while len(out) < n:
            x = order[i % 4]
            if made[x] < q[x]:
                out.append(x)
                made[x] += 1
            i += 1
        got = sampling.schedule(spark, n, shares).orderBy("slot").collect()
        assert [r.letter for r in got] == out and [r.slot for r in got] == list(range(1, n + 1))
    with pytest.raises(ValueError):
        sampling.quotas(10, {"E": 1.0})


def test_samples(spark):
    df = spark.createDataFrame([(i, ["a", "b", "b", "c", None][i % 5]) for i in range(100)], "id long, subject string")
    assert sampling.uniform(df, "id", 10).count() == 10
    assert sampling.uniform(df, "id", 10, 3).collect() == sampling.uniform(df, "id", 10, 3).collect()
    with pytest.raises(ValueError):
        sampling.uniform(df, "id", 101)
    got = sampling.stratified(df.where("subject IS NOT NULL"), "id", 16).groupBy("subject").count().collect()
    assert {r.subject: r["count"] for r in got} == {"a": 4, "b": 8, "c": 4}
    assert sampling.stratified(df, "id", 16, strict=False).count() == 12
    with pytest.raises(ValueError):
        sampling.stratified(df, "id", 10, "colour")
    with pytest.raises(ValueError):
        sampling.stratified(df, "id", 100)


def test_remap(spark):
    def remap(options, answer, target):
        df = spark.createDataFrame([("q", options, answer, target)], "q string, o array<string>, a string, t string")
        r = df.select(generate.remapped(F.col("q"), F.col("o"), F.col("a"), F.col("t")).alias("r")).first().r
        return r.options, r.answer

    four = ["A. w", "B. x", "C. y", "D. z"]
    assert remap(four, "A", "C") == (["C. w", "A. x", "B. y", "D. z"], "C")
    assert remap(["A. w", "B. w", "C. y", "D. z"], "A", "B") == (["B. w", "A. y", "C. z"], "B")
    assert remap(["A w", "B. x", "C. y", "D. z"], "A", "C")[1] == "A"
    assert remap(four, "E", "C") == (four, "E")


def test_mock_generation_then_cleaning(spark):
    made = generate.generate(spark, "exams", 4)
    assert [r.answer for r in made.orderBy("slot").collect()] == ["A", "B", "C", "D"]
    kept = clean.clean(made, "exams", "slot")
    assert sorted(r.answer for r in kept.collect()) == ["A", "B"]
    assert clean.clean(generate.generate(spark, "sentiment", 3), "sentiment", "slot").count() == 0
    assert clean.clean(generate.generate(spark, "grammar", 3), "grammar", "slot").count() == 1


def test_provider_rounds_are_bounded(spark):
    answer = json.dumps(generate.MOCK["sentiment"], ensure_ascii=False)
    assert generate.generate(spark, "sentiment", 3, lambda p: f"```json\n{answer}\n```").count() == 3
    assert generate.generate(spark, "sentiment", 2, lambda p: "no json", rounds=2).count() == 0


def test_generation_is_strict_about_types(spark):
    good = {"question": "q", "options": ["A. a", "B. b", "C. c", "D. d"], "answer": "A"}
    answers = [good | {"question": 5}, good | {"options": ["A. a", 1, "C. c", "D. d"]}, good | {"notes": 3}, good | {"options": good["options"][:3]}, good]
    raw = spark.createDataFrame([(i, "A", json.dumps(a)) for i, a in enumerate(answers)], "slot long, letter string, raw string")
    assert [r.slot for r in generate._items(raw, "exams", [], 0.7).collect()] == [4]


def test_sentiment_label_with_any_blank_around(spark):
    df = spark.createDataFrame([('{"text": "t", "sentiment": "\\u00a0Positive\\u3000"}', "t", "\u00a0Positive\u3000")], "value string, text string, sentiment string")
    assert df.select(schema.valid_json("sentiment"), schema.valid("sentiment")).first()[:] == (True, True)


def test_uniform_takes_the_first_in_order(spark):
    df = spark.range(3000)
    want = sorted(r.id for r in df.orderBy(sampling.order_key("id", 3), "id").limit(777).collect())
    for edge, digits in ((100_000, 3), (5, 1)):
        assert sorted(r.id for r in sampling.uniform(df, "id", 777, 3, edge, digits).collect()) == want
    assert sampling.uniform(df, "id", 0).count() == 0 and sampling.uniform(df, "id", 3000).count() == 3000


def test_session_log(spark, tmp_path):
    for n in (1, 2):
        generate.log_session(spark, str(tmp_path / "log"), "exams", "mock", n, {"max_seeds": 10}, 0.5, 1.0)
    assert sorted(r.num_samples for r in spark.read.json(str(tmp_path / "log")).collect()) == [1, 2]


def lev(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def sequential(texts, t=0.93):
    kept = []
    for i, s in enumerate(texts):
        if not any(1 - lev(s, texts[k]) / (max(len(s), len(texts[k])) or 1) >= t for k in kept):
            kept.append(i)
    return kept


def test_fuzzy_keep_equals_the_sequential_rule(spark):
    rng = random.Random(2)
    base = ["".join(rng.choice("abcdeاب ") for _ in range(rng.randint(15, 60))) for _ in range(8)]
    texts = []
    for _ in range(120):
        s = list(rng.choice(base))
        for _ in range(rng.randint(0, 4)):
            k = rng.randrange(len(s))
            s[k : k + 1] = rng.choice([[], [rng.choice("xyz")], [s[k], "q"]])
        texts.append("".join(s))
    texts += ["", "", "a"]
    df = spark.createDataFrame([(i, s, 1) for i, s in enumerate(texts)], "ix long, s string, more int")
    assert sorted(r.ix for r in similarity.fuzzy_keep(df, "ix", "s").collect()) == sequential(texts)
    distinct = list(dict.fromkeys(texts))
    want = {(i, k) for k, b in enumerate(distinct) for i, a in enumerate(distinct[:k]) if 1 - lev(a, b) / (max(len(a), len(b)) or 1) >= 0.93}
    assert want
    rows = spark.createDataFrame(list(enumerate(distinct)), "ix long, s string")
    for spare in (0.0, 0.5, 3.0):
        assert {tuple(r) for r in similarity.similar_pairs(rows, spare=spare).collect()} == want
    for most in (200_000, 3, 1):
        dropped = [r.ix for r in similarity.first_kept(similarity.similar_pairs(rows), most).collect()]
        assert sorted(dropped) == sorted(set(range(len(distinct))) - set(sequential(distinct)))


def test_similar_texts_of_one_template_move_in_few_copies(spark):
    rng = random.Random(5)
    name = lambda: "".join(rng.choice("bdfgklmnrst") + rng.choice("aeiou") for _ in range(4))
    texts = [f"He did not see the sign while {name()} was in {name()} for the pure change of {name()} and {name()}" for _ in range(60)]
    texts += [t.replace("sign", "sigh") for t in texts[:10]] + [t.replace("did not", "didnt") for t in texts[5:15]]
    want = {(i, k) for k, b in enumerate(texts) for i, a in enumerate(texts[:k]) if 1 - lev(a, b) / max(len(a), len(b)) >= 0.93}
    assert len(want) >= 20
    df = spark.createDataFrame(list(enumerate(texts)), "ix long, s string")
    pivots = similarity._pivots(similarity._sketches(texts), 4 * similarity._edits(similarity._longest(np.array([len(t) for t in texts]), 0.93), 0.93))
    moved = df.mapInArrow(similarity._placed(pivots, 0.93, 1.5), similarity.PLACED)
    assert moved.count() <= 7 * len(texts)  # a row for each run of characters were some hundred
    for per_cell in (100_000, 20):
        assert sorted(tuple(r) for r in similarity.similar_pairs(df, per_cell=per_cell).collect()) == sorted(want)


def test_texts_that_say_their_names_twice_differ_in_their_sketches(spark):
    rng = random.Random(6)
    name = lambda: "".join(rng.choice("bdfgklmnrst") + rng.choice("aeiou") for _ in range(4))
    said = [f"while {name()} was in {name()} for the pure change of {name()} and {name()} with {name()}" for _ in range(60)]
    texts = [f"there colour is fading {s} / their colour is fading {s} / the possessive is spelled another way" for s in said]
    texts += [t.replace("fading", "fadin").replace("possessive", "posesive") for t in texts[:12]]
    lengths = [len(t) for t in texts]
    want = {(i, k) for k, b in enumerate(texts) for i, a in enumerate(texts[:k]) if 1 - lev(a, b) / max(len(a), len(b)) >= 0.93}
    sketches = similarity._sketches(texts)
    bits = lambda i, k: int(np.bitwise_count(sketches[i] ^ sketches[k]).sum())
    met = {(i, k) for k in range(len(texts)) for i in range(k) if bits(i, k) <= 4 * similarity.most_edits(max(lengths[i], lengths[k]), 0.93)}
    assert want <= met and len(met) <= 2 * len(want)  # nearly all pairs met when what is said twice cancelled out
    df = spark.createDataFrame(list(enumerate(texts)), "ix long, s string")
    for per_cell in (100_000, 25):
        assert sorted(tuple(r) for r in similarity.similar_pairs(df, per_cell=per_cell).collect()) == sorted(want)


def test_tasks_hold_two_blocks_of_a_large_cell(spark, monkeypatch):
    name = lambda i: f"{i * 7919 % 10007:05d}"
    texts = [" ".join(name(100 * i + k) for k in range(12)) for i in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "ix long, s string")

    def sized(threshold):
        def run(table):
            return pa.table({"a": pa.array([table.num_rows], pa.int64()), "b": pa.array([0], pa.int64())})

        return run

    sizes, spread = [], similarity.spread
    monkeypatch.setattr(similarity, "_compared", sized)
    monkeypatch.setattr(similarity, "spread", lambda met, *more: (sizes.extend(r.a for r in met.collect()), spread(met, *more))[1])
    similarity.similar_pairs(df, per_cell=20).collect()
    assert sizes and max(sizes) <= 60  # two blocks of about 20; a task had all rows of the cell


def test_fuzzy_boundary_and_chain(spark):
    a = "a" * 100
    rows = [(0, a), (1, "b" * 7 + a[7:]), (2, None), (3, None)]
    df = spark.createDataFrame(rows, "ix long, s string")
    # 1 - 7/100 is 0.9299999999999999 in doubles: no duplicate.
    assert sorted(r.ix for r in similarity.fuzzy_keep(df, "ix", "s").collect()) == [0, 1, 2]
    chain = spark.createDataFrame([(1, 2), (2, 3)], "a long, b long")
    assert [r.ix for r in similarity.first_kept(chain).collect()] == [2]
    with pytest.raises(RuntimeError):
        similarity.first_kept(spark.createDataFrame([(i, i + 1) for i in range(9)], "a long, b long"), 1, 2)
    empty = spark.createDataFrame([], "ix long, s string")
    assert similarity.fuzzy_keep(empty, "ix", "s").count() == 0


def test_seed_guard_is_strict(spark):
    seed = "a b c d e f g"
    df = spark.createDataFrame([(1, "a b c d e f g h i j"), (2, "a b c d e f g h"), (3, None), (4, "")], "id int, q string")
    assert sorted(r.id for r in similarity.unlike_seeds(df, [seed], "q").collect()) == [1, 3, 4]
    assert similarity.unlike_seeds(df, [], "q").count() == 4


def test_nearest_equals_brute_force(spark):
    rng = random.Random(4)
    text = lambda: " ".join(rng.choice("abcdefghij") for _ in range(rng.randint(0, 6)))
    syn, real = [text() for _ in range(40)] + [None], [text() for _ in range(25)] + [None]
    got = similarity.nearest(
        spark.createDataFrame(list(enumerate(syn)), "id long, t string"), "id", "t", spark.createDataFrame([(x,) for x in real], "r string"), "r", block=10
    )
    got = {r.id: r.overlap for r in got.collect()}
    for i, s in enumerate(syn):
        a = set((s or "").split())
        best = max([len(a & b) / len(a | b) for r in real if a and (b := set((r or "").split()))], default=0.0)
        assert got[i] == pytest.approx(best)


def test_reports(spark):
    one = spark.createDataFrame([(1, "a b c", None, "A", None)], EXAM)
    assert report.evaluation(one, "exams") == {"num_items": 1, "answer_distribution": {"A": 1}, "avg_question_words": 3.0, "question_length_stdev": 0.0}
    empty = one.limit(0)
    assert report.summary(empty, "exams").first().avg_words is None
    assert report.length_stats(empty, "question").first().mean_len == 0.0
    assert report.corpus_ttr(empty, "question").first().ttr == 0.0
    note = report.privacy_report(one, "id", "question", empty, "question")
    assert note["max_overlap"] is None and note["threshold"] == 0.8
    same = report.fidelity(one, one, "question", "answer")
    assert same["answer_balance"]["l1_distance"] == 0.0 and same["vocabulary"]["vocab_jaccard"] == 1.0
    assert set(report.compare(one, one, "question", "answer")) == {"question_length", "subject_distribution", "answer_balance", "vocabulary_overlap"}
    sent = spark.createDataFrame([("t", None), ("t", ""), ("t", "positive")], "text string, sentiment string")
    assert report.evaluation(sent, "sentiment")["missing_sentiments"] == 2


def test_augment(spark):
    df = spark.createDataFrame([(1, "q", ["A. x", "B. x", "C. y", "D. z"], "C", "n"), (2, None, None, None, None)], EXAM)
    out = augment.augment(df, "exams", "id").orderBy("id", "variant_no").collect()
    assert [r.variant_no for r in out] == [0, 1, 0, 1]
    assert out[1].options["ABCD".index(out[1].answer)].endswith("y")
    assert augment.augment(df, "exams", "id", 0).count() == 2 and augment.augment(df, "poems", "id").count() == 2
    sent = spark.createDataFrame([(1, "لكن", "positive", "x")], "id long, text string, sentiment string, extra string")
    rows = augment.augment(sent, "sentiment", "id").orderBy("variant_no").collect()
    assert [r.extra for r in rows] == ["x", None, None] and rows[1].text == "ولكن"


def test_seeds(spark, tmp_path):
    df = spark.createDataFrame([(i, f"تاريخ {i}", ["A. a", "B. b", "C. c", "D. d"], "A", None) for i in range(20)], EXAM)
    drawn = seeds.draw(df, "exams", "id")
    assert drawn.count() == 10 and seeds.draw(df, "grammar", "id").count() == 0
    assert "history" in seeds.guidance(drawn, "exams") and seeds.guidance(drawn.limit(0), "exams") == ""
    seeds.write_audit(drawn, str(tmp_path / "a.json"))
    audit = json.loads((tmp_path / "a.json").read_text())
    assert audit["seed_count"] == 10 and len(audit["seeds_used"][0]["hash"]) == 64


def test_tstr(spark):
    few = spark.createDataFrame([("a b", "A")], "t string, l string")
    assert tstr.accuracy(few, few, "t", "l")["synthetic_to_real_accuracy"] is None
    rows = [(f"{'good fine' if i % 2 else 'bad poor'} w{i % 3}", "A" if i % 2 else "B") for i in range(30)]
    df = spark.createDataFrame(rows, "t string, l string")
    assert tstr.accuracy(df, df, "t", "l", iterations=20)["synthetic_to_real_accuracy"] == 1.0


def test_components(spark):
    rng = random.Random(5)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(20)]
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in links:
        if find(a) != find(b):
            up[max(find(a), find(b))] = min(find(a), find(b))
    used = {x for a, b in links if a != b for x in (a, b)}
    got = {r.id: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in used}
    df = spark.createDataFrame(links, "a long, b long")
    assert {r.id: r.root for r in components(df, most=1).collect()} == got
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_join_with_hot_keys(spark):
    rows = spark.createDataFrame([(k, i) for i, k in enumerate("aaaaaabbcd")] + [(None, 99)], "k string, i long")
    unique = spark.createDataFrame([("a", 1, 6), ("b", 2, 2), ("c", 3, 1), ("e", 4, 1)], "k string, v long, n long")
    want = sorted(map(tuple, rows.join(unique.drop("n"), "k").collect()))
    for most, keys in ((100, 10), (1, 100), (0, 1000), (3, 100)):
        assert sorted(map(tuple, join_unique(rows, unique, ["k"], "n", most, keys).collect())) == want
    assert join_unique(rows, unique.limit(0), ["k"], "n").count() == 0
