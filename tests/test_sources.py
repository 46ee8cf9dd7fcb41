import json

import pytest

from nasaq import cli
from nasaq.operators.generate import SCHEMAS
from nasaq.sources import exam_csv, jsonl
from nasaq.streaming import clean as stream


def put(path, rows):
    path.write_text("\n".join(x if isinstance(x, str) else json.dumps(x, ensure_ascii=False) for x in rows) + "\n", encoding="utf-8")
    return str(path)


def got(path):
    return [json.loads(x) for f in sorted(path.glob("part-*")) for x in f.read_text(encoding="utf-8").splitlines()]


def test_jsonl_keeps_order_and_skips_blank_lines(spark, tmp_path):
    p = put(tmp_path / "a.jsonl", [{"text": "x", "sentiment": "neutral"}, "   ", {"text": "ي", "sentiment": None}])
    rows = jsonl.read(spark, p, SCHEMAS["sentiment"]).orderBy("row_ix").collect()
    assert [r.text for r in rows] == ["x", "ي"]
    with pytest.raises(Exception):
        jsonl.read(spark, put(tmp_path / "b.jsonl", ["{broken"]), SCHEMAS["sentiment"]).collect()


def test_export(spark, tmp_path):
    p = put(tmp_path / "a.jsonl", [{"question": "س", "options": ["A. x", "B. y"], "k": 1}])
    jsonl.export(spark, p, str(tmp_path / "o"), "jsonl", "exams", batch_id="b1")
    assert got(tmp_path / "o") == [{"question": "س", "options": ["A. x", "B. y"], "k": 1, "_task": "exams", "_batch_id": "b1"}]
    jsonl.export(spark, p, str(tmp_path / "c"), "csv", "exams", "tutor")
    text = next((tmp_path / "c").glob("part-*")).read_text(encoding="utf-8")
    assert "_persona" in text.splitlines()[0] and "['A. x', 'B. y']" in text
    with pytest.raises(ValueError):
        jsonl.export(spark, p, str(tmp_path / "x"), "xml", "exams")


def test_exam_csv_round_trip(spark, tmp_path):
    raw = "1,\"{'q': array(['a', 'b'], dtype=object)}\",A,\"{'grade': 7, 'subject': 'bio', 'language': 'Arabic'}\"\n2,oops(,B,broken\n"
    p = tmp_path / "e.csv"
    p.write_text(raw, encoding="utf-8")
    df = exam_csv.read(spark, str(p))
    rows = {r.id: r for r in df.collect()}
    assert rows["1"].qdict == "{'q': ['a', 'b']}" and rows["1"].grade == 7 and rows["2"].qdict == "oops(" and rows["2"].subject is None
    exam_csv.write(df, str(tmp_path / "out.csv"))
    again = {r.id: r for r in exam_csv.read(spark, str(tmp_path / "out.csv")).collect()}
    assert again["1"] == rows["1"] and again["2"].subject is None
    with pytest.raises(ValueError):
        exam_csv.read(spark, "x.txt")


def test_csv_export_keeps_order_of_keys_and_rows(spark, tmp_path):
    rows = [{"z": " x ", "a": 1, "o": ["A. x", "it's"]}, {"a": None, "late": {"k": True}, "z": ""}, {"z": 'q "w", e', "a": True}]
    jsonl.export(spark, put(tmp_path / "a.jsonl", rows), str(tmp_path / "c"), "csv", "exams")
    lines = next((tmp_path / "c").glob("part-*")).read_text(encoding="utf-8").splitlines()
    assert lines[0] == "z,a,o,late,_task" and lines[1].startswith(' x ,1,"[\'A. x\', ""it\'s""]"') and lines[2] == ",,,{'k': True},exams" and lines[3] == '"q ""w"", e",True,,,exams'


def test_exam_csv_reads_none(spark, tmp_path):
    df = spark.createDataFrame([("1", "q", "A", None, "it's None", None), ("2", "q", "B", 3, "a\\b", "ar")], "id string, qdict string, answer string, grade int, subject string, language string")
    exam_csv.write(df, str(tmp_path / "n.csv"))
    assert sorted(map(tuple, exam_csv.read(spark, str(tmp_path / "n.csv")).collect())) == sorted(map(tuple, df.collect()))


def test_augment_keeps_unknown_keys(spark, tmp_path):
    p = put(tmp_path / "a.jsonl", [{"k": 1, "question": "q", "options": ["A. x", "B. y", "C. z", "D. w"], "answer": "A"}])
    a, b = (json.loads(r.value) for r in cli.augmented_lines(spark, p, "exams", 2).orderBy("variant_no").collect())
    assert a == {"k": 1, "question": "q", "options": ["A. x", "B. y", "C. z", "D. w"], "answer": "A"}
    assert list(b) == list(a) and b["k"] == 1 and b["options"]["ABCD".index(b["answer"])].endswith("x")
    p = put(tmp_path / "s.jsonl", [{"k": 1, "text": "t", "sentiment": "neutral"}])
    rows = [json.loads(r.value) for r in cli.augmented_lines(spark, p, "sentiment", 1).orderBy("variant_no").collect()]
    assert rows == [{"k": 1, "text": "t", "sentiment": "neutral"}, {"text": "t", "sentiment": "neutral"}]


def test_env_file_and_answer_shares(tmp_path, monkeypatch):
    monkeypatch.setenv("NASAQ_SET", "kept")
    monkeypatch.delenv("NASAQ_NEW", raising=False)
    (tmp_path / ".env").write_text("# x=1\nNASAQ_SET=lost\nexport NASAQ_NEW='v'\n", encoding="utf-8")
    cli.load_env(str(tmp_path / ".env"))
    cli.load_env(str(tmp_path / "none"))
    assert (cli.os.environ["NASAQ_SET"], cli.os.environ["NASAQ_NEW"]) == ("kept", "v")
    assert cli.shares_of("A=0.5, B=0.5") == {"A": 0.5, "B": 0.5} and cli.shares_of(None) is None


def test_cli(spark, tmp_path, monkeypatch, capsys):
    monkeypatch.chdir(tmp_path)
    cli.main(["generate", "exams", "--num-samples", "4"])
    assert len(got(tmp_path / "outputs/exams_raw.jsonl")) == 4
    cli.main(["clean", "exams", "--in-path", "outputs/exams_raw.jsonl"])
    assert [x["answer"] for x in got(tmp_path / "outputs/clean.jsonl")] == ["A", "B"]
    cli.main(["augment", "exams", "--in-path", "outputs/clean.jsonl"])
    assert len(got(tmp_path / "outputs/augmented.jsonl")) == 4
    capsys.readouterr()
    cli.main(["evaluate", "exams"])
    assert json.loads(capsys.readouterr().out)["num_items"] == 2
    cli.main(["export", "exams", "--meta-batch-id", "b"])
    assert all(x["_batch_id"] == "b" for x in got(tmp_path / "outputs/exams.jsonl"))


def test_clean_keeps_unknown_keys(spark, tmp_path):
    p = put(tmp_path / "a.jsonl", [{"input": "a b c", "correction": "x", "explanation": "y", "more": {"k": [1]}}, {"input": "a b", "correction": "x", "explanation": "y"}])
    rows = cli.clean_lines(spark, p, "grammar").collect()
    assert [json.loads(r.value)["more"] for r in rows] == [{"k": [1]}]


def test_streaming(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    put(src / "a.json", [{"input": "a b c", "correction": "x", "explanation": "y"}, {"input": "a", "correction": "x", "explanation": "y"}, {"input": None}])
    live = spark.readStream.schema(SCHEMAS["grammar"]).json(str(src))
    q = stream.cleaned(live, "grammar").writeStream.format("memory").queryName("cleaned").start()
    q.processAllAvailable()
    q.stop()
    assert [r.input for r in spark.sql("SELECT * FROM cleaned").collect()] == ["a b c"]
    put(src / "b.json", [])
    timed = spark.readStream.schema("id long, t timestamp, v string").json(str(tmp_path / "in2")) if (tmp_path / "in2").mkdir() is None else None
    put(tmp_path / "in2/a.json", [{"id": 1, "t": "2024-01-01T00:00:00", "v": "a"}, {"id": 1, "t": "2024-01-01T00:10:00", "v": "a"}, {"id": 2, "t": "2024-01-01T00:00:00", "v": "b"}])
    q = stream.first_arrivals(timed, "id", "t").writeStream.format("memory").queryName("firsts").start()
    q.processAllAvailable()
    q.stop()
    assert spark.sql("SELECT * FROM firsts").count() == 2
    q = stream.counts_by_window(timed, "t", "v").writeStream.outputMode("complete").format("memory").queryName("windows").start()
    q.processAllAvailable()
    q.stop()
    assert {r.value: r.n for r in spark.sql("SELECT value, n FROM windows").collect()} == {"a": 2, "b": 1}
