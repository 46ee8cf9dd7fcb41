"""The same queries as ANSI SQL for DuckDB."""

from __future__ import annotations

import re

from nasaq.functions.text import CITIES, COARSE_SUBJECTS, NAMES, PARAPHRASES, SUBJECT_KEYWORDS, WHITE, YEARS
from nasaq.operators.clean import LEAST_VARIETY, LENGTHS
from nasaq.operators.generate import MOCK
from nasaq.operators.sampling import quotas

TABLES = {"exams": "exam_items", "sentiment": "sentiment_items", "grammar": "grammar_items"}
MAIN = {"exams": "question", "sentiment": "text", "grammar": "input"}


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def toks(c: str) -> str:
    return f"regexp_extract_all({c}, '[^{WHITE}]+')"


def words(c: str) -> str:
    return f"coalesce(len({toks(c)}), 0)"


def ttr(c: str) -> str:
    return f"(CASE WHEN len({toks(c)}) > 0 THEN len(list_distinct({toks(c)}))::DOUBLE / len({toks(c)}) END)"


def strip(c: str) -> str:
    return f"regexp_replace(regexp_replace({c}, '^[{WHITE}]+', ''), '[{WHITE}]+$', '')"


def json_string(c: str) -> str:
    s = f"replace(replace({c}, '\\', '\\\\'), '\"', '\\\"')"
    for code, escaped in ((10, "\\n"), (13, "\\r"), (9, "\\t"), (8, "\\b"), (12, "\\f")):
        s = f"replace({s}, chr({code}), '{escaped}')"
    return f"coalesce('\"' || {s} || '\"', 'null')"


CANONICAL = {
    "exams": f"""'{{"answer": ' || {json_string('answer')} || ', "notes": ' || {json_string('notes')} || ', "options": ' || coalesce('[' || coalesce(array_to_string(list_transform(options, x -> {json_string('x')}), ', '), '') || ']', 'null') || ', "question": ' || {json_string('question')} || '}}'""",
    "sentiment": f"""'{{"sentiment": ' || {json_string('sentiment')} || ', "text": ' || {json_string('text')} || '}}'""",
    "grammar": f"""'{{"correction": ' || {json_string('correction')} || ', "explanation": ' || {json_string('explanation')} || ', "input": ' || {json_string('input')} || '}}'""",
}
CANONICAL["exams"] = CANONICAL["exams"].replace("coalesce('[' ||", "(CASE WHEN options IS NULL THEN 'null' ELSE '[' ||").replace("|| ']', 'null')", "|| ']' END)")

VALID = {
    "exams": "coalesce(question IS NOT NULL AND len(options) = 4 AND len(list_filter(options, x -> x IS NULL)) = 0 AND answer IN ('A', 'B', 'C', 'D'), false)",
    "sentiment": f"coalesce(text IS NOT NULL AND {strip('lower(sentiment)')} IN ('positive', 'negative', 'neutral'), false)",
    "grammar": "(input IS NOT NULL AND correction IS NOT NULL AND explanation IS NOT NULL)",
}
LENGTH = {t: f"({words(c)} BETWEEN {lo} AND {hi})" for t, (c, lo, hi) in LENGTHS.items()}
VARIETY = {t: f"coalesce({ttr(MAIN[t])} >= {LEAST_VARIETY}::DOUBLE, false)" if t != "grammar" else "true" for t in TABLES}


def each(select: str, where: str = "true", group: str = "") -> str:
    """The select over the three item tables; {main}, {valid}, {canonical} stand for the task's own expressions."""
    parts = []
    for t, name in TABLES.items():
        names = {"main": MAIN[t], "valid": VALID[t], "canonical": CANONICAL[t], "length": LENGTH[t], "variety": VARIETY[t], "words": words(MAIN[t])}
        s, w = select, where
        for k, v in names.items():
            s, w = s.replace("{" + k + "}", v), w.replace("{" + k + "}", v)
        parts.append(f"SELECT {s}, '{t}' AS task FROM {name} WHERE {w} {group}")
    return " UNION ALL ".join(parts)


def pick(key: str, slot: str, seed: int, n: int) -> str:
    return f"(('0x' || substr(md5({key}::VARCHAR || '|{slot}|{seed}'), 1, 8))::BIGINT % {n})"


def chosen(values: list[str], key: str, slot: str, seed: int) -> str:
    return f"[{', '.join(map(lit, values))}][{pick(key, slot, seed, len(values))} + 1]"


#: A year is a whole run of word characters, so whole runs are compared.
RUNS = r"'[\p{L}\p{M}\p{N}_]+|[^\p{L}\p{M}\p{N}_]+'"


def by_runs(c: str, each_run: str) -> str:
    return f"(CASE WHEN {c} IS NULL THEN NULL ELSE coalesce(array_to_string(list_transform(regexp_extract_all({c}, {RUNS}), r -> {each_run}), ''), '') END)"


def entities(c: str, key: str, seed: int) -> str:
    s = by_runs(c, f"CASE WHEN regexp_full_match(r, '20[0-9]{{2}}') THEN {chosen(YEARS, key, 'year', seed)} ELSE r END")
    for kind, vocabulary in (("city", CITIES), ("name", NAMES)):
        for i, w in enumerate(vocabulary):
            s = f"replace({s}, {lit(w)}, {chosen(vocabulary, key, f'{kind}{i}', seed)})"
    return s


def paraphrased(c: str) -> str:
    for a, b in PARAPHRASES:
        c = f"replace({c}, {lit(a)}, {lit(b)})"
    return c


def hint(c: str) -> str:
    return "(CASE " + " ".join(f"WHEN contains(lower({c}), {lit(k)}) THEN '{s}'" for k, s in SUBJECT_KEYWORDS) + " ELSE 'general' END)"


def coarse(c: str) -> str:
    return "(CASE " + " ".join("WHEN " + " OR ".join(f"contains({c}, {lit(w)})" for w in ws) + f" THEN '{s}'" for s, ws in COARSE_SUBJECTS) + " ELSE 'general' END)"


def label(c: str) -> str:
    return f"(CASE WHEN {strip(c)} IN ('A', 'B', 'C', 'D') THEN {strip(c)} ELSE '' END)"


PARSED = f"list_transform(options, o -> {{'letter': CASE WHEN instr(o, '.') > 0 THEN {strip("substr(o, 1, instr(o, '.') - 1)")} ELSE substr(o, 1, 1) END, 'text': CASE WHEN instr(o, '.') > 0 THEN {strip("substr(o, instr(o, '.') + 1)")} ELSE {strip('substr(o, 3)')} END}})"


def shuffled(source: str, seed: int) -> str:
    """CTE columns of ``source`` with new_options and new_answer."""
    return f"""
      p AS (SELECT *, {PARSED} AS parsed FROM {source}),
      r AS (SELECT *, list_filter(parsed, x -> x.letter = answer)[-1].text AS right_text,
                   list_sort(list_transform(range(0, len(parsed)), i -> {{'k': md5(item_id::VARCHAR || '|' || i::VARCHAR || '|{seed}'), 'i': i, 'text': parsed[i + 1].text}})) AS o FROM p),
      s AS (SELECT *, CASE WHEN len(options) <= 4 THEN list_transform(range(0, len(o)), i -> substr('ABCD', i + 1, 1) || '. ' || o[i + 1].text) ELSE options END AS new_options,
                   CASE WHEN len(options) <= 4 THEN coalesce(list_filter(list_transform(range(0, len(o)), i -> CASE WHEN o[i + 1].text = right_text THEN substr('ABCD', i + 1, 1) END), x -> x IS NOT NULL)[-1], answer) ELSE answer END AS new_answer FROM r)"""


SEEDS = f"(SELECT * FROM (SELECT * FROM eval_items ORDER BY md5(test_id::VARCHAR || '|0'), test_id LIMIT 10) WHERE {VALID['exams']})"
SHARES = lambda t: f"(SELECT l AS label, (SELECT count(*) FROM {t} WHERE {label('answer')} = l) AS n FROM (VALUES ('A'), ('B'), ('C'), ('D')) v(l))"
P = lambda t: f"(SELECT label, n, n::DOUBLE / greatest(1, sum(n) OVER ()) AS p FROM {SHARES(t)})"
FIRST = "(SELECT item_id, arg_min({c}, coalesce(loaded_at, TIMESTAMP '9999-12-31')) AS {c} FROM exam_items GROUP BY item_id)"


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    out["word_counts"] = f"SELECT doc_id, {words('text')} AS words FROM documents"
    out["type_token_ratios"] = f"SELECT doc_id, {ttr('text')} AS ttr FROM documents"
    out["schema_validate"] = each("{valid} AS valid, count(*) AS n", group="GROUP BY 1")
    out["json_schema_validate"] = each("(item_id % 20 > 3 AND {valid}) AS valid, count(*) AS n", group="GROUP BY 1")
    out["length_filter"] = each("item_id, {words} AS words", "{length}")
    out["ttr_filter"] = each("item_id", "{variety}")
    out["length_ttr_clean"] = each("count(*) AS kept, avg({words}) AS avg_words", "{valid} AND {length} AND {variety}")
    out["canonical_json"] = each("item_id, {canonical} AS canonical")
    body = CANONICAL["grammar"]
    out["extract_fenced_json"] = f"SELECT item_id, CASE WHEN item_id % 3 = 2 THEN explanation ELSE {body} END AS extracted FROM grammar_items"
    out["subject_hint"] = f"SELECT item_id, {hint('question')} AS hint, {coarse('question')} AS coarse FROM exam_items"
    pattern = "CASE WHEN starts_with(o, 'A.') THEN 'letter_dot' WHEN starts_with(o, 'A-') THEN 'letter_dash' END"
    out["option_patterns"] = f"SELECT pattern, count(*) AS n FROM (SELECT {pattern} AS pattern FROM (SELECT unnest(options) AS o FROM exam_items)) WHERE pattern IS NOT NULL GROUP BY 1"
    out["anonymize"] = "SELECT doc_id, " + by_runs("text", "CASE WHEN regexp_full_match(r, '[A-Z][a-z]+') THEN 'NAME' WHEN regexp_full_match(r, '\\p{Nd}+') THEN 'NUMBER' ELSE r END") + " AS anonymous FROM documents"
    out["paraphrase"] = f"SELECT item_id, {paraphrased('text')} AS paraphrased FROM sentiment_items"
    out["entity_replace"] = f"SELECT doc_id, {entities('text', 'doc_id', 5)} AS replaced FROM documents"
    number = f"n_chars::DOUBLE + n_chars::DOUBLE * ({pick('doc_id', 'n_chars', 3, 1_000_001)} / 1000000.0::DOUBLE * 0.2::DOUBLE - 0.1::DOUBLE)"
    order = "list_sort(list_transform(range(0, length(source)), i -> {'k': md5(doc_id::VARCHAR || '|' || i::VARCHAR || '|3'), 'x': substr(source, i + 1, 1)}))"
    out["metadata_noise"] = f"SELECT doc_id, {number} AS noisy_chars, array_to_string(list_transform({order}, s -> s.x), '') AS noisy_source FROM documents"
    out["option_shuffle"] = f"WITH {shuffled('(SELECT * FROM exam_items WHERE len(options) = 4)', 1)} SELECT item_id, new_options AS options, new_answer AS answer FROM s"
    variant = "SELECT item_id, {no} AS variant_no, " + paraphrased("{e}") + " AS text, sentiment FROM sentiment_items"
    out["augment_sentiment"] = "SELECT item_id, 0 AS variant_no, text, sentiment FROM sentiment_items" + "".join(
        " UNION ALL " + variant.replace("{no}", str(v)).replace("{e}", entities("text", "item_id", v)) for v in (1, 2)
    )
    out["augment_exams"] = f"WITH {shuffled('exam_items', 1)} SELECT item_id, 0 AS variant_no, question, options, answer FROM exam_items UNION ALL SELECT item_id, 1, {paraphrased(entities('question', 'item_id', 1))}, new_options, new_answer FROM s"
    out["augment_grammar"] = f"SELECT item_id, 0 AS variant_no, input, correction, explanation FROM grammar_items UNION ALL SELECT item_id, 1, {entities('input', 'item_id', 1)}, {entities('correction', 'item_id', 2)}, explanation FROM grammar_items"
    out["remap_answer"] = f"""
      WITH p AS (SELECT item_id, question, options, answer, substr('ABCD', (item_id % 4 + 1)::INT, 1) AS target,
                        list_transform(options, o -> {{'letter': {strip("split_part(o, '.', 1)")}, 'text': {strip("substr(o, instr(o, '.') + 1)")}}}) AS parsed
                 FROM exam_items WHERE len(options) = 4 AND answer IS NOT NULL),
      q AS (SELECT *, list_filter(parsed, x -> x.letter = {strip('answer')})[-1].text AS right_text FROM p),
      r AS (SELECT *, list_filter(list_transform(parsed, x -> x.text), t -> t <> right_text) AS others, list_filter(['A', 'B', 'C', 'D'], x -> x <> target) AS letters FROM q),
      s AS (SELECT *, coalesce(len(list_filter(options, o -> instr(o, '.') = 0)) = 0 AND coalesce(right_text, '') <> '' AND len(others) <= 3 AND question IS NOT NULL, false) AS ok FROM r)
      SELECT item_id, CASE WHEN ok THEN list_concat([target || '. ' || right_text], list_transform(range(0, len(others)), i -> letters[i + 1] || '. ' || others[i + 1])) ELSE options END AS options,
             CASE WHEN ok THEN target ELSE answer END AS answer FROM s"""
    q = quotas(1000, {"A": 0.4, "B": 0.3, "C": 0.2, "D": 0.1})
    turns = " UNION ALL ".join(f"SELECT range AS turn, {i} AS rank, '{x}' AS letter FROM range({n})" for i, (x, n) in enumerate(sorted(q.items(), key=lambda kv: -kv[1])))
    out["quota_schedule"] = f"SELECT slot, letter FROM (SELECT row_number() OVER (ORDER BY turn, rank) AS slot, letter FROM ({turns})) WHERE slot <= 1000"
    texts = [o.split(". ", 1)[1] for o in MOCK["exams"]["options"]]
    made = []
    for i, x in enumerate("ABCD"):
        rest = [y for y in "ABCD" if y != x]
        options = [f"{x}. {texts[0]}"] + [f"{a}. {t}" for a, t in zip(rest, texts[1:], strict=True)]
        made.append(f"({i}, '{x}', [{', '.join(map(lit, options))}])")
    out["mock_generate"] = f"SELECT range + 1 AS slot, {lit(MOCK['exams']['question'])} AS question, v.options, v.letter AS answer FROM range(40) JOIN (VALUES {', '.join(made)}) v(i, letter, options) ON range % 4 = v.i"
    first = FIRST.replace("{c}", "subject")
    out["uniform_sample"] = f"SELECT item_id, subject FROM {first} ORDER BY md5(item_id::VARCHAR || '|11'), item_id LIMIT 100"
    out["stratified_sample"] = f"""
      WITH f AS (SELECT * FROM {first}), n AS (SELECT count(*) AS total FROM f),
      g AS (SELECT *, count(*) OVER (PARTITION BY subject) AS size, row_number() OVER (PARTITION BY subject ORDER BY md5(item_id::VARCHAR || '|11'), item_id) AS r FROM f WHERE subject IS NOT NULL)
      SELECT item_id, subject FROM g, n WHERE r <= least(size, greatest(1, round_even(size::DOUBLE / total * 100, 0)::BIGINT)) ORDER BY md5(item_id::VARCHAR || '|12'), item_id LIMIT 100"""
    pats = f"(SELECT DISTINCT {pattern} AS p FROM (SELECT unnest(options) AS o FROM {SEEDS}))"
    out["style_guidance"] = f"SELECT count(*) AS n_seeds, coalesce(floor(avg({words('question')})), 15)::INT AS avg_words, list_sort(list(DISTINCT {coarse('question')}))[1:3] AS subjects, (SELECT min(p) FROM {pats}) AS option_format FROM {SEEDS}"
    out["seed_audit"] = f"SELECT substr(question, 1, 50) || '...' AS question_preview, {hint('question')} AS subject_hint, sha256({CANONICAL['exams']}) AS hash FROM {SEEDS}"
    own, theirs = f"list_distinct({toks('e.question')})", f"list_distinct({toks('s.question')})"
    inter = f"len(list_intersect({own}, {theirs}))"
    out["seed_leakage_guard"] = f"SELECT item_id FROM exam_items e WHERE NOT EXISTS (SELECT 1 FROM {SEEDS} s WHERE e.question IS NOT NULL AND {inter}::DOUBLE / greatest(1, len({own}) + len({theirs}) - {inter}) > 0.2::DOUBLE)"
    sets = f"(SELECT item_id, question FROM exam_items UNION ALL SELECT -test_id - 1, question || ' more' FROM {SEEDS} UNION ALL SELECT -test_id - 100001, array_to_string({toks('question')}[1:greatest(1, floor(len({toks('question')}) * 0.5)::INT)], ' ') FROM {SEEDS})"
    out["seed_guard_default"] = f"SELECT item_id FROM {sets} e WHERE NOT EXISTS (SELECT 1 FROM {SEEDS} s WHERE e.question IS NOT NULL AND {inter}::DOUBLE / greatest(1, len({own}) + len({theirs}) - {inter}) > 0.7::DOUBLE)"
    nearest = f"""
      WITH q AS (SELECT DISTINCT question FROM exam_items), a AS (SELECT question, unnest(list_distinct({toks('question')})) AS w, len(list_distinct({toks('question')})) AS n FROM q),
      b AS (SELECT test_id, unnest(list_distinct({toks('question')})) AS w, len(list_distinct({toks('question')})) AS n FROM eval_items),
      j AS (SELECT a.question, test_id, count(*) AS i, any_value(a.n) AS na, any_value(b.n) AS nb FROM a JOIN b USING (w) GROUP BY 1, 2),
      m AS (SELECT question, max(i::DOUBLE / (na + nb - i)) AS overlap FROM j GROUP BY 1),
      o AS (SELECT item_id, coalesce(overlap, 0.0::DOUBLE) AS overlap FROM exam_items LEFT JOIN m USING (question))"""
    out["nearest_real_overlap"] = nearest + " SELECT item_id, overlap FROM o"
    out["privacy_report"] = nearest + " SELECT max(overlap) AS max_overlap, avg(overlap) AS mean_overlap, avg((overlap >= 0.8::DOUBLE)::INT) AS share_over_threshold, 0.8::DOUBLE AS threshold FROM o"
    stats = f"coalesce(avg({words('question')}), 0) AS mean_len, coalesce(stddev_pop({words('question')}), 0) AS std_len"
    out["fidelity_lengths"] = f"SELECT {stats}, 'synthetic' AS side FROM exam_items UNION ALL SELECT {stats}, 'real' AS side FROM eval_items"
    out["answer_distribution"] = f"SELECT label, n, p FROM {P('exam_items')}"
    out["answer_l1"] = f"SELECT sum(abs(a.p - b.p)) AS l1 FROM {P('exam_items')} a JOIN {P('eval_items')} b USING (label)"
    out["corpus_ttr"] = f"SELECT count(t) AS tokens, count(DISTINCT t) AS types, count(DISTINCT t)::DOUBLE / greatest(1, count(t)) AS ttr FROM (SELECT unnest({toks('text')}) AS t FROM sentiment_items)"
    va, vb = (f"(SELECT DISTINCT unnest({toks('question')}) AS t FROM {x})" for x in ("exam_items", "eval_items"))
    out["vocab_jaccard"] = f"SELECT count(a.t) AS size_a, count(b.t) AS size_b, count(CASE WHEN a.t = b.t THEN 1 END) AS shared, count(CASE WHEN a.t = b.t THEN 1 END)::DOUBLE / greatest(1, count(*)) AS jaccard FROM {va} a FULL JOIN {vb} b ON a.t = b.t"
    out["subject_distribution"] = f"SELECT label, count(*) AS n, count(*)::DOUBLE / sum(count(*)) OVER () AS p FROM (SELECT {coarse('question')} AS label FROM exam_items) GROUP BY 1"
    for task in ("exams", "grammar"):
        out[f"eval_{task}"] = f"SELECT count(*) AS num_items, avg({words(MAIN[task])}) AS avg_words, coalesce(stddev_samp({words(MAIN[task])}), 0) AS stdev_words FROM {TABLES[task]}"
    out["eval_exams_answers"] = "SELECT answer AS value, count(*) AS n FROM exam_items GROUP BY 1"
    out["eval_sentiment"] = "SELECT count(*) AS num_items, count(*) FILTER (coalesce(sentiment, '') = '') AS missing_sentiments FROM sentiment_items"
    out["eval_sentiment_labels"] = f"SELECT {strip('lower(sentiment)')} AS value, count(*) AS n FROM sentiment_items GROUP BY 1"
    once = lambda t, cs: f"SELECT item_id, {', '.join(f'any_value({c}) AS {c}' for c in cs)} FROM {t} GROUP BY item_id"
    out["export_metadata"] = f"SELECT *, 'grammar' AS _task, 'tutor' AS _persona, 'b1' AS _batch_id FROM ({once('grammar_items', ['input', 'correction'])})"
    out["export_csv"] = f"SELECT item_id, nullif(question, '') AS question, grade, 'exams' AS _task, 'b1' AS _batch_id, CASE WHEN options IS NOT NULL THEN len(options) > 0 END AS listed FROM ({once('exam_items', ['question', 'options', 'grade'])})"
    out["jsonl_round_trip"] = once("exam_items", ["question", "options", "answer", "notes"])
    out["exam_csv_round_trip"] = f"SELECT item_id, grade, subject, 'Arabic' AS language FROM ({once('exam_items', ['grade', 'subject'])})"
    out["parse_meta"] = "SELECT item_id, CASE WHEN subject IS NOT NULL THEN grade END AS grade, subject, CASE WHEN subject IS NOT NULL THEN 'Arabic' END AS language FROM exam_items"
    # DuckDB's lambda syntax.
    return {k: re.sub(r"\b([a-z]+) -> ", r"lambda \1: ", v) for k, v in out.items()}
