"""Queries of the training-data operators over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nasaq.llm import abuse, contamination, lookalikes, mixing, packing, pairs, sampling
from nasaq.llm.formatting import FormattingCopies
from nasaq.llm.items import ITEMS, main_texts, output_texts
from nasaq.llm.labels import answer_label, sentiment_label
from nasaq.llm.near_duplicates import NearDuplicates
from nasaq.llm.tokens import token_counts, usable
from nasaq.session import checkpointed
from nasaq.sources.tables import table


def _formatting(spark: SparkSession, d: str) -> FormattingCopies:
    """Records that can be cases: exams of four options, sentiment texts; others, and those with a null or blank part, are left out."""
    exams = table(spark, d, "exam_items").where("size(options) = 4").select(
        F.lit("exams").alias("task"), "item_id", F.concat(F.array("question"), "options").alias("parts")
    )
    sentiment = table(spark, d, "sentiment_items").select(
        F.lit("sentiment").alias("task"), "item_id", F.array("text").alias("parts")
    )
    return FormattingCopies(exams.unionByName(sentiment))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _formatting(spark, d).copies()


def p1_collapsed(spark: SparkSession, d: str) -> DataFrame:
    return _formatting(spark, d).collapsed()


def _near_duplicates(spark: SparkSession, d: str) -> NearDuplicates:
    return NearDuplicates(main_texts(spark, d).withColumnRenamed("item_id", "id"))


def p3_groups(spark: SparkSession, d: str) -> DataFrame:
    groups = _near_duplicates(spark, d).run()
    return groups.select("task", F.col("id").alias("item_id"), "group_id", "links").distinct()


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    groups = _near_duplicates(spark, d).groups()
    return groups.where("id <> group_id").select("task", "group_id", F.col("id").alias("item_id")).distinct()


def _eval_texts(spark: SparkSession, d: str) -> DataFrame:
    return contamination.item_text(table(spark, d, "eval_items"))


def p4_leaks(spark: SparkSession, d: str) -> DataFrame:
    return contamination.leaks(table(spark, d, "documents"), _eval_texts(spark, d))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return p4_leaks(spark, d).select("doc_id", "test_id")


def p4_cleaned(spark: SparkSession, d: str) -> DataFrame:
    return contamination.without_leaks(table(spark, d, "documents"), _eval_texts(spark, d))


def _unified(spark: SparkSession, d: str, only_changed: bool) -> DataFrame:
    texts = output_texts(spark, d)
    rewriting = lookalikes.corpus_rewriting(texts.select("text"))
    return lookalikes.unified(texts, ["task", "item_id"], "text", rewriting, only_changed)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return _unified(spark, d, only_changed=True).select("task", "item_id").distinct()


def p5_unified(spark: SparkSession, d: str) -> DataFrame:
    return _unified(spark, d, only_changed=False).select("task", "item_id", "unified", "changed").distinct()


def _sample(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    exams = table(spark, d, "exam_items").select(F.lit("exams").alias("task"), "item_id", answer_label("answer").alias("category"))
    sentiment = table(spark, d, "sentiment_items").select(
        F.lit("sentiment").alias("task"), "item_id", sentiment_label("sentiment").alias("category")
    )
    return sampling.sample(exams.unionByName(sentiment), table(spark, d, "sample_targets"))


def p6_sample(spark: SparkSession, d: str) -> DataFrame:
    return _sample(spark, d)[0]


def p6_report(spark: SparkSession, d: str) -> DataFrame:
    return _sample(spark, d)[1]


def p7_packed(spark: SparkSession, d: str) -> DataFrame:
    sizes = token_counts(usable(table(spark, d, "documents")))
    return packing.pack(sizes, table(spark, d, "pack_sizes"))


def p7_usage(spark: SparkSession, d: str) -> DataFrame:
    return packing.usage(p7_packed(spark, d), table(spark, d, "pack_sizes"))


def _mix(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    sizes = checkpointed(token_counts(usable(table(spark, d, "documents")), keep=("doc_id", "source")))
    return mixing.mix(sizes, table(spark, d, "mix_targets"))


def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    return _mix(spark, d)[0]


def p8_report(spark: SparkSession, d: str) -> DataFrame:
    return _mix(spark, d)[1]


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return pairs.defects(table(spark, d, "grammar_items"), table(spark, d, "documents"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return abuse.flagged(table(spark, d, "documents"), table(spark, d, "doc_labels")).select("doc_id")


def p9_scores(spark: SparkSession, d: str) -> DataFrame:
    return abuse.scores(table(spark, d, "documents"))


def p9_rates(spark: SparkSession, d: str) -> DataFrame:
    return abuse.rates(table(spark, d, "documents"), table(spark, d, "doc_labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p1_collapsed, p2_found, p3_found, p3_groups, p4_found, p4_leaks, p4_cleaned, p5_found, p5_unified, p6_sample, p6_report, p7_packed, p7_usage, p8_mix, p8_report, p9_found, p9_scores, p9_rates)}


#: The marks that contamination.VOWEL_MARKS leaves out, in DuckDB's escapes.
_MARKS = r"[\x{0610}-\x{061a}\x{064b}-\x{0652}\x{0656}-\x{065f}\x{0670}\x{06d6}-\x{06dc}\x{06df}-\x{06e4}\x{06e7}\x{06e8}\x{06ea}-\x{06ed}]+"

#: A letter with brackets around it or a mark after it.
_LABEL = r"^\s*(\(\s*[A-Ea-e]\s*\)|\[\s*[A-Ea-e]\s*\]|[A-Ea-e]\s*[.):\-–—]+)\s*"


def _runs(key: str, text: str, source: str) -> str:
    """All runs of eight words: each word with the seven that follow it."""
    words = rf"regexp_extract_all(regexp_replace(lower(nfc_normalize({text})), '{_MARKS}', '', 'g'), '[\p{{L}}\p{{N}}]+')"
    following = " || ' ' || ".join(f"lead(w, {k}) OVER p" if k else "w" for k in range(8))
    each = f"SELECT {key}, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM (SELECT {key}, {words} AS w FROM {source})"
    return f"(SELECT DISTINCT {key}, run FROM (SELECT {key}, {following} AS run FROM ({each}) WINDOW p AS (PARTITION BY {key} ORDER BY i)) WHERE run IS NOT NULL)"


#: Code points of the ligatures that the SQL resolves.
_LIGATURES = [*range(0xFB00, 0xFB07), *range(0xFEF5, 0xFEFD)]
#: Punctuation and white space.
_NOISE = r"[\p{P}\s\p{Z}\x{85}\x{1c}-\x{1f}]+"


def _as_it_looks(c: str) -> str:
    """A text in its one form, without regard to the script of the word around a letter."""
    plain = lookalikes.representatives()
    single = {v: p for v, p in plain.items() if len(v) == 1 and len(p) <= 1 and v not in "\0'"}
    order = sorted(single, key=lambda v: not single[v])  # what is left over at the end is deleted
    to = "".join(single[v] for v in order).replace("'", "''")
    c = f"translate(nfc_normalize({c}), '{''.join(order)}', '{to}')"
    for cp in _LIGATURES:
        if plain.get(chr(cp)):
            c = f"replace({c}, chr({cp}), '{plain[chr(cp)]}')"
    return f"nfc_normalize({c})"


def _formatting_sql() -> str:
    """A CTE ``c`` (task, item_id, canonical)."""
    bare = lambda x: f"regexp_replace(lower({x}), '{_NOISE}', '', 'g')"
    option = bare(f"regexp_replace(o, '{_LABEL}', '')")
    return f"""
      p AS (SELECT 'exams' AS task, item_id, list_concat([question], options) AS parts FROM exam_items WHERE len(options) = 4
            UNION ALL SELECT 'sentiment', item_id, [text] FROM sentiment_items),
      l AS (SELECT task, item_id, list_transform(parts, lambda x: {_as_it_looks('x')}) AS parts FROM p WHERE len(list_filter(parts, lambda x: x IS NULL OR x = '')) = 0),
      f AS (SELECT task, item_id, {bare('parts[1]')} AS first, list_sort(list_transform(parts[2:], lambda o: {option})) AS options FROM l),
      c AS (SELECT DISTINCT task, item_id, first || chr(1) || coalesce(array_to_string(options, chr(1)), '') AS canonical FROM f WHERE first <> '' AND NOT list_contains(options, '')),
      k AS (SELECT *, min(item_id) OVER (PARTITION BY task, canonical) AS keep_id FROM c)"""


def _near_duplicates_sql() -> str:
    each = " UNION ALL ".join(f"SELECT '{t}' AS task, item_id, {c} AS text FROM {name}" for t, name, c, _ in ITEMS)
    return f"""
      WITH RECURSIVE t AS ({each}),
      w AS (SELECT DISTINCT task, item_id, list_sort(list_distinct(list_filter(regexp_split_to_array(regexp_replace(lower({_as_it_looks('text')}), '{_NOISE}', ' ', 'g'), ' +'), lambda x: x <> ''))) AS words
            FROM t WHERE text IS NOT NULL),
      s AS (SELECT task, words, min(item_id) AS id, len(words) AS n FROM w WHERE len(words) > 0 GROUP BY task, words),
      e AS (SELECT task, id, n, unnest(words) AS word FROM s),
      pairs AS (SELECT a.task, a.id AS a, b.id AS b FROM e a JOIN e b ON a.task = b.task AND a.word = b.word AND a.id < b.id AND least(a.n, b.n) >= 0.7 * greatest(a.n, b.n) - 1e-9
                GROUP BY a.task, a.id, b.id, a.n, b.n HAVING count(*)::DOUBLE / (a.n + b.n - count(*)) >= 0.7 - 1e-9),
      links AS (SELECT task, a, b FROM pairs UNION SELECT task, b, a FROM pairs),
      reach AS (SELECT task, a, b FROM links UNION SELECT r.task, r.a, l.b FROM reach r JOIN links l ON r.task = l.task AND r.b = l.a),
      root AS (SELECT task, a AS id, min(b) AS low FROM reach GROUP BY task, a),
      g AS (SELECT w.task, w.item_id, least(s.id, coalesce(root.low, s.id)) AS group_id FROM w JOIN s ON w.task = s.task AND w.words = s.words LEFT JOIN root ON root.task = s.task AND root.id = s.id)
      SELECT DISTINCT task, group_id, item_id FROM g WHERE item_id <> group_id"""


def oracle_sql() -> dict[str, str]:
    """SQL where it can express the operator; the others are tested against brute force."""
    docs = _runs("doc_id", "text", "documents")
    items = _runs("test_id", rf"concat_ws(chr(10), question, array_to_string(list_transform(options, lambda o: regexp_replace(o, '{_LABEL}', '')), chr(10)))", "eval_items")
    copies = f"WITH {_formatting_sql()}"
    return {
        "p1_found": f"{copies} SELECT DISTINCT task, keep_id, item_id AS copy_id FROM k WHERE item_id <> keep_id",
        "p1_collapsed": f"{copies} SELECT task, keep_id, count(DISTINCT item_id) AS n_copies FROM k GROUP BY task, keep_id",
        "p3_found": _near_duplicates_sql(),
        "p4_found": f"SELECT DISTINCT doc_id, test_id FROM {docs} JOIN {items} USING (run)",
    }
