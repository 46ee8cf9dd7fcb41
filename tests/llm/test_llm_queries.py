"""The queries of this subpackage over the smallest test data, and their SQL."""

import os

import pytest

from nasaq.llm import queries as Q

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
#: Columns that TESTDATA fixes, and those of the other queries.
COLUMNS = {
    "p1_found": {"task", "keep_id", "copy_id"}, "p1_collapsed": {"task", "keep_id", "n_copies"}, "p2_found": {"item_id", "defect"}, "p3_found": {"task", "group_id", "item_id"},
    "p3_groups": {"task", "item_id", "group_id", "links"}, "p4_found": {"doc_id", "test_id"}, "p4_leaks": {"doc_id", "test_id", "longest", "coverage"}, "p4_cleaned": {"doc_id", "text", "removed_words"},
    "p5_found": {"task", "item_id"}, "p5_unified": {"task", "item_id", "unified", "changed"}, "p6_sample": {"sample_id", "task", "category", "item_id"}, "p7_packed": {"pack_id", "container", "doc_id", "piece", "start", "tokens"},
    "p7_usage": {"pack_id", "capacity_tokens", "containers", "tokens", "unused_share"}, "p8_mix": {"mix_id", "doc_id", "source", "tokens", "repeats"}, "p9_found": {"doc_id"},
    "p9_scores": {"doc_id", "source", "score", "weight", "abuse", "hate", "sexual"}, "p9_rates": {"source", "docs", "flagged", "rate", "mean_score"},
}


@pytest.mark.parametrize("name", sorted(set(Q.queries()) - set(Q.oracle_sql())))
def test_query_runs_over_the_tables(spark, name):
    df = Q.queries()[name](spark, DATA)
    assert COLUMNS.get(name, set(df.columns)) == set(df.columns)
    assert df.count() >= (name != "p9_found")  # none of the hundred documents is a case


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query_equals_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{DATA}/{f}'")
    want = con.execute(Q.oracle_sql()[name])
    names = [c[0] for c in want.description]
    df = Q.queries()[name](spark, DATA)
    assert set(names) == set(df.columns) == COLUMNS[name]
    assert sorted(map(tuple, df.select(*names).collect())) == sorted(want.fetchall())


def test_leaks_are_the_items_read_without_labels(spark):
    items = {r.test_id: r.text for r in Q._eval_texts(spark, DATA).collect()}
    assert items and not any(label in t for t in items.values() for label in ("A. ", "B. ", "C. ", "D. "))
