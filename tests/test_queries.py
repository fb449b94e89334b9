"""The registered queries: names, SQL and agreement on the smallest data."""

import os

import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
NO_DATA = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data here")


def test_sql_only_for_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@NO_DATA
def test_entry(spark):
    assert entry.entry(spark).count() == 20


@NO_DATA
@pytest.mark.parametrize("name", ["corpus_totals", "tokenize_en", "top_bigrams", "lexicon_merge", "key_ranks", "translation_index", "parent_closure", "search_edit", "book_pages", "word_features", "translation_assoc", "section_translations"])
def test_agrees_with_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for file in os.listdir(DATA):
        con.execute(f"create view {file.removesuffix('.parquet')} as select * from '{DATA}/{file}'")
    df = entry.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    result = con.execute(entry.oracle_sql()[name])
    at = [[d[0] for d in result.description].index(c) for c in columns]

    def plain(v):
        return round(v, 8) if isinstance(v, float) else v

    want = sorted((tuple(plain(r[i]) for i in at) for r in result.fetchall()), key=repr)
    assert sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr) == want
