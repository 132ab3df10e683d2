"""Every query with SQL gives the rows that DuckDB gives; the others give rows."""

import pytest
from conftest import SF, canonical

from quire.queries import corpus, files, inline, ranges, retrieval, streams, texts

ALL = corpus.QUERIES | inline.QUERIES | files.QUERIES | retrieval.QUERIES | streams.QUERIES | texts.QUERIES | ranges.QUERIES
SQL = corpus.SQL | inline.SQL | files.SQL | retrieval.SQL | streams.SQL | texts.SQL | ranges.SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, duck, name):
    got = ALL[name](spark, SF)
    want = duck.sql(SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got.collect(), got.columns) == canonical(want.fetchall(), want.columns)


@pytest.mark.parametrize("name", sorted(set(ALL) - set(SQL)))
def test_gives_rows(spark, name):
    assert ALL[name](spark, SF).count() > 0
