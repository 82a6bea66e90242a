"""Every registered query against its oracle, at the smallest scale."""

import pytest

import __spark_entry__ as entry
from compare import difference, oracle_connection, oracle_rows, spark_rows

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF_DIR)


def test_every_query_has_an_oracle():
    texts = entry._text_queries()  # those beyond SQL have tests of their own
    assert set(entry.oracle_sql()) >= set(entry.queries()) - set(texts.QUERIES if texts else ())


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_query_matches_oracle(name, spark, con):
    found = spark_rows(entry.queries()[name](spark, SF_DIR))
    assert difference(found, oracle_rows(con, entry.oracle_sql()[name])) == ""
    assert found[1]


def test_entry_runs(spark):
    top = entry.entry(spark)
    totals = [r["total_all_impressions"] for r in top.collect()]
    assert totals and totals == sorted(totals, reverse=True)
