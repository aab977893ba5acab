"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest
from common import SMALL, TABLES

import __spark_entry__ as contract


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return con


def ordered(rows):
    return sorted(rows, key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_matches_sql(spark, sql, name):
    df = contract.queries()[name](spark, SMALL)
    columns = sorted(df.columns)
    got = [tuple(row[c] for c in columns) for row in df.collect()]
    cursor = sql.execute(contract.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    want = [tuple(row[i] for i in at) for row in cursor.fetchall()]
    assert len(got) == len(want) > 0
    assert ordered(got) == ordered(want)


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0


def test_ordered_results_are_in_order(spark):
    price = [r.price for r in contract.queries()["topn_after_sort"](spark, SMALL).collect()]
    assert price == sorted(price, reverse=True) and len(price) == 10
    names = [(r.name, r.id) for r in contract.queries()["sort_by_value"](spark, SMALL).collect()]
    assert names == sorted(names)
    words = [(-r.n, r.w) for r in contract.queries()["wc_stopwords_desc"](spark, SMALL).collect()]
    assert [n for n, _ in words] == sorted(n for n, _ in words)
