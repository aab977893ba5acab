import duckdb
import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def tables_sql():
    """The tables as views of a DuckDB connection."""
    con = duckdb.connect()
    for name in "documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return con
