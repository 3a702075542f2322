"""Driver contract: entry runs; every query has a callable; oracles are a subset."""

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "recording_filename" in df.columns


def test_registry_consistent():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 55
    from annolake.plans.queries import QUERIES
    assert set(QUERIES) <= set(q) and set(QUERIES) <= set(o)


def test_every_query_builds_with_oracle_columns(spark):
    """Each registered query builds on sf0.001 and (when it has one) its oracle
    names the same columns."""
    import duckdb

    from tests.conftest import SF_SMALL
    con = duckdb.connect()
    for t in ("customer nation orders lineitem events documents labels conversations").split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    from annolake.plans.queries import QUERIES
    o = E.oracle_sql()
    for name, fn in QUERIES.items():
        cols = fn(spark, SF_SMALL).columns
        assert cols, name
        if name in o:
            assert sorted(cols) == sorted(con.sql(o[name]).columns), name
