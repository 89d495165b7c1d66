import oracle_check
from conftest import SF_SMALL


def test_entry_runs(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["n_points", "k", "parts", "iters", "objective"]
    assert len(rows) == 1


def test_every_query_has_sql(spark):
    import __spark_entry__ as E

    assert set(E.QUERIES) == set(E.ORACLE_SQL)
    assert set(E.QUERIES) <= set(E.queries()) and set(E.ORACLE_SQL) <= set(E.oracle_sql())


def test_queries_match_sql_small(spark):
    import __spark_entry__ as E

    con = oracle_check.duck(SF_SMALL)
    bad = []
    for name, sql in E.oracle_sql().items():
        fn = E.queries()[name]
        ok, n, _, detail = oracle_check.compare(spark, con, name, fn, sql, SF_SMALL)
        if not ok:
            bad.append((name, detail))
    assert not bad, bad
