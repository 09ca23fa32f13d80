import __spark_entry__ as entry


def test_entry_runs_and_queries_have_sql(spark):
    q, sql = entry.queries(), entry.oracle_sql()
    assert "triage_rank" in q and set(sql) <= set(q) and len(q) > 80
    df = entry.entry(spark)
    assert df.count() > 0 and "score" in df.columns
