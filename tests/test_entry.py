"""Driver contract: entry runs, every query has a callable, oracle keys are a subset."""
import __spark_entry__ as E


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"fiscal_year", "category", "net_sales", "gross_margin_pct", "transaction_count"}


def test_registry_shape():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert sum(not name.startswith("op") and name != "pipeline" for name in q) >= 39
