"""Driver contract: entry runs, every query has an oracle, and a sample of queries runs on sf0.001."""

import __spark_entry__ as E

from conftest import SF


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "venta_usd" in df.columns


def test_every_query_has_an_oracle():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    own = {k for k in q if not k.startswith("op") and k != "pipeline"}
    assert own <= set(o)


def test_sample_queries_run(spark):
    q = E.queries()
    for name in ["M3_silver_sales", "T7_fact_scd2", "K10_monthly_activation", "B1_missing_windows", "P10_geo_density"]:
        assert q[name](spark, SF).count() >= 0
