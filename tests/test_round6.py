"""Reports read the deduplicated lines with the columns that they take, and groups with the last join's key are not shuffled again."""

import datetime as dt

from pyspark.sql import functions as F
from test_round3 import published, sales_tables

from sellake.operators import reports
from sellake.plans.lake import Lake
from sellake.plans.registry import QUERIES

REPORTS = ["G20_period_summary", "G2_activable_rif_90d", "G5_weekly_frequency", "G7_zero_sale_sku", "G9_sellout_yoy", "K3_skus_per_invoice", "K12_activated_list"]


def test_reports_do_not_build_the_wide_lines(spark):
    lk = Lake(spark, sales_tables(spark))
    rows = {name: QUERIES[name](spark, lk.d).count() for name in REPORTS}
    assert "coded_lines" in published(spark, lk.key) and not {"lines", "sil_ventas"} & published(spark, lk.key)
    assert rows["G20_period_summary"] == rows["K3_skus_per_invoice"] == 2 and rows["G5_weekly_frequency"] == rows["G9_sellout_yoy"] == 3
    months = {r.anio_mes: (r.total_renglones, r.total_facturas, r.clientes_compradores, r.vendedores_activos, r.cajas_vendidas) for r in QUERIES["G20_period_summary"](spark, lk.d).collect()}
    assert months == {"1999-03": (2, 1, 1, 1, 1.0), "1998-02": (1, 1, 1, 1, 0.5)}


def test_narrow_facts_have_the_rows_of_the_fact(spark):
    lk = Lake(spark, sales_tables(spark))
    whole = lk.fct_ventas
    for fact in (lk.coded_fact.drop("can_ven", "cod_pro", "cod_mar", "nom_cli", "rif", "nom_art", "modelo", "nom_ven", "nom_pro", "nom_mar"),
                 lk.measured_fact.drop("nom_cli", "rif", "nom_ven", "nom_pro", "nom_mar"), lk.article_fact.drop("nom_cli", "rif"), lk.client_fact):
        cols = sorted(fact.columns)
        assert fact.select(cols).schema.simpleString() == whole.select(cols).schema.simpleString()
        assert sorted(fact.select(cols).collect(), key=repr) == sorted(whole.select(cols).collect(), key=repr) and fact.count() == 3


def test_last_year_by_a_window_is_that_of_the_join(spark):
    d = dt.date
    rows = [("a", "x", d(2000, 2, 29), 1.0), ("a", "x", d(2001, 2, 28), 2.0), ("a", "y", d(2001, 2, 28), 4.0), ("a", "z", d(2000, 2, 28), 8.0),
            (None, "x", d(2000, 3, 1), 1.0), (None, "x", d(2001, 3, 1), 2.0), ("a", "x", d(2002, 2, 28), None)]
    daily = spark.createDataFrame(rows, "k string, name string, fecha date, v double")
    prev = daily.groupBy("k", F.add_months("fecha", 12).alias("fecha_equivalente")).agg(F.round(F.sum("v"), 2).alias("_p"))
    want = reports.same_day_last_year(daily, prev, ["k"]).select("k", "name", "fecha", "v", "_p")
    got = reports.with_last_year(daily, ["k"], {"v": "_p"}).select("k", "name", "fecha", "v", "_p")
    assert sorted(got.collect(), key=repr) == sorted(want.collect(), key=repr)
    assert {(r.name, r.fecha): r._p for r in got.collect()}[("x", d(2001, 2, 28))] == 9.0


def test_groups_with_the_key_of_the_last_join_are_not_shuffled(spark):
    lk = Lake(spark, sales_tables(spark))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    lk.article_fact, lk.client_fact  # layers are written
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = {"vendedores", "proveedores", "marcas"}
        for n in small:
            lk._sil[n] = F.broadcast(lk.sil(n))
        plans = (reports.sellout_last_year(reports.sellout_daily(lk.__class__.article_fact.func(lk))), "cod_art"), (reports.weekly_frequency(lk.__class__.client_fact.func(lk), lk.branches.limit(0)), "cod_cli")
        for df, key in plans:
            plan = df._jdf.queryExecution().executedPlan().toString()
            dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
            assert dealt and not [line for line in dealt if any(c in line for c in ("member", "fecha", "_day", "documento"))], plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
