"""Layers are written in bounded tasks; the cutover facts, Q4 and the BI fact shuffle the columns that they give."""

import datetime as dt

from pyspark.sql import functions as F
from test_round3 import published, sales_tables

from sellake.operators import facts
from sellake.plans import materialize
from sellake.plans.lake import Lake
from sellake.plans.registry import QUERIES
from sellake.session import TASK_SHUFFLE_BYTES, bounded_tasks

SETTINGS = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"]


def now(spark):
    return [spark.conf.get(n, None) for n in SETTINGS]


def test_tasks_of_a_layer_stay_small_and_settings_come_back(spark):
    before, seen = now(spark), []
    with bounded_tasks(spark, 600 << 20):
        assert spark.conf.get(SETTINGS[0]) == "300" and int(spark.conf.get(SETTINGS[1])) == TASK_SHUFFLE_BYTES
        with bounded_tasks(spark, 0):  # a job within: the same scope
            assert spark.conf.get(SETTINGS[0]) == "300"
        assert spark.conf.get(SETTINGS[0]) == "300"
    assert now(spark) == before
    d = sales_tables(spark)
    assert materialize.source_bytes(spark, d) > 0
    add = F.udf(lambda x: x, "long")  # planned and run inside the write
    df = materialize.table(spark, "bounded", dt.datetime.now().isoformat().replace(":", ""), lambda: seen.append(now(spark)) or spark.range(100).select(add("id").alias("id")).groupBy("id").count(), source_size=40 << 20)
    assert df.count() == 100 and now(spark) == before == seen[0]
    try:
        with bounded_tasks(spark, 40 << 20):
            assert spark.conf.get(SETTINGS[0]) == "20"
            raise ValueError
    except ValueError:
        assert now(spark) == before


def test_lines_are_not_sorted_for_a_small_side(spark):
    """Both sides are too large for a broadcast: the smaller one is hashed, the lines stay unsorted."""
    big = spark.range(20000).selectExpr("id % 500 AS k", "id AS v").repartition(4)
    small = spark.range(500).selectExpr("id AS k", "'x' || id AS n").repartition(4)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with bounded_tasks(spark, 0):
            out = big.join(small, "k", "left")
            assert len(out.collect()) == 20000
            assert "ShuffledHashJoin" in out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_cutover_facts_write_narrow_lines_and_give_the_same_rows(spark):
    lk = Lake(spark, sales_tables(spark))
    assert QUERIES["M11_fct_gold"](spark, lk.d).count() == QUERIES["J2_inner_calendar"](spark, lk.d).count() == 3 and QUERIES["Q4_quality_results"](spark, lk.d).count() > 3
    assert QUERIES["M12_fct_bi"](spark, lk.d).count() == 2
    assert {"cutover_ventas", "checked_ventas", "bi_ventas"} <= published(spark, lk.key) and "sil_ventas" not in published(spark, lk.key)
    cols = [*lk.FACT_COLS, "origen", "cod_alm_resolution"]
    rows = lambda df: sorted(map(str, df.collect()))
    whole = facts.fct_gold(facts.fct_pre_cutover(lk.sil_ventas, lk.snapshot_lines, lk.CUTOVER, lk.SNAPSHOT_UNTIL), facts.fct_post_cutover(lk.sil_ventas, lk.CUTOVER)[0])
    assert rows(lk.fct_gold.select(*cols)) == rows(whole.select(*cols))
    names = ["clientes", "articulos", "vendedores", "proveedores", "estados", "ciudades", "marcas", "departamentos"]
    assert rows(lk.fct_bi) == rows(facts.fct_bi(whole, "1999-01-01", lk.as_of, {n: lk.sil(n) for n in names}))
    assert rows(lk.checked_ventas) == rows(lk.sil_ventas.select(*lk.checked_ventas.columns)) and lk.checked_ventas.where("cod_pro is null").count() == 0


def test_the_article_gives_a_blank_supplier_only_where_asked(spark):
    lk = Lake(spark, sales_tables(spark))
    names = ["clientes", "articulos", "vendedores", "proveedores", "estados", "ciudades", "marcas", "departamentos"]
    masters = {n: lk.sil(n) for n in names}
    gold = lk.sil_ventas.withColumns({"origen": F.when(F.col("renglon") == 1, F.lit("SILVER")).otherwise(F.lit("SNAPSHOT")), "cod_pro": F.when(F.col("documento") == "2", F.lit("2")).otherwise(F.lit(" "))})
    got = lambda **k: {(r.documento, int(r.renglon)): (r.cod_pro, r.nom_pro) for r in facts.fct_bi(gold, "1990-01-01", lk.as_of, masters, **k).collect()}
    assert got() == {("1", 1): (" ", None), ("1", 2): (" ", None), ("2", 1): ("2", "S2")}
    assert got(article_supplier=F.col("origen") == "SILVER") == {("1", 1): ("5", "S5"), ("1", 2): (" ", None), ("2", 1): ("2", "S2")}
