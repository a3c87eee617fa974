"""What the sales chain writes and shuffles: hashes as bytes, no wide table that is read once."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from sellake.functions.hashing import packed_hash, unpacked_hash
from sellake.operators import history, silver
from sellake.plans.lake import Lake
from sellake.session import checkpoint_dir


def sales_tables(spark) -> str:
    """One tenant, one customer, two parts, two orders of three lines."""
    d, day = tempfile.mkdtemp(), dt.datetime(1999, 3, 1)
    orders = [(1, 7, "O", 1.0, day, "4-NOT SPECIFIED"), (2, 7, "F", 1.0, dt.datetime(1998, 2, 5), "1-URGENT")]
    lines = [(o, p, 3, n, 2.0, 10.0 * n, 0.1, 0.05, "N", "O", day) for o, n, p in ((1, 1, 5), (1, 2, 6), (2, 1, 5))]
    for name, schema, rows in (
            ("region", "r_regionkey int, r_name string", [(0, "ASIA")]), ("nation", "n_nationkey int, n_name string, n_regionkey int", [(4, "JAPAN", 0)]),
            ("customer", "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string", [(7, "C7", 4, 1.0, "MACHINERY")]),
            ("supplier", "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double", [(k, f"S{k}", 4, 0.0) for k in range(8)]),
            ("part", "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
             [(k, f"P{k}", "B", "T", 4, 1.0) for k in (5, 6)]),
            ("orders", "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string", orders),
            ("lineitem", "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
             "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz", lines)):
        spark.createDataFrame(rows, schema).write.parquet(f"{d}/{name}.parquet")
    return d


def published(spark, key: str) -> set[str]:
    return {f.removesuffix(".published") for top, _, files in os.walk(checkpoint_dir(spark)) if os.path.basename(top) == key for f in files if f.endswith(".published")}


def test_the_fact_writes_one_wide_table(spark):
    lk = Lake(spark, sales_tables(spark))
    got = sorted((r.documento, r.renglon, r.nom_art, r.nom_cli, r.nom_pro, r.anio_mes, r.cajas_vendidas) for r in lk.fct_ventas.collect())
    assert [(d, int(n), a, c, p, m, float(x)) for d, n, a, c, p, m, x in got] == [
        ("1", 1, "P5", "C7", "S5", "1999-03", 0.5), ("1", 2, "P6", "C7", "S6", "1999-03", 0.5), ("2", 1, "P5", "C7", "S5", "1998-02", 0.5)]
    assert "lines" in published(spark, lk.key)
    assert not {"stg_ventas_union", "sil_ventas", "fct_ventas"} & published(spark, lk.key)
    assert lk.sil_ventas.count() == 3 and lk.sil_ventas_split[1].count() == 0
    assert "stg_ventas_union" not in published(spark, lk.key)


def test_a_hash_goes_through_the_shuffle_as_bytes(spark):
    hashes = ["0" * 64, "ab" * 32, "a" * 63 + "b", "f" * 64, "F" * 64, "x", "", None, "ab" * 32 + "\n", "ab" * 31]
    df = spark.createDataFrame([(h,) for h in hashes], "h string").select("h", packed_hash("h").alias("p"))
    assert sorted(map(str, [r.h for r in df.select(unpacked_hash("p").alias("h")).collect()])) == sorted(map(str, hashes))
    whole = [r.h for r in df.where("length(h) = 64 and h = lower(h)").orderBy("p").collect()]
    assert whole == sorted(whole) and len(whole) == 4
    assert {r.n for r in df.where("length(h) = 64 and h = lower(h)").select(F.length("p").alias("n")).collect()} == {33}
    rows = spark.createDataFrame([("k", "0a" * 32, 1), ("k", "b1" * 32, 2), ("k", None, 3), ("k", "9c" * 32, 4)], "k string, _row_hash string, v int")
    best = silver.latest_by_key(rows.withColumn("_ingested_at", F.lit(1)), ["k"])
    assert [(r.v, r._row_hash) for r in best.collect()] == [(2, "b1" * 32)] and best.columns == ["k", "_row_hash", "v", "_ingested_at"]
    assert "unhex" in best._jdf.queryExecution().executedPlan().toString()


def test_a_line_resolves_to_hex_and_other_keys(spark):
    dim = spark.createDataFrame([("ab" * 32, "t", "c", dt.datetime(2000, 1, 1), "r", "h1", False, "old"), ("plain", "t", "c", dt.datetime(2000, 3, 1), "r", "h2", True, "new")],
                                "surrogate_key string, source_empresa string, cod string, valid_from timestamp, run_id string, record_hash string, is_current boolean, nom string")
    at = [dt.datetime(1999, 5, 1), dt.datetime(2000, 2, 1), dt.datetime(2000, 4, 1), None]
    fact = spark.createDataFrame([(i, "t", "c", a) for i, a in enumerate(at)] + [(9, "t", "z", at[2])], "rid int, source_empresa string, cod string, registro timestamp")
    out = history.resolve(fact, {"d": (dim, "cod", "cod", ["nom"])}, "registro", "rid")
    got = {r.rid: (r.d_sk_asof, r.d_sk, r.d_resolution_status, r.current_nom) for r in out.collect()}
    assert got == {0: (None, "plain", history.BACKFILL, "new"), 1: ("ab" * 32, "ab" * 32, history.RESOLVED, "new"), 2: ("plain", "plain", history.RESOLVED, "new"),
                   3: (None, "plain", history.BACKFILL, "new"), 9: (None, "UNKNOWN", history.UNRESOLVED, None)}
    assert "unhex" in out._jdf.queryExecution().executedPlan().toString()


def test_masters_are_dealt_over_all_tasks_before_they_multiply(spark):
    """One small file is one task: its rows are dealt before the copies per tenant are made and sorted there."""
    from sellake.sources import erp_adapter as A

    d = sales_tables(spark)
    spark.range(100, 200).selectExpr("id p_partkey", "'P' || id p_name", "'B' p_brand", "'T' p_type", "4 p_size", "1d p_retailprice").coalesce(1).write.parquet(
        f"{d}/part.parquet", mode="overwrite")
    for df, n in ((A.stg_articulos(spark, d), 100), (A.stg_proveedores(spark, d), 8), (A.stg_almacenes(spark, d), 8), (A.stg_clientes(spark, d), 1)):
        assert "RoundRobinPartitioning(4)" in df._jdf.queryExecution().executedPlan().toString() and df.count() == n
    codes = A.stg_articulos(spark, d).select("cod_art", F.spark_partition_id().alias("p"))
    assert codes.select("p").distinct().count() == 4 and codes.select("cod_art").distinct().count() == 100
