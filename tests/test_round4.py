"""What the sales chain, the rejects and the control log move: numbers as landed until the last shuffle, no wide table that only counts."""

import datetime as dt
import tempfile

from pyspark.sql import functions as F
from test_round3 import published, sales_tables

from sellake import contracts as C
from sellake.operators import facts, land, silver
from sellake.plans.lake import Lake
from sellake.plans.registry import QUERIES
from sellake.sources import erp_adapter as A

E2, E3, T0 = C.SALES["v2"], C.SALES["v3"], dt.datetime(2024, 1, 1)
KEY = ["source_empresa", "tipo_documento", "cod_suc", "documento", "renglon"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def union_rows(spark, rows):
    """Rows of the widest contract: given values, else a text or number that passes."""
    base = {c.name: 1.5 if c.type == "number" else "2024-01-01T00:00:00.0000000" if c.type == "timestamp" else "x" for c in E2.columns}
    schema = ", ".join(f"{c.name} {'double' if c.type == 'number' else 'string'}" for c in E2.columns) + ", source_empresa string, _ingested_at timestamp, _row_hash string, _priority int"
    full = [base | {"source_empresa": "t", "_ingested_at": T0, "_row_hash": "0a" * 32, "_priority": 1} | r for r in rows]
    names = [*E2.names, "source_empresa", "_ingested_at", "_row_hash", "_priority"]
    return spark.createDataFrame([tuple(r[n] for n in dict.fromkeys(names)) for r in full], schema)


def test_silver_numbers_are_cleaned_after_the_last_shuffle(spark):
    u = union_rows(spark, [{"renglon": 1.0, "neto": 2.25, "_row_hash": "b1" * 32}, {"renglon": 1.0, "neto": 7.5, "_row_hash": "9c" * 32}, {"renglon": 2.0, "neto": None},
                           {"renglon": 3.0, "neto": 1e17, "cod_pro": "  "}, {"renglon": 4.0, "documento": " "}])
    art = spark.createDataFrame([("t", "x", "P1")], "source_empresa string, cod_art string, cod_pro string")
    current, rejects = silver.current_sales(u)
    types = dict(current.dtypes)
    assert types["neto"] == "double" and types["renglon"].startswith("decimal") and types["_row_hash"] == "binary"
    out, rej = silver.silver_sales(u, art)
    got = {int(r.renglon): (None if r.neto is None else float(r.neto), r.cod_pro, r._row_hash) for r in out.collect()}
    assert got == {1: (2.25, "x", "b1" * 32), 2: (None, "x", "0a" * 32), 3: (1e17, "P1", "0a" * 32)}
    assert dict(out.dtypes)["neto"] == "decimal(28,10)" and dict(out.dtypes)["_row_hash"] == "string"
    assert rej.count() == rejects.count() == 1
    # without a hash, ties are broken by the cleaned values as before
    assert dict(silver.current_sales(u.drop("_row_hash"))[0].dtypes)["neto"] == "decimal(28,10)"


def test_customers_meet_the_lines_before_the_article_names(spark):
    lk = Lake(spark, sales_tables(spark))
    sales = spark.createDataFrame([("t", "1", " ", None), ("t", "1", "own", "J-9"), ("t", "2", None, " "), (None, "1", None, None)], "source_empresa string, cod_cli string, nom_cli string, rif string")
    clients = spark.createDataFrame([("t", "1", "master", "J-1")], "source_empresa string, cod_cli string, nom_cli string, rif string")
    got = facts.with_client(sales, clients)
    assert sorted(map(str, [(r.nom_cli, r.rif) for r in got.collect()])) == sorted(map(str, [("master", "J-1"), ("own", "J-9"), (None, None), (None, None)]))
    masters = [lk.sil(n) for n in ("articulos", "clientes", "vendedores", "proveedores", "marcas", "departamentos")]
    whole = facts.line_measures(lk.sil_ventas, *masters)  # the general interface gives the same lines
    assert sorted(map(str, whole.collect())) == sorted(map(str, lk.lines.select(*whole.columns).collect())) and whole.count() == 3
    joins = [x for x in whole._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join LeftOuter" in x]
    assert "cod_cli" in joins[-1] and not any("cod_cli" in x for x in joins[:-1])  # the innermost join: below the article's names


def test_one_contract_is_cut_before_the_join(spark):
    d = sales_tables(spark)
    whole = A.stg_ventas_union(spark, d)
    for v in C.SALES:
        one = A.stg_ventas_union(spark, d, only=v)
        assert sorted(map(str, one.collect())) == sorted(map(str, whole.where(F.col("_version") == v).collect()))
    assert "o_orderdate" in plan(A.stg_ventas_union(spark, d, only="legacy")).split("PushedFilters", 1)[1]


def test_rejects_and_control_log_write_no_table_they_do_not_read(spark):
    d = sales_tables(spark)
    assert QUERIES["R2_rejects"](spark, d).count() == 0
    runs = [r.run_id for r in QUERIES["A2_run_summary"](spark, d).collect()]
    assert sorted(runs) == ["run-19980201", "run-19990301"]
    assert "rej_ventas" in published(spark, Lake(spark, d).key)
    assert not {"sil_ventas", "landed", "quarantined"} & published(spark, Lake(spark, d).key)


def test_landed_rows_are_typed_before_the_shuffle(spark):
    row = ",".join(f'"{c}":"1"' for c in E3.names)
    ok, short, none = f'{{"d":{{"laTablas":[[{{{row}}},{{{row},"nuevo":"z"}}]]}}}}', '{"d":{"laTablas":[[{"documento":"1"}]]}}', '{"d":{"laTablas":[[]]}}'
    texts = [("a", ok), ("b", short), ("c", none), ("d", "<html>"), ("e", ok), ("e", short), (None, ok)]  # an id may come twice, or lack
    payloads = spark.createDataFrame([(i, "t", "q", "3", "h", "2024-01-01", "r", T0, p) for i, p in texts],
                                     "payload_id string, source_empresa string, query_id string, query_version string, query_sql_hash string, dt string, run_id string, "
                                     "_ingested_at timestamp, payload string")
    hashed = land.with_batch_id(land.with_payload_hash(payloads))
    landed, quarantined = land.land(payloads, E3, land.scan_envelopes(hashed))
    got = landed.collect()
    assert sorted((str(r.payload_id), r.row_index, len(r._extra)) for r in got) == [("None", 0, 0), ("None", 1, 1), ("a", 0, 0), ("a", 1, 1)]
    assert {r._payload_hash for r in got} == {hashed.where("payload_id = 'a'").first()._payload_hash} and all(len(r._row_hash) == len(r._lote_id) == 64 for r in got)
    assert {r.payload_id: r.reason for r in quarantined.collect()} == {"b": "schema_mismatch", "c": "empty_rejected", "d": "schema_mismatch", "e": "schema_mismatch"}
    assert "unhex" in plan(landed.select("_row_hash"))


def test_the_table_sink_keeps_hashes(spark):
    hashes = ["ab" * 32, "x", None, ""]
    df = spark.createDataFrame([(h, i, dt.date(2024, 1, 1)) for i, h in enumerate(hashes)], "_row_hash string, k int, day date")
    back = land.write_table(df, tempfile.mkdtemp(), "day", ["k"])
    assert [r._row_hash for r in back.orderBy("k").collect()] == hashes
    assert [r._row_hash for r in land.write_table(df, tempfile.mkdtemp(), "day", ["_row_hash"]).orderBy("k").collect()] == hashes
