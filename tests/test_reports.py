"""Reports and control operators on hand-made rows (FIXTURES part D edge cases)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from sellake import contracts as C
from sellake.operators import kpis, land, reports, silver, telemetry
from sellake.operators.backfill import missing_windows
from sellake.operators.dims import calendar


def _fact(spark, rows):
    schema = ("source_empresa string, cod_suc string, cod_ven string, nom_ven string, cod_pro string, nom_pro string, "
              "cod_mar string, nom_mar string, cod_cli string, nom_cli string, rif string, cod_art string, nom_art string, "
              "modelo string, documento string, fecha_registro date, cajas_vendidas double, neto_dcto double, "
              "unidades_vendidas double, peso_total_toneladas double")
    base = ("t", "s", "v", "V", "p", "P", "m", "M")
    full = [base + r for r in rows]
    df = spark.createDataFrame(full, schema)
    cal = calendar(spark, "2023-01-01", "2025-12-31").select(F.col("fecha").alias("fecha_registro"), "anio", "mes", "nombre_mes",
                                                              "anio_mes", "trimestre", "trimestre_nombre", "anio_trimestre",
                                                              "semana_del_anio", "anio_semana", "quincena", "quincena_nombre")
    return df.join(cal, "fecha_registro")


def _row(cli, day, doc="d1", net=10.0, art="a1", rif="R1"):
    return (cli, cli.upper(), rif, art, art.upper(), "mod", doc, day, 1.0, net, 2.0, 0.1)


def test_weekly_frequency_iso_weeks(spark):
    d = dt.date
    rows = [_row("c4", d(2024, 7, x), doc=f"x{x}") for x in (1, 8, 15, 22, 29)] + [_row("c1", d(2024, 7, 3))]
    br = spark.createDataFrame([("t", "s", "Suc")], "source_empresa string, cod_suc string, nom_suc string")
    out = {r.codigo_cliente: (r.semanas_con_compra, r.tipo_cliente_frecuencia_num) for r in
           reports.weekly_frequency(_fact(spark, rows), br).collect()}
    assert out == {"c4": (5, 4), "c1": (1, 1)}


def test_sellout_feb29_maps_to_feb28(spark):
    d = dt.date
    rows = [_row("c", d(2024, 2, 29), net=100.0), _row("c", d(2025, 2, 28), net=150.0)]
    br = spark.createDataFrame([("t", "s", "Suc")], "source_empresa string, cod_suc string, nom_suc string")
    out = {r.fecha: (r.venta_usd_anio_anterior, r.pct_crecimiento_yoy) for r in reports.sellout_yoy(reports.sellout_daily(_fact(spark, rows)), br).collect()}
    assert out[d(2025, 2, 28)] == (100.0, 50.0)


def test_activable_90d_boundaries(spark):
    d = dt.date
    as_of = "2024-07-31"
    rows = [_row("in90", d(2024, 5, 2)), _row("out91", d(2024, 5, 1)), _row("month", d(2024, 7, 3)),
            _row("ret", d(2024, 7, 5), net=-5.0)]
    br = spark.createDataFrame([("t", "s", "Suc")], "source_empresa string, cod_suc string, nom_suc string")
    r = reports.activable_90d(_fact(spark, rows), br, as_of).first()
    assert r.base_activable_clientes_90d == 3 and r.clientes_activados_mes_actual == 2
    assert r.pct_activacion_mes_actual == round(2 / 3 * 100, 2)


def test_top_customers_tie_break(spark):
    f = spark.createDataFrame([("t", "b", 5.0), ("t", "a", 5.0), ("t", "c", 1.0)], "source_empresa string, cod_cli string, neto_dcto double")
    out = [r.cod_cli for r in kpis.top_customers(f, ["source_empresa"], 2).orderBy("posicion").collect()]
    assert out == ["a", "b"]


def test_success_sampling_deterministic_and_keeps_failures(spark):
    ev = spark.range(0, 2000).select(F.col("id").alias("event_id"),
                                      F.when(F.col("id") % 10 == 0, "ERROR").otherwise("SUCCESS").alias("status"))
    a = telemetry.sample_success(ev, 10)
    b = telemetry.sample_success(ev, 10)
    assert sorted(r.event_id for r in a.collect()) == sorted(r.event_id for r in b.collect())
    assert a.filter("status = 'ERROR'").count() == 200
    assert 0 < a.filter("status = 'SUCCESS'").count() < 400
    assert telemetry.sample_success(ev, 150).count() == 2000 and telemetry.sample_success(ev, -5).count() == 200


def test_extras_truncation(spark):
    df = spark.createDataFrame([("a" * 10,), ("b" * 3000,)], "x string")
    out = land.with_extras(df, F.to_json(F.struct("x"))).collect()
    assert out[0].extras == out[0].extras_display == '{"x":"aaaaaaaaaa"}'
    assert out[1].extras == '{"x":"' + "b" * 3000 + '"}' and out[1].extras_display == '{"__truncated":true,"size_bytes":3008}'


def test_missing_windows_finds_gap(spark):
    reg = spark.createDataFrame([("t", "q", "2024-01-03", "SUCCESS"), ("t", "q", "2024-01-20", "WRITTEN"),
                                 ("t", "q", "2024-02-16", "SUCCESS")], "source_empresa string, entity string, dt string, status string")
    w = missing_windows(reg, reg.select("source_empresa", F.col("entity").alias("query_id")), "2024-01-01", "2024-02-20").orderBy("window_start").collect()
    assert [(str(r.window_start), str(r.window_end)) for r in w] == [("2024-01-16", "2024-01-31"), ("2024-02-01", "2024-02-15")]


def test_snapshot_dedup_drops_blank_and_bad(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [("e", dt.date(2024, 1, 1), "r", " A1 ", "X", "5", t, "h1"), ("e", dt.date(2024, 1, 1), "r", "A1", "X", "7", t, "h2"),
            ("e", dt.date(2024, 1, 1), "r", "", "X", "1", t, "h3"), ("e", dt.date(2024, 1, 1), "r", "A2", "X", "abc", t, "h4")]
    df = spark.createDataFrame(rows, "source_empresa string, snapshot_date date, run_id string, cod_alm string, cod_art string, "
                                     "exi_act1 string, _ingested_at timestamp, _row_hash string")
    out = silver.snapshot_dedup(df).collect()
    assert len(out) == 1 and out[0].cod_alm == "A1" and float(out[0].exi_act1) == 7.0


def test_drift_and_required(spark):
    rows = spark.createDataFrame([("p", 0, {"tipo_documento": "F", "cod_suc": "1", "documento": "9", "renglon": "1", "x": "1"}),
                                  ("p", 1, {"tipo_documento": "F", "cod_suc": "1"})],
                                 "payload_id string, row_index int, row map<string,string>")
    assert [(r.columns, r.kind) for r in land.check_drift(rows, C.VENTAS_V3).collect()] == [("x", "extra")]
    assert [(r.row_index, r.missing) for r in land.validate_required(rows, C.VENTAS_V3).collect()] == [(1, "documento,renglon")]


def test_sampling_does_not_overflow(spark):
    ids = [0, 1, 7, 4 * 10**9, 2**40 + 12345, 2**62, -5]
    got = spark.createDataFrame([(i,) for i in ids], "event_id long").select("event_id", telemetry.sample_bucket().alias("b")).collect()
    assert {r.event_id: r.b for r in got} == {i: (i * 2654435761 % 2**32) % 100 for i in ids}


def test_missing_windows_of_a_pair_that_never_landed(spark):
    reg = spark.createDataFrame([("t", "q", "2024-01-03", "SUCCESS")], "source_empresa string, entity string, dt string, status string")
    pairs = spark.createDataFrame([("t", "q"), ("u", "q")], "source_empresa string, query_id string")
    got = [(r.source_empresa, str(r.window_start)) for r in missing_windows(reg, pairs, "2024-01-01", "2024-01-31").collect()]
    assert sorted(got) == [("t", "2024-01-16"), ("u", "2024-01-01"), ("u", "2024-01-16")]


def test_gap_bitmaps_and_their_skus(spark):
    """Gaps of every customer against a plain set difference; dense numbers; no pair of customer and SKU in the plan."""
    import random

    rnd, rows = random.Random(4), []
    for t, n in (("t1", 150), ("t2", 64), ("t3", 1)):
        for _ in range(400 if n > 1 else 3):
            day = dt.date(2024, 3, 31) - dt.timedelta(days=rnd.randrange(120))
            rows.append((t, "s", rnd.choice(["v1", "v2"]), f"c{rnd.randrange(8)}", f"sku{rnd.randrange(n)}", day, Decimal(rnd.choice([5, 5, 5, -5]))))
    fact = spark.createDataFrame(rows, "source_empresa string, cod_suc string, cod_ven string, cod_cli string, cod_art string, fecha_registro date, neto_dcto decimal(18,2)")
    branches = spark.createDataFrame([("t1", "s", "Centro")], "source_empresa string, cod_suc string, nom_suc string")
    inside = [r for r in rows if dt.date(2024, 1, 1) <= r[5] <= dt.date(2024, 3, 31)]
    catalogue, paid, clients = {}, {}, set()
    for t, s, v, c, a, d, x in inside:
        catalogue.setdefault(t, set()).add(a)
        clients.add((t, s, v, c))
        paid[t, s, v, c, a] = paid.get((t, s, v, c, a), 0) + (x if d >= dt.date(2024, 3, 1) else 0)
    want = {k: catalogue[k[0]] - {a for a in catalogue[k[0]] if paid.get((*k, a), 0) > 0} for k in clients}
    gaps = reports.zero_sale_sku(fact, branches, "2024-03-31")
    got = {(r.empresa, r.codigo_sucursal, r.codigo_vendedor, r.codigo_cliente): r for r in gaps.collect()}
    assert {k: (r.skus_catalogo, r.skus_venta_cero, r.skus_comprados_mes) for k, r in got.items()} == {
        k: (len(catalogue[k[0]]), len(w), len(catalogue[k[0]]) - len(w)) for k, w in want.items()}
    assert {r.nombre_sucursal for r in got.values()} == {"Centro", "s"}
    listed = {}
    for r in reports.gap_skus(gaps, fact, "2024-03-31").collect():
        listed.setdefault((r.empresa, r.codigo_sucursal, r.codigo_vendedor, r.codigo_cliente), set()).add(r.cod_art)
    assert listed == {k: w for k, w in want.items() if w}
    numbers = reports.number_members(fact, "source_empresa", "cod_art").groupBy("source_empresa").agg(F.collect_list("number").alias("n")).collect()
    assert all(sorted(r.n) == list(range(len(r.n))) for r in numbers)


def test_distinct_counts_without_an_expansion(spark):
    from sellake.plans.lake import Lake

    lk = Lake(spark, "/root/testdata/sf0.001")
    for df in (reports.period_summary(lk.fct_ventas, lk.dim_empresa, by=("anio_mes",)), reports.weekly_frequency(lk.fct_ventas, lk.branches),
               reports.sellout_daily(lk.fct_ventas), reports.zero_sale_sku(lk.fct_ventas, lk.branches, lk.as_of)):
        assert "Expand" not in df._jdf.queryExecution().executedPlan().toString()
