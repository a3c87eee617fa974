"""Operators on hand-made rows: Silver split/dedup laws, SCD2, as-of, merge, security, KPIs, landing."""

import datetime as dt

from pyspark.sql import functions as F

from sellake import contracts as C
from sellake.operators import history, kpis, land, quality, security, silver

T0 = dt.datetime(2024, 1, 1, 8, 0, 0)


def _stg(spark, rows):
    return spark.createDataFrame(rows, "source_empresa string, cod_mar string, nom_mar string, status string, "
                                       "_ingested_at timestamp, _row_hash string")


def test_silver_master_clean_before_dedup_and_reject(spark):
    rows = [("t", " M1", "Marca  ", "A", T0, "h1"), ("t", "M1", "Marca B", "A", T0 + dt.timedelta(hours=1), "h2"),
            ("t", "M2", "  ", "A", T0, "h3"), ("t", "M3", None, None, T0, "h4"),
            ("t", "M4", "x", "A", T0, "a"), ("t", "M4", "y", "A", T0, "b")]
    cur, rej = silver.silver_master(_stg(spark, rows), C.MARCAS)
    got = {r.cod_mar: r.nom_mar for r in cur.collect()}
    assert got == {"M1": "Marca B", "M4": "y"}  # padded key collides with clean key; tie broken by row hash
    reasons = {r.cod_mar: r.motivo_rechazo for r in rej.collect()}
    assert reasons == {"M2": "nom_mar", "M3": "nom_mar, status"}
    # law: valid + rejected = input
    assert cur.count() + rej.count() <= len(rows) and silver.valid_rows(_stg(spark, rows), C.MARCAS).count() + rej.count() == len(rows)


def test_priority_dedup_prefers_contract_version(spark):
    a = spark.createDataFrame([("t", "k", T0, "h")], "source_empresa string, k string, _ingested_at timestamp, _row_hash string")
    b = spark.createDataFrame([("t", "k", T0 + dt.timedelta(days=1), "g")], a.schema)
    u = silver.union_versions([(a, 3), (b, 2)])
    out = silver.latest_by_key(u, ["source_empresa", "k"], ["_priority", "_ingested_at"]).collect()
    assert len(out) == 1 and out[0]._priority == 3


def _hist(spark, rows):
    return spark.createDataFrame(rows, "entity_name string, source_empresa string, natural_key string, snapshot_date date, "
                                       "run_id string, ingested_at timestamp, record_hash string, record_json string")


def test_scd2_versions_and_intervals(spark):
    d = dt.date(2024, 1, 1)
    rows = [("c", "t", "k", d, "r1", T0, "A", "{}"), ("c", "t", "k", d, "r2", T0 + dt.timedelta(days=1), "A", "{}"),
            ("c", "t", "k", d, "r3", T0 + dt.timedelta(days=2), "B", "{}"), ("c", "t", "k", d, "r4", T0 + dt.timedelta(days=3), "A", "{}"),
            ("c", "t", "k", d, "r4", T0 + dt.timedelta(days=3), "A", "{}")]
    v = history.scd2(_hist(spark, rows)).orderBy("valid_from").collect()
    assert [r.record_hash for r in v] == ["A", "B", "A"]  # A->B->A gives three versions, repeats dropped
    assert [r.is_current for r in v] == [False, False, True]
    for a, b in zip(v, v[1:]):
        assert a.valid_to == b.valid_from  # intervals touch, never overlap


_DIM = "surrogate_key string, source_empresa string, cod string, valid_from timestamp, valid_to timestamp, is_current boolean, run_id string, record_hash string, nom string"


def test_asof_resolution_with_fallback(spark):
    dim = spark.createDataFrame([("sk1", "t", "k", T0, T0 + dt.timedelta(days=40), False, "r1", "a", "old"),
                                 ("sk2", "t", "k", T0 + dt.timedelta(days=40), None, True, "r2", "b", "new")], _DIM)
    fact = spark.createDataFrame([(1, "t", "k", T0 - dt.timedelta(days=1)), (2, "t", "k", T0), (3, "t", "k", T0 + dt.timedelta(days=40)),
                                  (4, "t", "k", T0 + dt.timedelta(days=100)), (5, "t", "z", T0), (6, "t", None, T0), (7, "t", "k", None)],
                                 "n int, source_empresa string, cod string, t timestamp")
    x = history.resolve(fact, {"d": (dim, "cod", "cod", ["nom"])}, "t", "n").orderBy("n").collect()
    back, done, lost = "CURRENT_MASTER_BACKFILL", "RESOLVED_SCD2", "UNKNOWN_UNRESOLVED"
    assert [(r.d_sk, r.d_resolution_status) for r in x] == [("sk2", back), ("sk1", done), ("sk2", done), ("sk2", done), ("UNKNOWN", lost), ("UNKNOWN", lost), ("sk2", back)]
    assert [r.resolution_status for r in x] == [back, done, done, done, "INFERRED_FROM_FACT", "INFERRED_FROM_FACT", back]
    assert [r.current_nom for r in x] == ["new"] * 4 + [None, None, "new"] and [r.is_inferred for r in x] == [True, False, False, False, True, True, True]


def test_asof_in_one_pass_against_brute_force(spark):
    """Three dimensions, versions that start at once or at a month's first instant, one key with a third of the lines; six shuffles at most."""
    import random

    rnd, dims, plain, sizes = random.Random(7), {}, {}, {"a": 6, "b": 3, "c": 1}
    when = lambda: rnd.choice([dt.datetime(2023, rnd.randrange(1, 13), 1), dt.datetime(2023, 1, 1) + dt.timedelta(hours=rnd.randrange(365 * 24))])
    for name, n in sizes.items():
        rows = []
        for k in range(n):
            starts = sorted((when() for _ in range(rnd.randrange(1, 6))))
            for i, at in enumerate(starts):
                rows.append((f"{name}{k}v{i}", "t", f"k{k}", at, starts[i + 1] if i + 1 < len(starts) else None, i + 1 == len(starts), f"r{i}", f"h{i}", f"{name}{k}n{i}"))
        plain[name], dims[name] = rows, (spark.createDataFrame(rows, _DIM), f"k_{name}", "cod", ["nom"] if name == "a" else [])
    lines = [(i, "t", when(), *[f"k{0 if rnd.random() < 0.4 else rnd.randrange(n + 1)}" for n in sizes.values()]) for i in range(600)]
    fact = spark.createDataFrame(lines, "n int, source_empresa string, t timestamp, k_a string, k_b string, k_c string")
    out = history.resolve(fact, dims, "t", "n")
    for r in out.collect():
        for name in sizes:
            own = [v for v in plain[name] if v[2] == r[f"k_{name}"]]
            asof = [v[0] for v in own if v[3] <= r.t and (v[4] is None or v[4] > r.t)]
            assert r[f"{name}_sk_asof"] == (asof[0] if asof else None) and len(asof) < 2
            assert r[f"{name}_sk"] == (asof or [v[0] for v in own if v[5]] or ["UNKNOWN"])[0]
    plan = out._jdf.queryExecution().executedPlan().toString()
    shuffles = plan.split("== Initial Plan ==")[-1].count("Exchange hashpartitioning")
    assert 0 < shuffles <= 6, plan


def test_merge_by_key_idempotent_and_keeps_old(spark):
    old = spark.createDataFrame([("a", 1, T0, "h1"), ("b", 1, T0, "h2")], "k string, v int, _ingested_at timestamp, _row_hash string")
    new = spark.createDataFrame([("b", 2, T0 + dt.timedelta(hours=1), "h3")], old.schema)
    m1 = history.merge_by_key(old, new, ["k"], ["_ingested_at"])
    m2 = history.merge_by_key(m1, new, ["k"], ["_ingested_at"])
    assert sorted(tuple(r) for r in m1.select("k", "v").collect()) == [("a", 1), ("b", 2)]
    assert sorted(map(tuple, m1.collect())) == sorted(map(tuple, m2.collect()))


def test_row_scope_fail_closed_and_null_unrestricted(spark):
    fact = spark.createDataFrame([("t1", "s1", "p1", "v1"), ("t1", "s2", "p1", "v2"), ("t2", "s1", "p1", "v1")],
                                 "source_empresa string, cod_suc string, cod_pro string, cod_ven string")
    scopes = spark.createDataFrame([
        ("seller@x.com", "t1", None, None, "v1", "VENDEDOR", "A"),
        ("boss@x.com", None, None, None, None, "SUPERADMIN", "A"),
        ("gone@x.com", "t1", None, None, None, "VENDEDOR", "I"),
    ], "correo string, source_empresa string, cod_suc string, cod_pro string, cod_ven string, role_type string, status string")
    assert security.row_scope(fact, scopes, "Seller@X.com ", fact).count() == 1
    assert security.row_scope(fact, scopes, "boss@x.com", fact).count() == 3
    assert security.row_scope(fact, scopes, "gone@x.com", fact).count() == 0
    assert security.row_scope(fact, scopes, "nobody@x.com", fact).count() == 0


def test_row_scopes_of_many_principals(spark):
    """Every pattern of NULL columns against brute force; equi joins only; a row once, however many scopes show it."""
    import itertools

    fact = spark.createDataFrame([(i, f"t{i % 3}", f"s{i % 5}", f"p{i % 7}" if i % 11 else None, f"v{i % 4}") for i in range(300)],
                                 "n int, source_empresa string, cod_suc string, cod_pro string, cod_ven string")
    rows, people = [], [f"u{k}" for k in range(9)]
    for k, mask in enumerate(itertools.product([0, 1], repeat=4)):
        rows.append((people[k % 8], *[f"{c}{k % 3}" if m else None for c, m in zip("tspv", mask)], "VENDEDOR", "A" if k != 3 else "I"))
    rows += [("u8", "elsewhere", None, None, None, "VENDEDOR", "A"), (" U1 ", "t1", None, None, None, "VENDEDOR", "A"), ("u2", "t9", "s9", None, None, "SUPERADMIN", "A")]
    scopes = spark.createDataFrame(rows, "correo string, source_empresa string, cod_suc string, cod_pro string, cod_ven string, role_type string, status string")
    want = set()
    for mail, *cols, role, status in rows:
        for f in fact.collect():
            if status == "A" and (role == "SUPERADMIN" or all(c is None or c == x for c, x in zip(cols, f[1:]))):
                want.add((mail.strip().lower(), f.n))
    got = security.row_scopes(fact, scopes, people, fact, ["n"])
    assert sorted((r.correo, r.n) for r in got.collect()) == sorted(want)
    for p in people:
        one = security.row_scope(fact, scopes, p, fact)
        assert sorted(r.n for r in one.collect()) == sorted(n for m, n in want if m == p)
        joins = [x for x in one._jdf.queryExecution().executedPlan().toString().split("\n") if "Join" in x]
        assert all("NestedLoop" not in x and "Cartesian" not in x and " OR " not in x for x in joins)


def test_portfolio_and_zero_sale(spark):
    d = dt.date
    fact = spark.createDataFrame([
        ("t", "c1", d(2024, 1, 5), 10.0), ("t", "c2", d(2024, 2, 5), 5.0), ("t", "c2", d(2024, 4, 5), 1.0),
        ("t", "c3", d(2024, 3, 1), -5.0), ("t", "c1", d(2024, 4, 2), 3.0)],
        "source_empresa string, cod_cli string, fecha_registro date, neto_dcto double")
    f = kpis.with_month(fact)
    port = {(r.mes_inicio, r.cartera_90d) for r in kpis.portfolio_90d(f, ["source_empresa", "mes_inicio"]).collect()}
    assert (d(2024, 4, 1), 2) in port  # c1 (Jan) and c2 (Feb) are inside the 3 months before April
    zero = kpis.zero_sale_customers(f, ["source_empresa", "mes_inicio"]).filter(F.col("mes_inicio") == d(2024, 3, 1))
    assert sorted(r.cod_cli for r in zero.collect()) == ["c1", "c2"]  # c3 only had a return


def test_envelope_scan_variants(spark):
    payloads = [
        ("p1", '{"d":{"laTablas":[[{"Cod_Art":"1","nom":"x"}]]}}'),
        ("p2", '﻿{"datos":{"laTablas":[[{"cod_art":"2"}]]}}'),
        ("p3", "<html>nope</html>"),
        ("p4", '{"llError":true,"d":{"laTablas":[]}}'),
        ("p5", '{"d":{"laTablas":[[]]}}'),
        ("p6", '{"d":{"laTablas":[[1]]}}'),
        ("p7", '{"d":{"nada":1}}'),
    ]
    df = spark.createDataFrame(payloads, "payload_id string, payload string")
    rows, invalid = land.scan_envelopes(df)
    got = {r.payload_id: (r.row or {}).get("cod_art") for r in rows.collect()}
    assert got == {"p1": "1", "p2": "2", "p5": None}
    assert {r.payload_id: r.reason for r in invalid.collect()} == {
        "p3": "schema_mismatch", "p4": "schema_mismatch", "p6": "schema_mismatch", "p7": "schema_mismatch"}
    assert [r.payload_id for r in land.empty_batches(rows, C.VENTAS_V3).collect()] == ["p5"]


def test_quality_non_null_and_unique(spark):
    df = spark.createDataFrame([("a", None), ("a", "x"), ("b", None)], "k string, v string")
    nn = {r.columna: r.nulos for r in quality.assert_non_null(df, ["k", "v"]).collect()}
    assert nn == {"k": 0, "v": 2}
    assert [(r.k, r.n) for r in quality.assert_unique(df, ["k"]).collect()] == [("a", 2)]
