"""Queries for cleaning expressions, Silver tables, dedup, rejects, dims and quality checks."""

from __future__ import annotations


from . import oracle as O
from .lake import REJECTED_AT
from .queries import query
from .. import contracts as C
from ..functions import columns as X
from ..operators import dims, facts, quality, security, silver
from ..sources import erp_adapter as A

KEY = ["source_empresa", "tipo_documento", "cod_suc", "documento", "renglon"]
KEY_SPEC = "source_empresa:s, tipo_documento:s, cod_suc:s, documento:s, renglon:d, "
cs = O.clean_str


@query("P1_trim_str", O.out(f"SELECT source_empresa, cod_cli, {cs('nom_cli')} AS nom_cli, {cs('rif')} AS rif FROM stg_clientes",
                            "source_empresa:s, cod_cli:s, nom_cli:s, rif:s"))
def p1(lk):
    """Whitespace stripped at both ends of customer names and fiscal ids."""
    return lk.stg("clientes").select("source_empresa", "cod_cli", X.clean_str("nom_cli").alias("nom_cli"),
                                     X.clean_str("rif").alias("rif"))


@query("P2_to_timestamp", O.out(f"""SELECT _version, {', '.join(KEY)}, registro, TRY_CAST({cs('registro')} AS TIMESTAMP) AS registro_ts
FROM stg_ventas_union""", "_version:s, " + KEY_SPEC + "registro:s, registro_ts:ts"))
def p2(lk):
    """.NET ISO text with 7 fractional digits -> timestamp (NULL when bad), in all three sales contracts."""
    return lk.stg_ventas_union.select("_version", *KEY, "registro", X.to_ts("registro").alias("registro_ts"))


@query("P3_to_date", O.out(f"""SELECT _version, {', '.join(KEY)}, TRY_CAST(TRY_CAST({cs('registro')} AS TIMESTAMP) AS DATE) AS fecha
FROM stg_ventas_union""", "_version:s, " + KEY_SPEC + "fecha:dt"))
def p3(lk):
    """Safe cast of the whole sale time to DATE, in all three sales contracts."""
    return lk.stg_ventas_union.select("_version", *KEY, X.to_date_safe("registro").alias("fecha"))


@query("P4_to_numeric", O.out("SELECT source_empresa, cod_cli, TRY_CAST(mon_sal AS DECIMAL(28,10)) AS mon_sal FROM stg_clientes",
                              "source_empresa:s, cod_cli:s, mon_sal:d"))
def p4(lk):
    """Safe cast of the customer balance to decimal(28,10)."""
    return lk.stg("clientes").select("source_empresa", "cod_cli", X.to_num("mon_sal").alias("mon_sal"))


@query("P5_blank_to_fallback", O.out("SELECT " + ", ".join(KEY) + ", nom_cli, nom_ven, nom_pro, nom_art, nom_mar, rif FROM lines",
                                     KEY_SPEC + "nom_cli:s, nom_ven:s, nom_pro:s, nom_art:s, nom_mar:s, rif:s"))
def p5(lk):
    """P5: names on the line when not blank, else from the masters."""
    return lk.lines.select(*KEY, "nom_cli", "nom_ven", "nom_pro", "nom_art", "nom_mar", "rif")


@query("P6_safe_ratio", O.out("SELECT " + ", ".join(KEY) + ", unidades_vendidas, cajas_vendidas, peso_total_toneladas FROM lines",
                              KEY_SPEC + "unidades_vendidas:d, cajas_vendidas:d, peso_total_toneladas:d"))
def p6(lk):
    """boxes = units / bulk capacity (NULL when the capacity is 0), rounded."""
    return lk.lines.select(*KEY, "unidades_vendidas", "cajas_vendidas", "peso_total_toneladas")


_ART = C.ARTICULOS
_ART_SPEC = ", ".join(f"{c.name}:{'d' if c.type == 'number' else ('ts' if c.type == 'timestamp' else 's')}" for c in _ART.columns)


@query("P7_contract_clean", O.out("SELECT source_empresa, " + ", ".join(O.clean_expr(_ART, n) for n in _ART.names) +
                                  " FROM stg_articulos", "source_empresa:s, " + _ART_SPEC))
def p7(lk):
    """Every article column cleaned and typed by its declared contract type, defaults applied."""
    return silver.contract_clean(lk.stg("articulos"), _ART, keep=["source_empresa"])


GPS_SPEC = "source_empresa:s, cod_cli:s, gps:s, latitud:d, longitud:d"


@query("P8_gps_parse", O.out("SELECT source_empresa, cod_cli, gps, latitud, longitud FROM sil_clientes", GPS_SPEC))
def p8(lk):
    """latitude/longitude parsed from free GPS text."""
    return lk.sil("clientes").select("source_empresa", "cod_cli", "gps", "latitud", "longitud")


@query("P9_gps_classify", O.out("SELECT source_empresa, cod_cli, latitud, longitud, gps_valido, gps_estado FROM sil_clientes",
                                "source_empresa:s, cod_cli:s, latitud:d, longitud:d, gps_valido:b, gps_estado:s"))
def p9(lk):
    """GPS validity and state by the in-country bounding box."""
    return lk.sil("clientes").select("source_empresa", "cod_cli", "latitud", "longitud", "gps_valido", "gps_estado")


@query("P12_period_filter", O.out("SELECT " + ", ".join(KEY) + ", fecha_registro, neto_dcto FROM sil_ventas "
                                  "WHERE fecha_registro BETWEEN DATE '2000-01-01' AND DATE '2000-12-31'",
                                  KEY_SPEC + "fecha_registro:dt, neto_dcto:d"))
def p12(lk):
    """BETWEEN date filter on the partition date (pruned at the scan when the table is partitioned)."""
    from ..operators.reports import between_dates
    return between_dates(lk.sil_ventas, "fecha_registro", "2000-01-01", "2000-12-31").select(*KEY, "fecha_registro", "neto_dcto")


@query("P13_pseudonymize", O.out(f"SELECT source_empresa, cod_ven, 'usr_' || substr(sha256(lower({cs('correo')})), 1, 16) AS usuario "
                                 "FROM sil_vendedores", "source_empresa:s, cod_ven:s, usuario:s"))
def p13(lk):
    """sellers' mails pseudonymized as usr_ + 16 hex chars of sha256."""
    return lk.sil("vendedores").select("source_empresa", "cod_ven", X.pseudonymize("correo").alias("usuario"))


@query("P14_redact_columns", O.out("""SELECT source_empresa, cod_cli, nom_cli,
  CASE WHEN rif IS NOT NULL THEN '***REDACTED***' END AS rif, CASE WHEN gps IS NOT NULL THEN '***REDACTED***' END AS gps,
  segmentacion1 FROM sil_clientes""", "source_empresa:s, cod_cli:s, nom_cli:s, rif:s, gps:s, segmentacion1:s"))
def p14(lk):
    """Sensitive columns (fiscal id, GPS) replaced by a marker."""
    return security.redact(lk.sil("clientes").select("source_empresa", "cod_cli", "nom_cli", "rif", "gps", "segmentacion1"))


@query("P15_doc_sign", O.out("SELECT " + ", ".join(KEY) + ", can_ven, monto_bruto, neto, neto_dcto FROM erp_sales_lines",
                             KEY_SPEC + "can_ven:d, monto_bruto:d, neto:d, neto_dcto:d"))
def p15(lk):
    """Returns carry negative units and amounts."""
    return facts.erp_sales_lines(A.sales_source_lines(lk.spark, lk.d)).select(*KEY, "can_ven", "monto_bruto", "neto", "neto_dcto")


_G = O._G
@query("P16_money_rule", O.out(f"""SELECT {', '.join(KEY)}, CAST({_G} AS DECIMAL(18,2)) AS neto,
  CAST(CAST(por_des1 AS DECIMAL(18,6)) AS DECIMAL(18,2)) AS dcto, CAST(1.0 / CAST(tasa_doc AS DOUBLE) AS DECIMAL(18,6)) AS tasa,
  CAST({_G} * (1 - CAST(por_des1 AS DECIMAL(18,6)) * 0.01) AS DECIMAL(18,2)) AS neto_dcto FROM sales_source_lines""",
                               KEY_SPEC + "neto:d, dcto:d, tasa:d, neto_dcto:d"))
def p16(lk):
    """neto = (net + tax) * rate, discount applied, inverse rate; decimal money."""
    src = A.sales_source_lines(lk.spark, lk.d)
    return src.select(*KEY, *[c.alias(n) for n, c in X.money_columns("mon_net", "mon_imp1", "tasa_doc", "por_des1").items()])


@query("D1_latest_by_key", O.out(f"""SELECT _version, {', '.join(KEY)}, max(_ingested_at) AS _ingested_at,
  max(struct_pack(t := _ingested_at, h := _row_hash)).h AS _row_hash FROM stg_ventas_union GROUP BY _version, {', '.join(KEY)}""",
                                 "_version:s, " + KEY_SPEC + "_ingested_at:ts, _row_hash:s"))
def d1(lk):
    """Newest staging row per contract and raw key (ingest time, then row hash)."""
    return silver.latest_by_key(lk.stg_ventas_union, ["_version", *KEY], ["_ingested_at"]).select("_version", *KEY, "_ingested_at", "_row_hash")


@query("D2_priority_dedup", O.out("SELECT " + ", ".join(KEY) + ", _priority, _row_hash FROM sil_ventas",
                                  KEY_SPEC + "_priority:i, _row_hash:s"))
def d2(lk):
    """One sales line per cleaned key: contract priority, then recency, then row hash."""
    return lk.sil_ventas.select(*KEY, "_priority", "_row_hash")


@query("D3_daily_last", O.out("""SELECT source_empresa, cod_mon, CAST(registro AS DATE) AS dia, registro, tasa FROM sil_renglones_monedas
QUALIFY row_number() OVER (PARTITION BY source_empresa, cod_mon, CAST(registro AS DATE)
  ORDER BY registro DESC NULLS LAST, _row_hash DESC NULLS LAST) = 1""", "source_empresa:s, cod_mon:s, dia:dt, registro:ts, tasa:d"))
def d3(lk):
    """D3: last rate per tenant, currency and day."""
    r = silver.last_per_day(lk.sil("renglones_monedas"), ["source_empresa", "cod_mon"], "registro")
    return r.select("source_empresa", "cod_mon", "dia", "registro", "tasa")


@query("D4_snapshot_dedup", O.out(f"""SELECT source_empresa, snapshot_date, run_id, cod_alm, cod_art, exi_act1 FROM (
  SELECT source_empresa, snapshot_date, run_id, {cs('cod_alm')} AS cod_alm, {cs('cod_art')} AS cod_art,
         TRY_CAST(exi_act1 AS DECIMAL(28,10)) AS exi_act1, _ingested_at, _row_hash FROM stg_renglones_almacenes) s
WHERE cod_alm <> '' AND cod_art <> '' AND exi_act1 IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY source_empresa, snapshot_date, run_id, cod_alm, cod_art
  ORDER BY _ingested_at DESC NULLS LAST, _row_hash DESC NULLS LAST) = 1""",
                                  "source_empresa:s, snapshot_date:dt, run_id:s, cod_alm:s, cod_art:s, exi_act1:d"))
def d4(lk):
    """One stock row per tenant, snapshot day, run, warehouse and article."""
    return silver.snapshot_dedup(lk.stg("renglones_almacenes")).select(
        "source_empresa", "snapshot_date", "run_id", "cod_alm", "cod_art", "exi_act1")


_E2 = C.SALES["v2"]


@query("R1_required_filter", O.out(f"SELECT {', '.join(KEY)}, _priority FROM ventas_union WHERE {O.valid_sql(_E2)}",
                                   KEY_SPEC + "_priority:i"))
def r1(lk):
    """Sales rows whose required columns are present (all three contracts)."""
    return silver.valid_rows(lk.stg_ventas_union, _E2).select(*KEY, "_priority")


@query("R2_rejects", O.out(f"""SELECT {', '.join(KEY)}, _priority, motivo_rechazo, TIMESTAMP '{REJECTED_AT}' AS _rechazado_en
FROM rej_ventas""", KEY_SPEC + "_priority:i, motivo_rechazo:s, _rechazado_en:ts"))
def r2(lk):
    """R2: rejected sales rows with the list of failing columns, from the union of contracts."""
    return lk.rej_ventas.select(*KEY, "_priority", "motivo_rechazo", "_rechazado_en")


_M3 = ("registro:ts, fecha_registro:dt, cod_ven:s, cod_cli:s, nom_cli:s, cod_art:s, cod_alm:s, cod_pro:s, can_ven:d, "
       "monto_bruto:d, neto:d, dcto:d, tasa:d, neto_dcto:d, rif:s, _priority:i")


@query("M3_silver_sales", O.out("SELECT " + ", ".join(KEY + [s.split(":")[0].strip() for s in _M3.split(",")]) + " FROM sil_ventas",
                                KEY_SPEC + _M3))
def m3(lk):
    """M3: Silver sales lines from three contract versions (union, clean, reject, priority dedup, supplier lookup)."""
    return lk.sil_ventas.select(*KEY, *[s.split(":")[0].strip() for s in _M3.split(",")])


@query("M5_dim_empresa", O.out("SELECT * FROM dim_empresa", "source_empresa:s, nombre_empresa:s, razon_social:s"))
def m5(lk):
    """M5: tenant dimension."""
    return lk.dim_empresa


_CAL = ("fecha_key:i, fecha:dt, anio:i, mes:i, nombre_mes:s, nombre_mes_corto:s, dia:i, dia_del_anio:i, trimestre:i, "
        "trimestre_nombre:s, anio_trimestre:s, semana_del_anio:i, anio_semana:s, anio_semana_num:i, inicio_semana:dt, "
        "fin_semana:dt, dia_de_semana:i, nombre_dia:s, es_fin_de_semana:b, quincena:i, quincena_nombre:s, anio_mes:s, "
        "anio_mes_num:i, es_primer_dia_mes:b, es_fin_de_mes:b")


@query("M6_dim_tiempo", O.out(f"""SELECT {O.cal_cols('d')} FROM (
  SELECT CAST(unnest(generate_series(CAST(date_trunc('year', min(o_orderdate)) AS TIMESTAMP),
                     CAST(date_trunc('year', max(o_orderdate)) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS TIMESTAMP),
                     INTERVAL 1 DAY)) AS DATE) AS d FROM orders) g""", _CAL))
def m6(lk):
    """M6: calendar over whole years of the order history (ISO weeks, fortnights, Spanish names)."""
    from ..sources.tables import read_table
    return dims.calendar_for(lk.spark, read_table(lk.spark, lk.d, "orders", ["o_orderdate"]), "o_orderdate")


@query("U1_union_contracts", O.out("SELECT " + ", ".join(KEY) + ", registro, _priority FROM ventas_union",
                                   KEY_SPEC + "registro:s, _priority:i"))
def u1(lk):
    """UNION ALL of the v3, v2 and legacy sales contracts with typed NULL padding."""
    return silver.union_versions([(df, C.SALES_PRIORITY[v]) for v, df in lk.stg_ventas.items()]).select(
        *KEY, "registro", "_priority")


@query("U3_distinct_sets", O.out("SELECT DISTINCT source_empresa, cod_suc, cod_ven, cod_cli FROM fct_ventas",
                                 "source_empresa:s, cod_suc:s, cod_ven:s, cod_cli:s"))
def u3(lk):
    """Distinct customer portfolio per branch and seller."""
    return facts.distinct_of(lk.fct_ventas, ["source_empresa", "cod_suc", "cod_ven", "cod_cli"])


@query("Q1_unique_key", O.out(f"SELECT _version, {', '.join(KEY)}, count(*) AS n FROM stg_ventas_union GROUP BY ALL HAVING count(*) > 1",
                              "_version:s, " + KEY_SPEC + "n:i"))
def q1(lk):
    """Q1: duplicated raw keys in each sales contract's staging."""
    return quality.assert_unique(lk.stg_ventas_union, ["_version", *KEY])


_NN = ["nom_ven", "nom_cli", "nom_mar", "nom_dep", "nom_pro", "nom_art", "cod_uni1", "rif", "nom_est", "nom_ciu"]


@query("Q2_non_null", O.out(" UNION ALL ".join(
    f"SELECT 'lines' AS tabla, count(*) AS total, '{c}' AS columna, count(*) - count({c}) AS nulos FROM lines" for c in _NN),
    "tabla:s, total:i, columna:s, nulos:i"))
def q2(lk):
    """Q2: NULL count per column of the line fact, in one pass."""
    return quality.assert_non_null(lk.lines, _NN, "lines")


def _q3_sql():
    parts = []
    for c in _ART.columns:
        if c.domain:
            dom = ", ".join(f"'{v}'" for v in c.domain)
            parts.append(f"SELECT 'sil_articulos' AS tabla, '{c.name}' AS columna, 'domain' AS regla, "
                         f"count(*) FILTER (WHERE {c.name} IS NOT NULL AND {c.name} NOT IN ({dom})) AS violaciones FROM sil_articulos")
        if c.min is not None:
            parts.append(f"SELECT 'sil_articulos' AS tabla, '{c.name}' AS columna, 'min' AS regla, "
                         f"count(*) FILTER (WHERE {c.name} < {c.min}) AS violaciones FROM sil_articulos")
    return " UNION ALL ".join(parts)


@query("Q3_domain_range", O.out(_q3_sql(), "tabla:s, columna:s, regla:s, violaciones:i"))
def q3(lk):
    """Q3: declared domain and minimum checks of the article contract."""
    return quality.assert_domain(lk.sil("articulos"), _ART, "sil_articulos")


_NN2 = ["cod_pro", "registro", "cod_cli"]


@query("Q4_quality_results", O.out(f"""
WITH u AS (SELECT 'unique_key' AS check_name, count(*) AS violaciones, 'duplicated keys' AS detalle FROM (
             SELECT {', '.join(KEY)} FROM sil_ventas GROUP BY ALL HAVING count(*) > 1) d),
n AS ({' UNION ALL '.join(f"SELECT 'non_null:{c}' AS check_name, count(*) - count({c}) AS violaciones, 'null values' AS detalle FROM sil_ventas" for c in _NN2)}),
d AS (SELECT 'domain:' || columna || ':' || regla AS check_name, violaciones, 'out of domain' AS detalle FROM ({_q3_sql()}) q),
a AS (SELECT * FROM u UNION ALL SELECT * FROM n UNION ALL SELECT * FROM d)
SELECT sha256('r1|ventas_diarias|' || check_name) AS check_id, 'r1' AS run_id, 'ventas_diarias' AS entity, check_name,
       CASE WHEN violaciones = 0 THEN 'PASS' ELSE 'FAIL' END AS status, CAST(violaciones AS VARCHAR) || ' ' || detalle AS details
FROM a""", "check_id:s, run_id:s, entity:s, check_name:s, status:s, details:s"))
def q4(lk):
    """Q4: unique, non-null and domain checks as data_quality_results rows."""
    s = lk.checked_ventas
    return quality.quality_report(quality.assert_unique(s, KEY), quality.assert_non_null(s, _NN2, "sil_ventas"),
                                  quality.assert_domain(lk.sil("articulos"), _ART, "sil_articulos"), "r1", "ventas_diarias")


@query("Q5_null_profile", O.out("""SELECT source_empresa, count(*) AS total, count(*) - count(registro) AS nulos,
  min(registro) AS minimo, max(registro) AS maximo FROM sil_ventas GROUP BY ALL""",
                                "source_empresa:s, total:i, nulos:i, minimo:ts, maximo:ts"))
def q5(lk):
    """Q5: total, NULL count and min/max of the sale time per tenant."""
    return quality.profile(lk.sil_ventas, "registro", ["source_empresa"])
