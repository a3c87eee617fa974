"""Inventory / BI / shared-contract reports, security scopes and row/column security,
join-kind queries and telemetry."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import oracle as O
from .lake import AS_OF
from .queries import query
from ..operators import dims, facts, kpis, reports as R, security, telemetry as L
from ..sources import erp_adapter as A

cs = O.clean_str
KEY = ["source_empresa", "tipo_documento", "cod_suc", "documento", "renglon"]
KEY_SPEC = "source_empresa:s, tipo_documento:s, cod_suc:s, documento:s, renglon:d, "


def _scopes(lk):
    return dims.flatten_scopes(A.user_documents(lk.spark, lk.d), ADMIN_MAIL)


_CONS = ", ".join(f"{'NULL' if s is None else s}::{'VARCHAR' if t == 'string' else t.upper()} AS {n}" for s, n, t in R.SALES_CONSUMER)
_CONS_SPEC = ", ".join(f"{n}:{ {'string': 's', 'double': 'd', 'timestamp': 'ts', 'date': 'dt'}[t] }" for _, n, t in R.SALES_CONSUMER)


@query("P11_business_rename", O.out(f"SELECT {_CONS} FROM fct_ventas", _CONS_SPEC))
def p11(lk):
    """Business projection with display names and typed NULL placeholders."""
    return R.project_contract(lk.fct_ventas, R.SALES_CONSUMER)


@query("G21_inventory_sync", O.out("""
WITH gold AS (SELECT r.source_empresa, r.cod_alm, a.fraccion, r.exi_act1 FROM sil_renglones_almacenes r
  LEFT JOIN sil_articulos a ON a.source_empresa = r.source_empresa AND a.cod_art = r.cod_art WHERE exi_act1 > 0),
g AS (SELECT source_empresa, count(*) AS filas_gold, count(DISTINCT cod_alm) AS almacenes_gold, round(sum(exi_act1), 2) AS unidades_gold FROM gold GROUP BY ALL),
s AS (SELECT source_empresa, count(*) AS filas_silver, count(DISTINCT cod_alm) AS almacenes_silver, round(sum(exi_act1), 2) AS unidades_silver
  FROM sil_renglones_almacenes WHERE exi_act1 > 0 GROUP BY ALL)
SELECT *, filas_gold = filas_silver AND unidades_gold = unidades_silver AS sincronizado FROM s JOIN g USING (source_empresa)""",
    "source_empresa:s, filas_silver:i, almacenes_silver:i, unidades_silver:d, filas_gold:i, almacenes_gold:i, unidades_gold:d, sincronizado:b"))
def g21(lk):
    """Stock in Silver against the inventory report, per tenant."""
    report = lk.gold_stock
    return R.inventory_sync(lk.sil("renglones_almacenes"), report)


@query("G22_gps_coverage", O.out("""SELECT source_empresa, count(*) AS clientes, count(*) FILTER (WHERE COALESCE(gps, '') <> '') AS con_gps,
  count(*) FILTER (WHERE gps_valido) AS gps_validos, round(count(*) FILTER (WHERE gps_valido) / count(*) * 100, 2) AS pct_validos
FROM sil_clientes GROUP BY ALL""", "source_empresa:s, clientes:i, con_gps:i, gps_validos:i, pct_validos:d"))
def g22(lk):
    """GPS text and valid-coordinate coverage per tenant."""
    return R.gps_coverage(lk.sil("clientes"))


ADMIN_MAIL = "admin@corp.example"
_ENTRY = "STRUCT(empresa VARCHAR, codVendedor VARCHAR, status VARCHAR)[]"
O.view("user_documents", ["stg_vendedores", "tenants"], f"""
SELECT 'vendedores' AS source, substr(sha256(correo), 1, 20) AS id, if(cod_ven::INT % 3 = 0, upper(correo), correo) AS email, cod_ven::INT % 7 <> 0 AS on_,
  source_empresa AS tenant, '' AS role, [struct_pack(empresa := source_empresa, codVendedor := cod_ven, status := if(cod_ven::INT % 5 = 0, 'I', 'A'))] AS entries
FROM stg_vendedores
UNION ALL SELECT source, substr(sha256(name || source_empresa), 1, 20), name || '@' || source_empresa || '.com', TRUE, source_empresa, role, []::{_ENTRY}
FROM tenants, (VALUES ('vendedores', 'supervisor', ''), ('users', 'analista', 'Analista de Ventas'), ('users', 'oficina', 'Oficina')) AS k(source, name, role)""")
O.view("scopes", ["user_documents"], f"""
SELECT id AS uid, lower(email) AS correo, split_part(lower(email), '@', 2) AS domain, if(source = 'users', NULL, coalesce(e.empresa, tenant)) AS source_empresa,
  NULL::VARCHAR AS cod_suc, NULL::VARCHAR AS cod_pro, e.codVendedor AS cod_ven, if(source = 'users', 'ANALISTA_VENTAS', 'VENDEDOR') AS role_type,
  if(on_ AND coalesce(e.status, 'A') = 'A', 'A', 'I') AS status
FROM (SELECT *, unnest(if(len(entries) = 0, [NULL]::{_ENTRY}, entries)) AS e FROM user_documents) WHERE source = 'vendedores' OR contains(role, 'Analista')
UNION ALL SELECT 'superadmin', '{ADMIN_MAIL}', split_part('{ADMIN_MAIL}', '@', 2), NULL, NULL, NULL, NULL, 'SUPERADMIN', 'A'""")
SCOPE_SPEC = "uid:s, correo:s, domain:s, source_empresa:s, cod_suc:s, cod_pro:s, cod_ven:s, role_type:s, status:s"


@query("M13_security_scopes", O.out("SELECT * FROM scopes", SCOPE_SPEC))
def m13(lk):
    """User documents flattened to one scope row per (mail, tenant, branch, seller)."""
    return _scopes(lk)


@query("G23_scope_summary", O.out("""SELECT domain, role_type, status, source_empresa, count(*) AS filas, count(DISTINCT correo) AS usuarios
FROM scopes GROUP BY ALL""", "domain:s, role_type:s, status:s, source_empresa:s, filas:i, usuarios:i"))
def g23(lk):
    """Scope rows and users per domain, role, status and tenant."""
    return R.scope_summary(_scopes(lk))


USAGE_ASOF = "2024-01-30"
USAGE_TZ = "America/Caracas"
_LOCAL = f"CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE '{USAGE_TZ}' AS DATE)"


@query("G24_usage_monitor", O.out(f"""SELECT {_LOCAL} AS dia, 'user' || CAST(user_id AS VARCHAR) || '@corp.com' AS user_email,
  count(*) AS consultas, round(sum(CAST(trunc(value * 1e9) AS BIGINT)) / 1099511627776, 6) AS tib_leidos,
  round(sum(CAST(trunc(value * 1000) AS BIGINT)) / 1000, 3) AS slot_segundos
FROM events WHERE event_type IN ('view', 'click') AND {_LOCAL} > DATE '{USAGE_ASOF}' - 30 AND {_LOCAL} <= DATE '{USAGE_ASOF}'
GROUP BY ALL""", "dia:dt, user_email:s, consultas:i, tib_leidos:d, slot_segundos:d"))
def g24(lk):
    """SELECT jobs, TiB read and slot seconds per local day and user, last 30 days."""
    return R.usage_monitor(A.job_log(lk.spark, lk.d), USAGE_ASOF, USAGE_TZ)


PRINCIPAL = "vendedor.3@asia.com"
SUPERVISOR = "supervisor@asia.com"
_X1 = f"""SELECT {', '.join('v.' + k for k in KEY)}, v.cod_ven, v.neto_dcto FROM fct_ventas v WHERE EXISTS (
  SELECT 1 FROM scopes s WHERE s.correo = '{PRINCIPAL}' AND s.status = 'A' AND (s.role_type <> 'VENDEDOR' OR (
    coalesce(s.source_empresa = v.source_empresa, s.source_empresa IS NULL) AND coalesce(s.cod_ven = v.cod_ven, s.cod_ven IS NULL))))"""


@query("X1_row_scope", O.out(_X1, KEY_SPEC + "cod_ven:s, neto_dcto:d"))
def x1(lk):
    """Fact rows visible to one seller principal (scopes as a semi join, fail closed)."""
    return security.row_scope(lk.fct_ventas, _scopes(lk), PRINCIPAL, lk.tenants).select(*KEY, "cod_ven", "neto_dcto")


@query("J6_semi_security", O.out(_X1.replace(PRINCIPAL, SUPERVISOR), KEY_SPEC + "cod_ven:s, neto_dcto:d"))
def j6(lk):
    """EXISTS-scope semi join for a principal whose scope is one tenant."""
    return security.row_scope(lk.fct_ventas, _scopes(lk), SUPERVISOR, lk.tenants).select(*KEY, "cod_ven", "neto_dcto")


@query("X2_tenant_contract", O.out("SELECT " + ", ".join(KEY) + ", cod_ven, neto_dcto FROM fct_ventas "
                                   "WHERE source_empresa = 'asia' AND cod_ven IN ('1', '2', '3')", KEY_SPEC + "cod_ven:s, neto_dcto:d"))
def x2(lk):
    """Mandatory tenant filter plus a seller list."""
    return security.tenant_view(lk.fct_ventas, "asia", ["1", "2", "3"]).select(*KEY, "cod_ven", "neto_dcto")


_X3_ALLOWED = ["source_empresa", "fecha_registro", "cod_ven", "cod_cli", "cod_art", "rif", "documento", "renglon",
               "unidades_vendidas", "neto_dcto"]


@query("X3_min_exposure", O.out("SELECT source_empresa, fecha_registro, cod_ven, cod_cli, cod_art, unidades_vendidas, neto_dcto FROM fct_ventas",
                                "source_empresa:s, fecha_registro:dt, cod_ven:s, cod_cli:s, cod_art:s, unidades_vendidas:d, neto_dcto:d"))
def x3(lk):
    """Contract view without fiscal id, GPS, document and line, even when asked for."""
    return security.expose(lk.fct_ventas, _X3_ALLOWED)


@query("J1_star_enrich", O.out("""SELECT v.source_empresa, v.tipo_documento, v.cod_suc, v.documento, v.renglon, a.nom_art, c.nom_cli, s.nom_ven
FROM sil_ventas v LEFT JOIN sil_articulos a ON v.source_empresa = a.source_empresa AND v.cod_art = a.cod_art
LEFT JOIN sil_clientes c ON v.source_empresa = c.source_empresa AND v.cod_cli = c.cod_cli
LEFT JOIN sil_vendedores s ON v.source_empresa = s.source_empresa AND v.cod_ven = s.cod_ven""",
    KEY_SPEC + "nom_art:s, nom_cli:s, nom_ven:s"))
def j1(lk):
    """Chain of LEFT equi joins from the sales lines to article, customer and seller masters."""
    t = "source_empresa"
    x = facts.star_enrich(lk.sil_ventas, [(lk.sil("articulos"), [t, "cod_art"], ["nom_art"]),
                                          (lk.sil("clientes"), [t, "cod_cli"], ["nom_cli"]),
                                          (lk.sil("vendedores"), [t, "cod_ven"], ["nom_ven"])])
    return x.select(*KEY, "nom_art", "nom_cli", "nom_ven")


@query("J2_inner_calendar", O.out(f"""SELECT {', '.join(KEY)}, fecha_registro,
  if(inside, strftime(fecha_registro, '%Y-%m'), NULL) AS anio_mes,
  if(inside, isoyear(fecha_registro) || '-W' || lpad(CAST(week(fecha_registro) AS VARCHAR), 2, '0'), NULL) AS anio_semana,
  if(inside, if(day(fecha_registro) <= 15, 'Q1', 'Q2'), NULL) AS quincena_nombre, if(inside, NULL, 'NO_CALENDAR_DAY') AS reason
FROM (SELECT *, COALESCE(fecha_registro BETWEEN DATE '1995-06-01' AND DATE '2009-12-31', FALSE) AS inside FROM sil_ventas) s""",
                                  KEY_SPEC + "fecha_registro:dt, anio_mes:s, anio_semana:s, quincena_nombre:s, reason:s"))
def j2(lk):
    """Join of the sales lines to a calendar that begins in June 1995; earlier lines come out as rejects with a reason, not lost."""
    cal = dims.calendar(lk.spark, "1995-06-01", lk.CALENDAR[1])
    return facts.tag_calendar(lk.cutover_ventas, cal, "fecha_registro", ["anio_mes", "anio_semana", "quincena_nombre"]).select(
        *KEY, "fecha_registro", "anio_mes", "anio_semana", "quincena_nombre", "reason")


@query("J3_inner_header_line", O.out("""SELECT l.documento, l.renglon, l.cod_art, h.estado FROM
  (SELECT CAST(l_orderkey AS VARCHAR) AS documento, l_linenumber AS renglon, CAST(l_partkey AS VARCHAR) AS cod_art FROM lineitem) l
  JOIN (SELECT CAST(o_orderkey AS VARCHAR) AS documento, o_orderstatus AS estado FROM orders WHERE o_orderstatus IN ('F', 'O')) h
    ON l.documento = h.documento
  JOIN (SELECT DISTINCT cod_art FROM sil_articulos) m ON l.cod_art = m.cod_art""", "documento:s, renglon:i, cod_art:s, estado:s"))
def j3(lk):
    """Header ⋈ line with a status filter, inner join to the article master (orphans dropped)."""
    from ..sources.tables import read_table
    lines = read_table(lk.spark, lk.d, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey"]).select(
        F.col("l_orderkey").cast("string").alias("documento"), F.col("l_linenumber").alias("renglon"),
        F.col("l_partkey").cast("string").alias("cod_art"))
    headers = read_table(lk.spark, lk.d, "orders", ["o_orderkey", "o_orderstatus"]).select(
        F.col("o_orderkey").cast("string").alias("documento"), F.col("o_orderstatus").alias("estado"))
    return facts.header_line(lines, headers, "documento", ["F", "O"], "estado", [(lk.sil("articulos"), ["cod_art"])])


@query("J4_tenant_cross", O.out(f"""SELECT c.empresa, c.clientes, s.skus, c.clientes * s.skus AS pares_esperados FROM
  (SELECT source_empresa AS empresa, count(DISTINCT cod_cli) AS clientes FROM fct_ventas
   WHERE fecha_registro BETWEEN DATE '{AS_OF}' - 90 AND DATE '{AS_OF}' GROUP BY ALL) c
  JOIN (SELECT source_empresa AS empresa, count(DISTINCT cod_art) AS skus FROM fct_ventas
   WHERE fecha_registro BETWEEN DATE '{AS_OF}' - 90 AND DATE '{AS_OF}' GROUP BY ALL) s USING (empresa)""",
    "empresa:s, clientes:i, skus:i, pares_esperados:i"))
def j4(lk):
    """Size of the per-tenant customer x SKU expected matrix, from per-tenant counts (no pairs emitted)."""
    w = R._window(lk.fct_ventas, AS_OF, 90)
    c = w.groupBy(F.col("source_empresa").alias("empresa")).agg(F.count_distinct("cod_cli").alias("clientes"))
    s = w.groupBy(F.col("source_empresa").alias("empresa")).agg(F.count_distinct("cod_art").alias("skus"))
    return c.join(s, "empresa").withColumn("pares_esperados", F.col("clientes") * F.col("skus"))


@query("J5_shifted_self_join", O.out("""WITH d AS (SELECT source_empresa, fecha_registro AS fecha, round(sum(neto_dcto), 2) AS venta
  FROM fct_ventas GROUP BY ALL)
SELECT a.source_empresa, a.fecha, a.venta, p.venta AS venta_anio_anterior FROM d a
LEFT JOIN (SELECT source_empresa, CAST(fecha + INTERVAL 1 YEAR AS DATE) AS fecha, venta FROM d) p USING (source_empresa, fecha)""",
    "source_empresa:s, fecha:dt, venta:d, venta_anio_anterior:d"))
def j5(lk):
    """Daily sales per tenant joined to the same day last year."""
    d = lk.fct_ventas.groupBy("source_empresa", F.col("fecha_registro").alias("fecha")).agg(
        F.round(F.sum("neto_dcto"), 2).alias("venta"))
    p = d.select("source_empresa", F.add_months("fecha", 12).alias("fecha_equivalente"), F.col("venta").alias("venta_anio_anterior"))
    return R.same_day_last_year(d, p, ["source_empresa"])


@query("J7_anti_no_purchase", O.out(f"""SELECT DISTINCT source_empresa, cod_cli FROM fct_ventas
WHERE fecha_registro BETWEEN DATE '{AS_OF}' - 90 AND DATE '{AS_OF}' AND neto_dcto > 0
EXCEPT SELECT DISTINCT source_empresa, cod_cli FROM fct_ventas
WHERE fecha_registro BETWEEN date_trunc('month', DATE '{AS_OF}') AND DATE '{AS_OF}' AND neto_dcto > 0""",
    "source_empresa:s, cod_cli:s"))
def j7(lk):
    """90-day buyers EXCEPT this month's buyers (left anti join)."""
    f = lk.fct_ventas.filter(F.col("neto_dcto") > 0)
    port = R._window(f, AS_OF, 90).select("source_empresa", "cod_cli").dropDuplicates()
    month = f.filter(F.col("fecha_registro").between(R._month_start(AS_OF), R._d(AS_OF))).select("source_empresa", "cod_cli")
    return kpis.without_purchase(port, month, ["source_empresa", "cod_cli"])


# ---------------------------------------------------------------- telemetry
O.view("tel_events", [], """SELECT event_id, event_type AS event_name, 'req-' || CAST(CAST(trunc(event_id / 3) AS BIGINT) AS VARCHAR) AS request_id,
  'user' || CAST(user_id AS VARCHAR) AS subject, CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'SUCCESS' END AS status,
  value * 1000 AS duration_ms, CASE WHEN event_type = 'error' THEN 'E500' END AS error_code,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts, props AS attributes
FROM events WHERE event_id % 53 <> 0""")


def _parsed(lk):
    return L.parse_event_lines(A.telemetry_lines(lk.spark, lk.d))


@query("L1_incident_filter", O.out("""SELECT event_id, event_name, status, duration_ms, error_code FROM tel_events
WHERE status <> 'SUCCESS' OR duration_ms > 10000""", "event_id:i, event_name:s, status:s, duration_ms:d, error_code:s"))
def l1(lk):
    """L1: JSON event lines (malformed dropped) -> failures or calls slower than 10 s."""
    return L.incidents(_parsed(lk)).select("event_id", "event_name", "status", "duration_ms", "error_code")


@query("L2_success_sampling", O.out("""SELECT event_id, status FROM tel_events
WHERE status <> 'SUCCESS' OR ((event_id * 2654435761) % 4294967296) % 100 < 10""", "event_id:i, status:s"))
def l2(lk):
    """L2: all failures plus a deterministic 10 % of successes."""
    return L.sample_success(_parsed(lk), 10).select("event_id", "status")


@query("L3_typed_attributes", O.out("""SELECT event_id,
  j.key || CASE WHEN j.type = 'VARCHAR' THEN '_s' ELSE '_d' END AS atributo,
  CASE WHEN j.type <> 'VARCHAR' THEN CAST(j.value AS DOUBLE) END AS valor_d,
  CASE WHEN j.type = 'VARCHAR' THEN json_extract_string(j.value, '$') END AS valor_s
FROM tel_events, json_each(attributes) AS j WHERE j.type IN ('UBIGINT', 'BIGINT', 'DOUBLE', 'VARCHAR')""",
    "event_id:i, atributo:s, valor_d:d, valor_s:s"))
def l3(lk):
    """L3: event attributes typed by their JSON type (_d numbers, _s text; booleans and nulls dropped)."""
    return L.typed_attributes(_parsed(lk))


@query("L4_latency_summary", O.out("""SELECT event_name, substr(ts, 1, 10) AS dia, count(*) AS total,
  count(*) FILTER (WHERE status = 'SUCCESS') AS pass, round(quantile_cont(duration_ms, 0.95), 3) AS p95_ms
FROM tel_events GROUP BY ALL""", "event_name:s, dia:s, total:i, pass:i, p95_ms:d"))
def l4(lk):
    """L4: pass count and exact P95 latency per event kind and day."""
    e = _parsed(lk).withColumn("dia", F.substring("ts", 1, 10))
    return L.latency_summary(e, ["event_name", "dia"])


# The oracle walks the curve bit by bit: in each of 30 steps the quadrant (2 i + j) has a place that depends on how the curve is turned.
_TURN = "[[0, 1, 3, 2], [0, 3, 1, 2], [2, 3, 1, 0], [2, 1, 3, 0]]"  # fixed values: place of a quadrant, by turn
_NEXT = "[1, 0, 0, 3]"  # fixed values: what a place does to the turn
_ST = "if({c} >= 0, 0.5 * sqrt(1 + 3 * {c}), 1 - 0.5 * sqrt(1 - 3 * {c}))"
O.view("s2_leaves", ["sil_clientes"], f"""
WITH RECURSIVE p AS (SELECT source_empresa, cod_cli, cos(radians(latitud)) * cos(radians(longitud)) AS x, cos(radians(latitud)) * sin(radians(longitud)) AS y, sin(radians(latitud)) AS z
  FROM sil_clientes WHERE latitud BETWEEN -90 AND 90 AND longitud BETWEEN -180 AND 180),
f AS (SELECT *, if(abs(x) >= abs(y) AND abs(x) >= abs(z), if(x < 0, 3, 0), if(abs(y) >= abs(z), if(y < 0, 4, 1), if(z < 0, 5, 2))) AS face FROM p),
uv AS (SELECT *, [y / x, -x / y, -x / z, z / x, z / y, -y / z][face + 1] AS u, [z / x, z / y, -y / z, y / x, -x / y, -x / z][face + 1] AS v FROM f),
ij AS (SELECT source_empresa, cod_cli, face, greatest(0, least(1073741823, floor(1073741824 * {_ST.format(c='u')})))::BIGINT AS i,
  greatest(0, least(1073741823, floor(1073741824 * {_ST.format(c='v')})))::BIGINT AS j FROM uv),
walk AS (SELECT source_empresa, cod_cli, face, i, j, 29 AS k, face & 1 AS turn, 0::BIGINT AS n FROM ij
  UNION ALL SELECT source_empresa, cod_cli, face, i, j, k - 1, xor(turn, {_NEXT}[q + 1]), n * 4 + q
  FROM (SELECT *, {_TURN}[turn + 1][(2 * ((i >> k) & 1) + ((j >> k) & 1))::INT + 1] AS q FROM walk WHERE k >= 0) w)
SELECT source_empresa, cod_cli, face::UHUGEINT * 2305843009213693952::UHUGEINT + n::UHUGEINT * 2 + 1 AS leaf FROM walk WHERE k < 0""")


def _cell(level: int) -> str:
    """Token of the parent of ``level``: the leaf's digits down to the level's lowest bit, which is set."""
    low = 1 << 2 * (30 - level)
    return f"rtrim(format('{{:016x}}', ((leaf // {2 * low}) * {2 * low} + {low})::UBIGINT), '0')"


@query("P10_geo_density", O.out(f"""
SELECT s.source_empresa, nivel, celda, count(*) AS clientes, round(ifnull(sum(venta), 0), 2) AS venta_neta
FROM (SELECT source_empresa, cod_cli, unnest([10, 30]) AS nivel, unnest([{_cell(10)}, {_cell(30)}]) AS celda FROM s2_leaves) s
LEFT JOIN (SELECT source_empresa, cod_cli, sum(neto_dcto) AS venta FROM fct_ventas GROUP BY ALL) v USING (source_empresa, cod_cli) GROUP BY ALL""",
    "source_empresa:s, nivel:i, celda:s, clientes:i, venta_neta:d"))
def p10(lk):
    """P10: customers and net sales per S2 cell, of level 10 and of the leaf level 30."""
    from ..operators.geo import geo_density
    by_level = [geo_density(lk.sil("clientes"), lk.fct_ventas, n).withColumn("nivel", F.lit(n)) for n in (10, 30)]
    return by_level[0].unionByName(by_level[1])
