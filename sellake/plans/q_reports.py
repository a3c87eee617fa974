"""Report queries (G1-G11) and their DuckDB oracles."""

from __future__ import annotations

from . import oracle as O
from .lake import AS_OF
from .queries import query
from ..operators import reports as R

A = f"DATE '{AS_OF}'"
M0 = f"date_trunc('month', {A})"
W90 = f"fecha_registro BETWEEN {A} - 90 AND {A}"
SUC = "LEFT JOIN branches suc ON v.source_empresa = suc.source_empresa AND v.cod_suc = suc.cod_suc"
G_KEYS = ("v.source_empresa AS empresa, v.cod_suc AS codigo_sucursal, COALESCE(suc.nom_suc, v.cod_suc) AS nombre_sucursal, "
          "v.cod_ven AS codigo_vendedor, v.nom_ven AS nombre_vendedor, v.cod_pro AS codigo_proveedor, "
          "v.nom_pro AS nombre_proveedor, v.cod_mar AS codigo_marca, v.nom_mar AS nombre_marca")
G_SPEC = ("empresa:s, codigo_sucursal:s, nombre_sucursal:s, codigo_vendedor:s, nombre_vendedor:s, codigo_proveedor:s, "
          "nombre_proveedor:s, codigo_marca:s, nombre_marca:s, ")
INM = f"v.fecha_registro >= {M0}"
#: The report keys as the fact has them, and as the report names them (branch name looked up at the end).
RAW = "source_empresa, cod_suc, cod_ven, nom_ven, cod_pro, nom_pro, cod_mar, nom_mar"
BRANCH = "COALESCE((SELECT max(b.nom_suc) FROM branches b WHERE b.source_empresa = {t}.source_empresa AND b.cod_suc = {t}.cod_suc), {t}.cod_suc)"
NAMED = ("source_empresa AS empresa, cod_suc AS codigo_sucursal, " + BRANCH + " AS nombre_sucursal, cod_ven AS codigo_vendedor, "
         "nom_ven AS nombre_vendedor, cod_pro AS codigo_proveedor, nom_pro AS nombre_proveedor, cod_mar AS codigo_marca, nom_mar AS nombre_marca")
# --- Fixed values: labels of the reports ---
STATUS_90D = ("PENDIENTE POR ACTIVAR (>90d)", "ACTIVADO (<=90d)")
FREQUENCY = ("Tipo 0 (Inactivo)", "Tipo 1 (1 Semana / Esporádico)", "Tipo 2 (2 Semanas / Ocasional)", "Tipo 3 (3 Semanas / Regular)",
             "Tipo 4 (Todas las Semanas / Frecuente)")


@query("G1_activable_90d", O.out(f"""
WITH member AS (  -- one row per key and customer
  SELECT {RAW}, cod_cli, max(fecha_registro) AS ultima, sum(cajas_vendidas) AS c, sum(neto_dcto) AS v,
    sum(if(fecha_registro < {M0}, 0, cajas_vendidas)) AS cm, sum(if(fecha_registro < {M0}, 0, neto_dcto)) AS vm
  FROM fct_ventas WHERE {W90} GROUP BY ALL),
base AS (SELECT {RAW}, count(cod_cli) AS n, count(cod_cli) FILTER (ultima >= {M0}) AS act, sum(cm) AS cm, sum(vm) AS vm, sum(c) AS c,
    sum(v) AS v, max(ultima) AS ultima FROM member GROUP BY ALL)
SELECT {NAMED.format(t="base")}, n AS base_activable_clientes_90d, act AS clientes_activados_mes_actual,
  n - act AS clientes_pendientes_activacion_mes, round(100.0 * act / nullif(n, 0), 2) AS pct_activacion_mes_actual,
  round(cm, 2) AS cajas_vendidas_mes_actual, round(vm, 2) AS venta_usd_mes_actual, round(c, 2) AS total_cajas_90d,
  round(v, 2) AS monto_total_venta_usd_90d, ultima AS fecha_ultima_venta FROM base""", G_SPEC + (
    "base_activable_clientes_90d:i, clientes_activados_mes_actual:i, clientes_pendientes_activacion_mes:i, "
    "pct_activacion_mes_actual:d, cajas_vendidas_mes_actual:d, venta_usd_mes_actual:d, total_cajas_90d:d, "
    "monto_total_venta_usd_90d:d, fecha_ultima_venta:dt")))
def g1(lk):
    """G1: 90-day activable customer base and month activation per branch/seller/supplier/brand."""
    return R.activable_90d(lk.fact_90d, lk.branches, lk.as_of)


@query("G2_activable_rif_90d", O.out(f"""
WITH line AS (SELECT *, trim(rif) AS id, fecha_registro >= {M0} AS en_mes FROM fct_ventas WHERE {W90} AND trim(rif) <> ''),
marked AS (  -- the first line of each fiscal id, of each one bought this month, and of each point of sale stands for it
  SELECT *, row_number() OVER (PARTITION BY {RAW}, id) = 1 AS un_id, en_mes AND row_number() OVER (PARTITION BY {RAW}, id, en_mes) = 1 AS un_id_mes,
    cod_cli IS NOT NULL AND row_number() OVER (PARTITION BY {RAW}, cod_cli) = 1 AS un_punto FROM line),
base AS (SELECT {RAW}, sum(un_id::int) AS n, sum(un_punto::int) AS puntos, sum(un_id_mes::int) AS act, sum(if(en_mes, cajas_vendidas, 0)) AS cm,
    sum(if(en_mes, neto_dcto, 0)) AS vm, sum(cajas_vendidas) AS c, sum(neto_dcto) AS v, max(fecha_registro) AS ultima FROM marked GROUP BY ALL)
SELECT {NAMED.format(t="base")}, n AS base_activable_rifs_90d, puntos AS total_puntos_de_venta_cod_cli, act AS rifs_activados_mes_actual,
  n - act AS rifs_pendientes_activacion_mes, round(100.0 * act / n, 2) AS pct_activacion_rif_mes_actual, round(cm, 2) AS cajas_vendidas_mes_actual,
  round(vm, 2) AS venta_usd_mes_actual, round(c, 2) AS total_cajas_90d, round(v, 2) AS monto_total_venta_usd_90d, ultima AS fecha_ultima_venta
FROM base""", G_SPEC + (
    "base_activable_rifs_90d:i, total_puntos_de_venta_cod_cli:i, rifs_activados_mes_actual:i, "
    "rifs_pendientes_activacion_mes:i, pct_activacion_rif_mes_actual:d, cajas_vendidas_mes_actual:d, venta_usd_mes_actual:d, "
    "total_cajas_90d:d, monto_total_venta_usd_90d:d, fecha_ultima_venta:dt")))
def g2(lk):
    """The 90-day base by fiscal id (blank ids dropped) with points of sale."""
    return R.activable_rif_90d(lk.fact_90d, lk.branches, lk.as_of)


@query("G3_activable_volume", O.out(f"""
SELECT source_empresa AS empresa, cod_suc AS codigo_sucursal, cod_ven AS codigo_vendedor, nom_ven AS nombre_vendedor, cod_pro AS codigo_proveedor,
  nom_pro AS nombre_proveedor, cod_mar AS codigo_marca, nom_mar AS nombre_marca, len(list_distinct(list(cod_cli))) AS base_activable_clientes,
  len(list_distinct(list(cod_art))) AS skus_distintos_comprados, len(list_distinct(list(documento))) AS total_documentos,
  sum(unidades_vendidas) AS total_unidades, round(sum(cajas_vendidas), 2) AS total_cajas, round(sum(peso_total_toneladas), 3) AS total_toneladas,
  round(sum(neto_dcto), 2) AS monto_total_venta_usd, max(fecha_registro) AS fecha_ultima_venta FROM fct_ventas WHERE {W90} GROUP BY ALL""",
    "empresa:s, codigo_sucursal:s, codigo_vendedor:s, nombre_vendedor:s, codigo_proveedor:s, nombre_proveedor:s, codigo_marca:s, nombre_marca:s, "
    "base_activable_clientes:i, skus_distintos_comprados:i, total_documentos:i, total_unidades:d, total_cajas:d, total_toneladas:d, "
    "monto_total_venta_usd:d, fecha_ultima_venta:dt"))
def g3(lk):
    """90-day volume base: distinct customers, SKUs, documents, units, boxes, tons."""
    return R.activable_volume(lk.fact_90d, lk.as_of)


_KEYED = "concat(source_empresa, cod_suc, cod_ven, cod_pro, cod_cli) <> '' AND cod_suc IS NOT NULL AND cod_ven IS NOT NULL AND cod_pro IS NOT NULL AND cod_cli IS NOT NULL"


@query("G4_customer_master", O.out(f"""
WITH line AS (  -- each line with the figures of its customer; a line without a whole key has none
  SELECT *, max(fecha_registro) FILTER (q) OVER k AS ult, sum(cajas_vendidas) FILTER (q) OVER k AS c90, sum(neto_dcto) FILTER (q) OVER k AS v90,
    max(fecha_registro) FILTER (q AND fecha_registro >= {M0}) OVER k AS ult_mes, sum(cajas_vendidas) FILTER (q AND fecha_registro >= {M0}) OVER k AS cm,
    sum(neto_dcto) FILTER (q AND fecha_registro >= {M0}) OVER k AS vm
  FROM (SELECT *, {W90} AND {_KEYED} AS q FROM fct_ventas)
  WINDOW k AS (PARTITION BY source_empresa, cod_suc, cod_ven, cod_pro, cod_cli)),
one AS (SELECT DISTINCT source_empresa, cod_suc, cod_ven, nom_ven, cod_pro, nom_pro, cod_cli, nom_cli, nullif(trim(rif), '') AS rif, nom_cla, nom_est,
    nom_ciu, ult, ult_mes, c90, v90, cm, vm FROM line)
SELECT source_empresa AS empresa, COALESCE((SELECT max(e.nombre_empresa) FROM dim_empresa e WHERE e.source_empresa = one.source_empresa), source_empresa)
    AS nombre_empresa, cod_suc AS codigo_sucursal, {BRANCH.format(t="one")} AS nombre_sucursal, cod_ven AS codigo_vendedor, nom_ven AS nombre_vendedor,
  cod_pro AS codigo_proveedor, nom_pro AS nombre_proveedor, cod_cli AS codigo_cliente, nom_cli AS nombre_cliente, rif AS rif_cliente,
  nom_cla AS clase_cliente, nom_est AS estado_cliente, nom_ciu AS ciudad_cliente, ult AS fecha_ultima_compra,
  ifnull({A} - ult, 999) AS dias_sin_comprar, {list(STATUS_90D)}[1 + (ult IS NOT NULL)::int] AS estatus_activacion_90d,
  ult IS NOT NULL AS es_cliente_activado_90d, ult_mes IS NOT NULL AS compro_en_mes_actual, ifnull(round(cm, 2), 0) AS cajas_mes_actual,
  ifnull(round(vm, 2), 0) AS venta_usd_mes_actual, ifnull(round(c90, 2), 0) AS cajas_totales_90d, ifnull(round(v90, 2), 0) AS venta_usd_totales_90d
FROM one""",
    "empresa:s, nombre_empresa:s, codigo_sucursal:s, nombre_sucursal:s, codigo_vendedor:s, nombre_vendedor:s, "
    "codigo_proveedor:s, nombre_proveedor:s, codigo_cliente:s, nombre_cliente:s, rif_cliente:s, clase_cliente:s, "
    "estado_cliente:s, ciudad_cliente:s, fecha_ultima_compra:dt, dias_sin_comprar:i, estatus_activacion_90d:s, "
    "es_cliente_activado_90d:b, compro_en_mes_actual:b, cajas_mes_actual:d, venta_usd_mes_actual:d, cajas_totales_90d:d, "
    "venta_usd_totales_90d:d"))
def g4(lk):
    """Customer portfolio with days without purchase and 90-day / month metrics."""
    return R.customer_master(lk.fct_ventas, lk.dim_empresa, lk.branches, lk.as_of)


G5_SQL = f"""
WITH week AS (SELECT {RAW}, cod_cli, nom_cli, nullif(trim(rif), '') AS rif, anio_mes, nombre_mes, anio, anio_semana, list(DISTINCT documento) AS docs,
    sum(cajas_vendidas) AS c, sum(neto_dcto) AS v, max(fecha_registro) AS ultima FROM fct_ventas GROUP BY ALL),
mes AS (SELECT * EXCLUDE (anio_semana, docs, c, v, ultima), count(anio_semana) AS n, len(list_distinct(flatten(list(docs)))) AS facturas, sum(c) AS c,
    sum(v) AS v, max(ultima) AS ultima FROM week GROUP BY ALL)
SELECT {NAMED.format(t="mes")}, cod_cli AS codigo_cliente, nom_cli AS nombre_cliente, rif AS rif_cliente, anio_mes, nombre_mes, anio,
  n AS semanas_con_compra, facturas AS total_facturas_mes, round(c, 2) AS cajas_compradas_mes, round(v, 2) AS venta_usd_mes,
  ultima AS fecha_ultima_compra_mes, least(n, 4) AS tipo_cliente_frecuencia_num, {list(FREQUENCY)}[1 + least(n, 4)] AS tipo_cliente_frecuencia_nombre
FROM mes"""
O.view("weekly_frequency", ["fct_ventas", "branches"], G5_SQL)


@query("G5_weekly_frequency", O.out("SELECT * FROM weekly_frequency", G_SPEC + (
    "codigo_cliente:s, nombre_cliente:s, rif_cliente:s, anio_mes:s, nombre_mes:s, anio:i, semanas_con_compra:i, "
    "total_facturas_mes:i, cajas_compradas_mes:d, venta_usd_mes:d, fecha_ultima_compra_mes:dt, "
    "tipo_cliente_frecuencia_num:i, tipo_cliente_frecuencia_nombre:s")))
def g5(lk):
    """Weekly purchase frequency type per customer and month."""
    return R.weekly_frequency(lk.client_fact, lk.branches)


@query("G6_frequency_distribution", O.out("""
SELECT empresa, anio_mes, tipo_cliente_frecuencia_num, tipo_cliente_frecuencia_nombre,
       count(DISTINCT codigo_cliente) AS clientes, round(sum(venta_usd_mes), 2) AS venta_usd
FROM weekly_frequency GROUP BY ALL""",
    "empresa:s, anio_mes:s, tipo_cliente_frecuencia_num:i, tipo_cliente_frecuencia_nombre:s, clientes:i, venta_usd:d"))
def g6(lk):
    """Customers and amount per frequency type, every month."""
    return R.frequency_distribution(R.weekly_frequency(lk.client_fact, lk.branches))


@query("G7_zero_sale_sku", O.out(f"""
WITH bought AS (  -- per customer and SKU: in the window, and what it came to this month
  SELECT source_empresa, cod_suc, cod_ven, cod_cli, cod_art, sum(neto_dcto) FILTER (fecha_registro >= {M0}) > 0 AS comprado
  FROM fct_ventas WHERE {W90} GROUP BY ALL),
num AS (SELECT *, row_number() OVER (PARTITION BY source_empresa ORDER BY md5(cod_art)[1:2], cod_art) - 1 AS k FROM (SELECT DISTINCT source_empresa, cod_art FROM bought) d),
word AS (SELECT source_empresa, k // 64 AS w, bit_or(1::UBIGINT << (k % 64)::INT) AS whole, count(*) AS n FROM num GROUP BY ALL),
client AS (SELECT DISTINCT source_empresa, cod_suc, cod_ven, cod_cli FROM bought),
own AS (SELECT source_empresa, cod_suc, cod_ven, cod_cli, k // 64 AS w, bit_or(1::UBIGINT << (k % 64)::INT) AS had, count(*) AS si FROM bought JOIN num USING (source_empresa, cod_art)
  WHERE comprado GROUP BY ALL),
gap AS (SELECT source_empresa, cod_suc, cod_ven, cod_cli, sum(n) AS n, sum(ifnull(si, 0)) AS si, string_agg(format('{{:016x}}', whole & ~ifnull(had, 0::UBIGINT)), '' ORDER BY w) AS brechas
  FROM client JOIN word USING (source_empresa) LEFT JOIN own USING (source_empresa, cod_suc, cod_ven, cod_cli, w) GROUP BY ALL)
SELECT source_empresa AS empresa, cod_suc AS codigo_sucursal, {BRANCH.format(t="gap")} AS nombre_sucursal, cod_ven AS codigo_vendedor,
  cod_cli AS codigo_cliente, n AS skus_catalogo, si AS skus_comprados_mes, n - si AS skus_venta_cero, brechas FROM gap""",
    "empresa:s, codigo_sucursal:s, nombre_sucursal:s, codigo_vendedor:s, codigo_cliente:s, skus_catalogo:i, skus_comprados_mes:i, skus_venta_cero:i, brechas:s"))
def g7(lk):
    """Zero-sale SKU gaps per portfolio customer: catalogue, bought this month, number of gaps and their exact bitmap."""
    return R.zero_sale_sku(lk.coded_fact, lk.branches, lk.as_of)


@query("G8_sku_penetration", O.out(f"""
WITH sold AS (SELECT source_empresa AS empresa, cod_suc AS codigo_sucursal, cod_ven AS codigo_vendedor, cod_mar AS codigo_marca, cod_cli, cod_art,
    coalesce(sum(neto_dcto) FILTER (fecha_registro >= {M0}), 0) > 0 AS si FROM fct_ventas WHERE {W90} GROUP BY ALL),
cartera AS (SELECT empresa, codigo_sucursal, codigo_vendedor, count(DISTINCT cod_cli) AS clientes_cartera FROM sold GROUP BY ALL),
marca AS (SELECT empresa, codigo_marca, count(DISTINCT cod_art) AS skus_marca FROM sold GROUP BY ALL),
todo AS (SELECT empresa, sum(skus_marca) AS total FROM marca GROUP BY ALL),
visto AS (SELECT s.empresa, s.codigo_sucursal, s.codigo_vendedor, s.codigo_marca, any_value(skus_marca) AS skus_marca, count(*) FILTER (si) AS pares_comprados
  FROM sold s JOIN marca m ON m.empresa = s.empresa AND m.codigo_marca IS NOT DISTINCT FROM s.codigo_marca GROUP BY ALL),
todos AS (SELECT * FROM visto UNION ALL
  SELECT empresa, codigo_sucursal, codigo_vendedor, '{R.REST}', any_value(total) - sum(skus_marca), 0 FROM visto JOIN todo USING (empresa) GROUP BY 1, 2, 3)
SELECT t.*, clientes_cartera, clientes_cartera * skus_marca AS pares_esperados, clientes_cartera * skus_marca - pares_comprados AS brechas_venta_cero,
  round(100.0 * pares_comprados / nullif(clientes_cartera * skus_marca, 0), 2) AS pct_penetracion
FROM todos t JOIN cartera USING (empresa, codigo_sucursal, codigo_vendedor)""",
    "empresa:s, codigo_sucursal:s, codigo_vendedor:s, codigo_marca:s, clientes_cartera:i, skus_marca:i, pares_comprados:i, pares_esperados:i, "
    "brechas_venta_cero:i, pct_penetracion:d"))
def g8(lk):
    """SKU penetration per branch, seller and brand, with a row for the brands a seller did not sell."""
    return R.sku_penetration(lk.fact_90d, lk.as_of)


@query("G9_sellout_yoy", O.out(f"""
WITH diario AS MATERIALIZED (SELECT {RAW}, cod_art, nom_art, modelo, fecha_registro AS fecha, list(DISTINCT documento) AS docs, list(DISTINCT cod_cli) AS clis, sum(unidades_vendidas) AS u,
    sum(cajas_vendidas) AS c, sum(peso_total_toneladas) AS t, sum(neto_dcto) AS v FROM fct_ventas GROUP BY ALL),
corrido AS (SELECT source_empresa, cod_suc, cod_ven, cod_pro, cod_mar, cod_art, (fecha + INTERVAL 1 YEAR)::DATE AS fecha, round(sum(c), 2) AS cp, round(sum(v), 2) AS vp FROM diario GROUP BY ALL),
dias AS (SELECT {O.cal_cols('d')} FROM (SELECT DISTINCT fecha AS d FROM diario) x)
SELECT {NAMED.format(t="diario")}, cod_art AS codigo_articulo, nom_art AS nombre_articulo, modelo, dias.*, len(docs) AS total_documentos, len(clis) AS clientes_unicos_compradores,
  u AS unidades_vendidas_actual, round(c, 2) AS cajas_vendidas_actual, round(t, 3) AS toneladas_vendidas_actual, round(v, 2) AS venta_usd_actual, ifnull(cp, 0) AS cajas_vendidas_anio_anterior,
  ifnull(vp, 0) AS venta_usd_anio_anterior, round(round(v, 2) - ifnull(vp, 0), 2) AS variacion_venta_usd_yoy, round((round(v, 2) - ifnull(vp, 0)) / nullif(vp, 0) * 100, 2) AS pct_crecimiento_yoy
FROM diario JOIN dias USING (fecha) LEFT JOIN corrido USING (source_empresa, cod_suc, cod_ven, cod_pro, cod_mar, cod_art, fecha)""",
    "empresa:s, codigo_sucursal:s, nombre_sucursal:s, codigo_vendedor:s, nombre_vendedor:s, codigo_proveedor:s, "
    "nombre_proveedor:s, codigo_marca:s, nombre_marca:s, codigo_articulo:s, nombre_articulo:s, modelo:s, fecha:dt, anio:i, "
    "mes:i, nombre_mes:s, anio_mes:s, trimestre:i, trimestre_nombre:s, anio_trimestre:s, semana_del_anio:i, anio_semana:s, "
    "quincena:i, quincena_nombre:s, total_documentos:i, clientes_unicos_compradores:i, unidades_vendidas_actual:d, "
    "cajas_vendidas_actual:d, toneladas_vendidas_actual:d, venta_usd_actual:d, cajas_vendidas_anio_anterior:d, "
    "venta_usd_anio_anterior:d, variacion_venta_usd_yoy:d, pct_crecimiento_yoy:d"))
def g9(lk):
    """Daily sell-out with same day last year, variation and growth %."""
    return R.sellout_yoy(lk.sellout_daily, lk.branches)
