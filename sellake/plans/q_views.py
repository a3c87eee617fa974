"""Business views G10-G19, each with its oracle. The oracle looks masters up one value at a time instead of joining them."""

from __future__ import annotations

from . import oracle as O
from .lake import AS_OF
from .queries import query
from .. import contracts as C
from ..operators import silver, views as W

#: Masters of the stock relation.
MASTERS = ["almacenes", "articulos", "marcas", "departamentos", "secciones", "proveedores"]


def _masters(lk):
    return {n: lk.sil(n) for n in MASTERS}


def _name(table: str, key: str, name: str, code: str) -> str:
    return f"(SELECT max(m.{name}) FROM {table} m WHERE m.source_empresa = s.source_empresa AND m.{key} = {code})"


def _stock(source: str) -> str:
    """Rows of ``source`` with their article as a struct, looked-up names and the sizes that boxes are made of."""
    names = [("sil_marcas", "cod_mar", "nom_mar"), ("sil_departamentos", "cod_dep", "nom_dep"), ("sil_secciones", "cod_sec", "nom_sec"), ("sil_proveedores", "cod_pro", "nom_pro")]
    found = ", ".join(f"{_name(t, k, n, f's.art.{k}')} AS {n}" for t, k, n in names)
    return f"""SELECT s.*, {_name('sil_almacenes', 'cod_alm', 'nom_alm', 's.cod_alm')} AS nom_alm, {found},
  list_filter([art.cap_bulto, art.fraccion, 1], lambda x: x <> 0)[1] AS capacity, CAST(exi_act1 * ifnull(art.peso, 0) AS DECIMAL(38,10)) AS weight
FROM (SELECT r.*, (SELECT any_value(a) FROM sil_articulos a WHERE a.source_empresa = r.source_empresa AND a.cod_art = r.cod_art) AS art FROM ({source}) r) s"""


def _boxes(size: str) -> str:
    return f"round(CAST(exi_act1 / nullif({size}, 0) AS DECIMAL(38,10)), 2)"


O.view("stock_now", ["sil_renglones_almacenes", "sil_articulos", *(f"sil_{m}" for m in MASTERS)], _stock("SELECT * FROM sil_renglones_almacenes"))


def _spec(columns, **kinds):
    """Types of a view's columns: text unless said otherwise."""
    return ", ".join(f"{c}:{kinds.get(c.replace(' ', '_'), 's')}" for c in columns)


def _kinds(kind: str, *names: str) -> dict[str, str]:
    return dict.fromkeys(names, kind)


# --- Fixed values: columns of the views, as their consumers name them ---
_G11 = ["empresa", "nombre_empresa", "razon_social", "codigo_almacen", "nombre_almacen", "codigo_articulo", "nombre_articulo", "modelo", "marca", "proveedor",
        "fraccion_unitaria", "unidades_totales", "cajas_totales", "peso_unitario", "kg_totales", "toneladas_totales", "capacidad_bultos", "bultos_totales",
        "stock_unidades", "stock_cajas", "peso_total_kg", "fecha_ultima_actualizacion"]


@query("G11_inventory_report", O.out(f"""
SELECT s.source_empresa AS empresa, ifnull(e.nombre_empresa, s.source_empresa) AS nombre_empresa, e.razon_social, cod_alm AS codigo_almacen, ifnull(nom_alm, cod_alm) AS nombre_almacen,
  cod_art AS codigo_articulo, ifnull(art.nom_art, cod_art) AS nombre_articulo, art.modelo AS modelo, art.cod_mar AS marca, art.cod_pro AS proveedor,
  if(ifnull(art.fraccion, 0) = 0, 1, art.fraccion) AS fraccion_unitaria, exi_act1 AS unidades_totales, {_boxes('art.fraccion')} AS cajas_totales,
  ifnull(art.peso, 0) AS peso_unitario, round(weight, 2) AS kg_totales, round(CAST(weight / 1000 AS DECIMAL(38,10)), 3) AS toneladas_totales, capacity AS capacidad_bultos,
  {_boxes('capacity')} AS bultos_totales, exi_act1 AS stock_unidades, {_boxes('art.fraccion')} AS stock_cajas, round(weight, 2) AS peso_total_kg, registro AS fecha_ultima_actualizacion
FROM stock_now s LEFT JOIN dim_empresa e USING (source_empresa) WHERE exi_act1 > 0""",
    _spec(_G11, fecha_ultima_actualizacion="ts", **_kinds("d", *_G11[10:21]))))
def g11(lk):
    """Positive stock with boxes, kg, tons and bulk capacity fallback."""
    return W.inventory_report(lk.sil("renglones_almacenes"), lk.dim_empresa, _masters(lk))


_G12 = ["empresa", "codigo_sucursal", "nombre_sucursal", "codigo_articulo", "nombre_articulo", "modelo", "marca", "codigo_proveedor", "nombre_proveedor", "fecha", "anio", "mes",
        "nombre_mes", "anio_mes", "trimestre", "trimestre_nombre", "anio_trimestre", "semana_del_anio", "anio_semana", "quincena_nombre", "stock_unidades_snapshot",
        "unidades_por_caja", "stock_cajas_snapshot", "peso_total_kg_snapshot", "fecha_ultima_actualizacion"]


@query("G12_inventory_time", O.out(f"""
WITH days AS (SELECT DISTINCT fecha_registro AS d FROM stock_now WHERE fecha_registro BETWEEN DATE '1990-01-01' AND DATE '2009-12-31'), cal AS (SELECT {O.cal_cols('d')} FROM days)
SELECT source_empresa AS empresa, cod_alm AS codigo_sucursal, ifnull(nom_alm, cod_alm) AS nombre_sucursal, cod_art AS codigo_articulo, ifnull(art.nom_art, cod_art) AS nombre_articulo,
  art.modelo AS modelo, art.cod_mar AS marca, art.cod_pro AS codigo_proveedor, ifnull(nom_pro, art.cod_pro) AS nombre_proveedor, cal.* EXCLUDE (fecha_key), exi_act1 AS stock_unidades_snapshot,
  art.cap_bulto AS unidades_por_caja, {_boxes('art.cap_bulto')} AS stock_cajas_snapshot, round(weight, 2) AS peso_total_kg_snapshot, registro AS fecha_ultima_actualizacion
FROM stock_now JOIN cal ON cal.fecha = fecha_registro""",
    _spec(_G12, fecha="dt", fecha_ultima_actualizacion="ts", **_kinds("i", "anio", "mes", "trimestre", "semana_del_anio"), **_kinds("d", *_G12[20:24]))))
def g12(lk):
    """Stock with calendar attributes (inner calendar join), supplier, boxes and kilos."""
    return W.inventory_time(lk.sil("renglones_almacenes"), lk.calendar, _masters(lk))


_G13 = ["Source Empresa", "Fecha Snapshot", "Run ID", "Cod Alm", "Nom Alm", "Cod Art", "Nom Art", "Modelo", "Cod Mar", "Nom Mar", "Cod Dep", "Nom Dep", "Cod Pro", "Nom Pro", "Unidad",
        "Peso Unitario", "Fraccion Unitaria", "Uni Bulto", "Stock", "Fracc Total", "Kilos", "Bultos Tot", "Registro"]
O.view("stock_history", ["stg_renglones_almacenes", "sil_articulos", *(f"sil_{m}" for m in MASTERS)], _stock(f"""
  SELECT source_empresa, snapshot_date, run_id, {O.clean_str('cod_alm')} AS cod_alm, {O.clean_str('cod_art')} AS cod_art, TRY_CAST(exi_act1 AS DECIMAL(28,10)) AS exi_act1,
    {O.clean_expr(C.ALL['renglones_almacenes'], 'registro')} FROM stg_renglones_almacenes
  WHERE {O.clean_str('cod_alm')} <> '' AND {O.clean_str('cod_art')} <> '' AND TRY_CAST(exi_act1 AS DECIMAL(28,10)) IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY source_empresa, snapshot_date, run_id, {O.clean_str('cod_alm')}, {O.clean_str('cod_art')} ORDER BY _ingested_at DESC NULLS LAST, _row_hash DESC NULLS LAST) = 1"""))


@query("G13_inventory_bi_history", O.out(f"""
SELECT source_empresa AS "Source Empresa", snapshot_date AS "Fecha Snapshot", run_id AS "Run ID", cod_alm AS "Cod Alm", nom_alm AS "Nom Alm", cod_art AS "Cod Art", art.nom_art AS "Nom Art",
  art.modelo AS "Modelo", art.cod_mar AS "Cod Mar", nom_mar AS "Nom Mar", art.cod_dep AS "Cod Dep", nom_dep AS "Nom Dep", art.cod_pro AS "Cod Pro", nom_pro AS "Nom Pro", art.cod_uni1 AS "Unidad",
  art.peso AS "Peso Unitario", art.fraccion AS "Fraccion Unitaria", art.cap_bulto AS "Uni Bulto", exi_act1 AS "Stock", {_boxes('art.fraccion')} AS "Fracc Total", round(weight, 2) AS "Kilos",
  {_boxes('capacity')} AS "Bultos Tot", registro AS "Registro" FROM stock_history""",
    _spec(_G13, Fecha_Snapshot="dt", Registro="ts", **_kinds("d", "Peso_Unitario", "Fraccion_Unitaria", "Uni_Bulto", "Stock", "Fracc_Total", "Kilos", "Bultos_Tot"))))
def g13(lk):
    """Inventory snapshot history with the names of warehouse, article, brand, department and supplier."""
    return W.inventory_history(silver.snapshot_dedup(lk.stg("renglones_almacenes")), _masters(lk))


_G14 = ["Procedencia", "Código", "Proveedor", "Categoría", "Marca", "Artículo", "Descripción", "Modelo", "Observación", "Stock", "Precio", "Bulto", "Fracción", "Peso", "Fracc Total", "Kilos",
        "Bultos Tot", "Cód Alm", "Nom Alm", "Source Empresa"]


@query("G14_inventory_bi_matrix", O.out(f"""
SELECT source_empresa AS "Procedencia", art.cod_pro AS "Código", nom_pro AS "Proveedor", nom_dep AS "Categoría", nom_mar AS "Marca", cod_art AS "Artículo", art.nom_art AS "Descripción",
  art.codigo_barras AS "Modelo", nom_sec AS "Observación", exi_act1 AS "Stock", art.precio AS "Precio", art.cap_bulto AS "Bulto", art.fraccion AS "Fracción", art.peso AS "Peso",
  {_boxes('art.fraccion')} AS "Fracc Total", round(weight, 2) AS "Kilos", {_boxes('capacity')} AS "Bultos Tot", cod_alm AS "Cód Alm", nom_alm AS "Nom Alm", source_empresa AS "Source Empresa"
FROM stock_now WHERE exi_act1 > 0""", _spec(_G14, **_kinds("d", "Stock", "Precio", "Bulto", "Fracción", "Peso", "Fracc_Total", "Kilos", "Bultos_Tot"))))
def g14(lk):
    """Current stock > 0 matrix with supplier, department, brand, section, price, barcode and measures."""
    return W.inventory_matrix(lk.sil("renglones_almacenes"), _masters(lk))


_G19 = ["tenant", "nombre_empresa", "codigo_almacen", "nombre_almacen", "codigo_articulo", "nombre_articulo", "modelo", "codigo_marca", "nombre_marca", "codigo_proveedor", "nombre_departamento",
        "nombre_seccion", "unidades_por_caja", "fraccion_unitaria", "peso_unitario_kg", "stock_unidades", "stock_cajas", "fraccion_total", "peso_total_kg", "peso_total_toneladas",
        "fecha_ultima_actualizacion"]


@query("G19_inventory_shared", O.out(f"""
SELECT s.source_empresa AS tenant, ifnull(e.nombre_empresa, s.source_empresa) AS nombre_empresa, cod_alm AS codigo_almacen, ifnull(nom_alm, cod_alm) AS nombre_almacen, cod_art AS codigo_articulo,
  ifnull(art.nom_art, cod_art) AS nombre_articulo, art.modelo AS modelo, art.cod_mar AS codigo_marca, nom_mar AS nombre_marca, art.cod_pro AS codigo_proveedor, nom_dep AS nombre_departamento,
  nom_sec AS nombre_seccion, art.cap_bulto AS unidades_por_caja, art.fraccion AS fraccion_unitaria, art.peso AS peso_unitario_kg, exi_act1 AS stock_unidades, {_boxes('art.cap_bulto')} AS stock_cajas,
  round(exi_act1 * ifnull(art.fraccion, 0), 3) AS fraccion_total, round(weight, 2) AS peso_total_kg, round(CAST(weight / 1000 AS DECIMAL(38,10)), 3) AS peso_total_toneladas,
  registro AS fecha_ultima_actualizacion FROM stock_now s LEFT JOIN dim_empresa e USING (source_empresa) WHERE exi_act1 > 0""",
    _spec(_G19, fecha_ultima_actualizacion="ts", **_kinds("d", *_G19[12:20]))))
def g19(lk):
    """Shared contract of positive stock, with all master names."""
    return W.inventory_shared(lk.sil("renglones_almacenes"), lk.dim_empresa, _masters(lk))


# ---------------------------------------------------------------- sales and customers
_G10 = ["empresa", "codigo_sucursal", "nombre_sucursal", "codigo_vendedor", "nombre_vendedor", "codigo_cliente", "nombre_cliente", "rif_cliente", "clase_cliente", "estado_cliente", "ciudad_cliente",
        "tipo_documento", "numero_documento", "numero_renglon", "timestamp_registro", "fecha", "anio", "mes", "nombre_mes", "anio_mes", "trimestre", "trimestre_nombre", "anio_trimestre",
        "semana_del_anio", "anio_semana", "quincena", "quincena_nombre", "codigo_proveedor", "nombre_proveedor", "codigo_marca", "nombre_marca", "departamento", "seccion", "codigo_articulo",
        "nombre_articulo", "modelo", "unidad_medida", "unidades_vendidas", "cajas_vendidas", "peso_total_kg", "peso_total_toneladas", "monto_bruto", "monto_descuento", "monto_neto", "tasa_cambio",
        "monto_total_usd"]
#: What the view's columns are called in the fact, in the same order.
_G10_FACT = """source_empresa cod_suc {branch} cod_ven nom_ven cod_cli nom_cli {fiscal} nom_cla nom_est nom_ciu tipo_documento documento renglon registro fecha_registro anio mes nombre_mes anio_mes
 trimestre trimestre_nombre anio_trimestre semana_del_anio anio_semana quincena quincena_nombre cod_pro nom_pro cod_mar nom_mar nom_dep cod_sec cod_art nom_art modelo cod_uni1 unidades_vendidas
 cajas_vendidas peso_total_kg peso_total_toneladas monto_bruto dcto neto tasa neto_dcto""".split()
_G10_SQL = ", ".join(f"{c} AS {n}" for c, n in zip(_G10_FACT, _G10)).format(branch=f"ifnull({_name('branches', 'cod_suc', 'nom_suc', 's.cod_suc')}, cod_suc)", fiscal="nullif(trim(rif), '')")


@query("G10_invoice_detail", O.out(f"SELECT {_G10_SQL} FROM fct_ventas s", _spec(
    _G10, numero_renglon="d", timestamp_registro="ts", fecha="dt", **_kinds("i", "anio", "mes", "trimestre", "semana_del_anio", "quincena"), **_kinds("d", *_G10[37:])), ["fct_ventas", "branches"]))
def g10(lk):
    """Invoice line detail: branch, seller, customer, calendar, product, amounts."""
    return W.invoice_detail(lk.fct_ventas, lk.branches)


_G15 = ["S", "Documento", "Fecha", "Código", "Nombre Cliente", "Modelo", "Nom_Mar", "Categoria", "Código Artículo", "Nombre Artículo", "Peso", "Unidad", "Cantidad", "Kilos", "Cod_Mon", "Monto Bruto",
        "Uni Bulto", "Bultos", "Frac Uni", "Fracc_Tot", "Cod Vend", "Vendedor", "Nom_Ciu", "Nom_Cla", "Nom_Pro", "Rif", "Cod_Imp", "Neto", "Dcto", "Tasa", "Neto_Dcto", "Source Empresa", "Tipo Documento"]
_G15_FACT = """cod_suc documento CAST(registro±AS±DATE) cod_cli nom_cli modelo nom_mar nom_dep cod_art nom_art art.peso cod_uni1 unidades_vendidas peso_total_kg cod_mon monto_bruto art.cap_bulto
 cajas_vendidas art.fraccion round(unidades_vendidas*ifnull(art.fraccion,0),2) cod_ven nom_ven nom_ciu nom_cla nom_pro rif cod_imp neto dcto tasa neto_dcto source_empresa tipo_documento""".split()
_G15_SQL = ", ".join(f'{c} AS "{n}"' for c, n in zip(_G15_FACT, _G15)).replace("±", " ")


@query("G15_sales_bi_matrix", O.out(f"""SELECT {_G15_SQL} FROM (SELECT f.*, (SELECT any_value(a) FROM sil_articulos a WHERE a.source_empresa = f.source_empresa AND a.cod_art = f.cod_art) AS art
  FROM fct_bi f) g""", _spec(_G15, Fecha="dt", **_kinds("d", "Peso", "Cantidad", "Kilos", "Monto_Bruto", "Uni_Bulto", "Bultos", "Frac_Uni", "Fracc_Tot", "Neto", "Dcto", "Tasa", "Neto_Dcto"))))
def g15(lk):
    """Sales matrix of the BI fact, 33 columns with display names."""
    return W.sales_matrix(lk.fct_bi, lk.sil("articulos"))


_G16 = ["source_empresa", "tipo_documento", "cod_suc", "documento", "renglon", "registro", "fec_ini", "cod_ven", "nom_ven", "cod_cli", "nom_cli", "nom_cla", "nom_est", "nom_ciu", "cod_art", "cod_alm",
        "cod_mar", "nom_mar", "nom_dep", "cod_sec", "modelo", "cod_pro", "nom_pro", "nom_art", "cod_uni1", "unidades_vendidas", "cajas_vendidas", "peso_total_kg", "peso_total_toneladas",
        "monto_bruto", "cod_mon", "rif", "cod_imp", "neto", "dcto", "tasa", "neto_dcto"]


@query("G16_sales_bi_consumo", O.out(f"SELECT * REPLACE (fec_ini::DATE AS fec_ini) FROM (SELECT *, registro AS fec_ini FROM fct_bi) f", _spec(
    _G16, renglon="d", registro="ts", fec_ini="dt", **_kinds("d", *_G16[25:30], *_G16[33:]))))
def g16(lk):
    """Consumer projection of the BI fact, 37 columns."""
    return W.sales_consumer(lk.fct_bi)


_G17 = ["Cliente", "Nombre", "RIF", "Telefonos", "Fax", "Zona", "Ciudad", "Contribuyente", "Categoría", "Forma Pago", "Contacto", "eMail", "Concepto", "Dirección Fiscal", "Dirección Entrega",
        "Status", "Codigo Vendedor", "Nombre Vendedor", "Web", "Atributo A", "Sucursal", "Source Empresa"]
_G17_FROM = ["cod_cli", "nom_cli", "rif", "NULL", "NULL", "NULL", _name("sil_ciudades", "cod_ciu", "nom_ciu", "s.cod_ciu"), "tip_con", "tip_cli", "NULL", "NULL", "NULL", "NULL", "dir_fis", "dir_exa",
             "status", "cod_ven", _name("sil_vendedores", "cod_ven", "nom_ven", "s.cod_ven"), "NULL", "segmentacion1", "cod_suc", "source_empresa"]


@query("G17_customers_bi", O.out(f"SELECT {', '.join(f'{c} AS {chr(34)}{n}{chr(34)}' for c, n in zip(_G17_FROM, _G17))} FROM sil_clientes s", _spec(_G17)))
def g17(lk):
    """Customer contract view with city and seller names, 22 columns."""
    return W.customers_bi(lk.sil("clientes"), lk.sil("ciudades"), lk.sil("vendedores"))


_G18 = ["tenant", "nombre_empresa", "codigo_sucursal", "codigo_vendedor", "nombre_vendedor", "codigo_cliente", "nombre_cliente", "clase_cliente", "ciudad_cliente", "fecha", "anio", "mes", "nombre_mes",
        "anio_mes", "trimestre", "anio_trimestre", "semana_del_anio", "anio_semana", "quincena", "quincena_nombre", "codigo_proveedor", "nombre_proveedor", "codigo_marca", "nombre_marca",
        "codigo_articulo", "nombre_articulo", "nombre_departamento", "nombre_seccion", "fraccion_unitaria", "peso_unitario_kg", "documentos_emitidos", "unidades_vendidas", "cajas_vendidas",
        "fraccion_total", "peso_total_kg", "toneladas_vendidas", "venta_bruta", "descuentos", "venta_neta_usd"]
_G18_FACT = """source_empresa nombre_empresa cod_suc cod_ven nom_ven cod_cli nom_cli nom_cla nom_ciu fecha_registro anio mes nombre_mes anio_mes trimestre anio_trimestre semana_del_anio anio_semana
 quincena quincena_nombre cod_pro nom_pro cod_mar nom_mar cod_art nom_art nom_dep nom_sec art.fraccion art.peso""".split()


@query("G18_sales_kpi_shared", O.out(f"""SELECT {', '.join(f'{c} AS {n}' for c, n in zip(_G18_FACT, _G18))}, count(DISTINCT documento) AS documentos_emitidos, sum(unidades_vendidas) AS unidades_vendidas,
  round(sum(cajas_vendidas), 2) AS cajas_vendidas, round(sum(unidades_vendidas * ifnull(art.fraccion, 0)), 3) AS fraccion_total, round(sum(peso_total_kg), 2) AS peso_total_kg,
  round(sum(peso_total_toneladas), 3) AS toneladas_vendidas, round(sum(monto_bruto), 2) AS venta_bruta, round(sum(dcto), 2) AS descuentos, round(sum(neto_dcto), 2) AS venta_neta_usd
FROM (SELECT s.*, {_name('sil_secciones', 'cod_sec', 'nom_sec', 's.cod_sec')} AS nom_sec, (SELECT any_value(a) FROM sil_articulos a WHERE a.source_empresa = s.source_empresa AND a.cod_art = s.cod_art) AS art
  FROM fct_ventas s WHERE fecha_registro BETWEEN DATE '2000-01-01' AND DATE '{AS_OF}') g GROUP BY {', '.join(str(i + 1) for i in range(30))}""",
    _spec(_G18, fecha="dt", **_kinds("i", "anio", "mes", "trimestre", "semana_del_anio", "quincena", "documentos_emitidos"), fraccion_unitaria="d", peso_unitario_kg="d", **_kinds("d", *_G18[31:]))))
def g18(lk):
    """Sales KPIs by day and 30 keys for the shared contract (no fiscal id, no document)."""
    return W.sales_shared(lk.fct_ventas, lk.sil("articulos"), lk.sil("secciones"), "2000-01-01", AS_OF)
