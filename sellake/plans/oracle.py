"""Independent DuckDB SQL for the correctness gate.

The oracle re-states the whole chain in plain SQL over the driver's views:
the stand-in ERP staging, Silver (clean / reject / dedup), Gold facts and each
report. SQL text for the contract-driven Silver steps is generated from the same
contracts (declared metadata), not from the Spark plans.

``sql(names, body)`` prepends only the CTEs the body needs (in dependency order).
"""

from __future__ import annotations

import re

from .. import contracts as C

SENT = "chr(0) || 'NULL' || chr(0)"
TS7 = "strftime({c}, '%Y-%m-%dT%H:%M:%S.%f') || '0'"


def _canon(col: str, kind: str) -> str:
    if kind == "n":
        e = f"CAST(CAST({col} AS DECIMAL(38,10)) AS VARCHAR)"
    elif kind == "t":
        e = f"strftime({col}, '%Y-%m-%dT%H:%M:%S.%f')"
    else:
        e = f"CAST({col} AS VARCHAR)"
    return f"COALESCE({e}, {SENT})"


def row_hash(cols: dict[str, str]) -> str:
    """sha256 of canonical values ordered by column name (kinds: s string, n number, t timestamp)."""
    parts = [_canon(c, cols[c]) for c in sorted(cols)]
    return f"sha256(concat_ws(chr(31), {', '.join(parts)}))"


def _kinds(entity: C.Entity, present: list[str]) -> dict[str, str]:
    return {c: ("n" if entity.col(c).type in ("number", "integer") else "s") for c in present}


def clean_str(c: str) -> str:
    return f"regexp_replace(CAST({c} AS VARCHAR), '^\\s+|\\s+$', '', 'g')"


def nonblank(c: str) -> str:
    return f"NULLIF({clean_str(c)}, '')"


def first_nonblank(a: str, b: str) -> str:
    return f"COALESCE({nonblank(a)}, {b})"


V: dict[str, tuple[list[str], str]] = {}


def view(name: str, deps: list[str], body: str):
    V[name] = (deps, body)


# ---------------------------------------------------------------- adapter
view("tenants", [], "SELECT r_regionkey, lower(replace(r_name, ' ', '_')) AS source_empresa, r_name AS nombre_empresa FROM region")
view("nation_tenant", ["tenants"], "SELECT n.n_nationkey, n.n_name, t.source_empresa, t.nombre_empresa FROM nation n JOIN tenants t ON n.n_regionkey = t.r_regionkey")

SNAP = "TIMESTAMP '2001-08-01 06:00:00'"


def landed(entity: str, inner: str, present: list[str], ingested: str = SNAP) -> str:
    e = C.ALL[entity]
    return (f"SELECT source_empresa, {', '.join(present)}, {row_hash(_kinds(e, present))} AS _row_hash, "
            f"{ingested} AS _ingested_at FROM ({inner}) z")


_ART = ["cod_art", "modelo", "codigo_barras", "nom_art", "cod_dep", "cod_sec", "cod_mar", "cod_pro", "cod_uni1", "peso",
        "fraccion", "cap_bulto", "gra_lic", "precio", "cos_ult1", "cod_imp", "status", "fec_ini"]
view("stg_articulos", ["tenants"], landed("articulos", """
SELECT t.source_empresa, a.* FROM (
  SELECT CAST(p_partkey AS VARCHAR) AS cod_art, 'M-' || CAST(p_partkey AS VARCHAR) AS modelo,
         lpad(CAST(p_partkey AS VARCHAR), 13, '0') AS codigo_barras,
         CASE WHEN p_partkey % 97 = 0 THEN '' ELSE p_name || '  ' END AS nom_art,
         p_type AS cod_dep, CAST(p_size % 7 AS VARCHAR) AS cod_sec, p_brand AS cod_mar,
         CAST(p_partkey % (SELECT count(*) FROM supplier) AS VARCHAR) AS cod_pro,
         CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE 'UND' END AS cod_uni1,
         CAST(p_size * 0.25 AS DOUBLE) AS peso, CAST(p_partkey % 13 AS DOUBLE) AS fraccion,
         CASE WHEN p_partkey % 53 = 0 THEN 0.0::DOUBLE ELSE CAST(p_size AS DOUBLE) END AS cap_bulto,
         0.0::DOUBLE AS gra_lic, p_retailprice AS precio, p_retailprice * 0.5::DOUBLE AS cos_ult1,
         '1' AS cod_imp, 'A' AS status, NULL::VARCHAR AS fec_ini
  FROM part) a CROSS JOIN tenants t""", _ART))

view("stg_proveedores", ["tenants"], landed("proveedores", """
SELECT t.source_empresa, a.* FROM (
  SELECT CAST(s_suppkey AS VARCHAR) AS cod_pro, s_name || '  ' AS nom_pro,
         'J-' || lpad(CAST(s_suppkey AS VARCHAR), 8, '0') AS rif, NULL::VARCHAR AS dir_fis, 'A' AS status
  FROM supplier) a CROSS JOIN tenants t""", ["cod_pro", "nom_pro", "rif", "dir_fis", "status"]))

view("stg_almacenes", ["tenants"], landed("almacenes", """
SELECT t.source_empresa, a.* FROM (
  SELECT CAST(s_suppkey AS VARCHAR) AS cod_alm, 'Almacen ' || s_name || '  ' AS nom_alm,
         CAST(s_nationkey AS VARCHAR) AS cod_suc, 'A' AS status
  FROM supplier) a CROSS JOIN tenants t""", ["cod_alm", "nom_alm", "cod_suc", "status"]))

for _ent, _code, _expr, _prefix in (("marcas", "cod_mar", "p_brand", "Marca "), ("departamentos", "cod_dep", "p_type", "Depto "),
                                    ("secciones", "cod_sec", "CAST(p_size % 7 AS VARCHAR)", "Seccion ")):
    _nom = "nom_" + _code[4:]
    view("stg_" + _ent, ["tenants"], landed(_ent, f"""
SELECT t.source_empresa, a.* FROM (
  SELECT {_code}, '{_prefix}' || {_code} || '  ' AS {_nom}, 'A' AS status
  FROM (SELECT DISTINCT {_expr} AS {_code} FROM part) p) a CROSS JOIN tenants t""", [_code, _nom, "status"]))

view("stg_sucursales", ["nation_tenant"], landed("sucursales", """
SELECT source_empresa, CAST(n_nationkey AS VARCHAR) AS cod_suc, 'Sucursal ' || n_name || '  ' AS nom_suc,
       NULL::VARCHAR AS contacto, 'A' AS status FROM nation_tenant""", ["cod_suc", "nom_suc", "contacto", "status"]))
view("stg_estados", ["nation_tenant"], landed("estados", """
SELECT source_empresa, CAST(n_nationkey AS VARCHAR) AS cod_est, n_name || '  ' AS nom_est, 'A' AS status
FROM nation_tenant""", ["cod_est", "nom_est", "status"]))
view("stg_ciudades", ["nation_tenant"], landed("ciudades", """
SELECT source_empresa, CAST(n_nationkey AS VARCHAR) AS cod_ciu, 'Capital ' || n_name || '  ' AS nom_ciu, 'A' AS status
FROM nation_tenant""", ["cod_ciu", "nom_ciu", "status"]))

view("stg_paises", ["nation_tenant"], landed("paises", """
SELECT source_empresa, CAST(n_nationkey AS VARCHAR) AS cod_pai, n_name || '  ' AS nom_pai, 'A' AS status FROM nation_tenant""", ["cod_pai", "nom_pai", "status"]))
view("stg_clases_clientes", ["tenants"], landed("clases_clientes", """
SELECT t.source_empresa, c AS cod_cla, 'Clase ' || lower(c) || '  ' AS nom_cla, if(c = 'MACHINERY', 'I', 'A') AS status
FROM (SELECT DISTINCT c_mktsegment AS c FROM customer) a, tenants t""", ["cod_cla", "nom_cla", "status"]))
view("stg_conceptos", ["tenants"], landed("conceptos", """
SELECT t.source_empresa, p[1] AS cod_con, if(p[1] = '4', '  ', p[3:22] || '  ') AS nom_con, 'A' AS status
FROM (SELECT DISTINCT o_orderpriority AS p FROM orders) a, tenants t""", ["cod_con", "nom_con", "status"]))
view("stg_impuestos", ["tenants"], landed("impuestos", """
SELECT t.source_empresa, CAST(r AS VARCHAR) AS cod_imp, 'IVA ' || r || ' %  ' AS nom_imp, r::DOUBLE AS por_imp1, 'A' AS status
FROM (SELECT DISTINCT round(l_discount * 100)::INT AS r FROM lineitem) a, tenants t""", ["cod_imp", "nom_imp", "por_imp1", "status"]))

_LAT = "CAST(CAST(0.5::DOUBLE + (c_custkey % 160) / 10.0::DOUBLE AS DECIMAL(9,4)) AS VARCHAR)"
_LON = "CAST(CAST(-74.0::DOUBLE + (CAST(trunc(abs(c_acctbal)) AS BIGINT) % 150) / 10.0::DOUBLE AS DECIMAL(9,4)) AS VARCHAR)"
_GPS = f"""CASE c_custkey % 9
    WHEN 0 THEN {_LAT} || ', ' || {_LON}
    WHEN 1 THEN {_LAT} || ';' || {_LON}
    WHEN 2 THEN {_LAT} || '/' || {_LON}
    WHEN 3 THEN {_LAT} || ' ' || {_LON}
    WHEN 4 THEN {_LAT} || ', - ' || regexp_replace({_LON}, '^-', '')
    WHEN 5 THEN '+' || {_LAT} || ',' || {_LON}
    WHEN 6 THEN 'sin coordenadas'
    WHEN 7 THEN ''
    ELSE NULL END"""
_CLI = ["cod_cli", "nom_cli", "rif", "dir_fis", "dir_exa", "cod_pai", "cod_est", "cod_ciu", "gps", "cod_ven", "segmentacion1", "mon_sal", "cod_suc",
        "tip_con", "tip_cli", "status"]
view("stg_clientes", ["nation_tenant"], landed("clientes", f"""
SELECT nt.source_empresa, CAST(c_custkey AS VARCHAR) AS cod_cli,
       CASE WHEN c_custkey % 97 = 0 THEN '   ' ELSE c_name || '  ' END AS nom_cli,
       CASE WHEN c_custkey % 50 = 0 THEN ' ' ELSE 'J-' || CAST(c_custkey % 1000 AS VARCHAR) END AS rif,
       'Calle ' || c_custkey % 500 || '  ' AS dir_fis, if(c_custkey % 5 = 0, '  ', 'Galpon ' || c_custkey % 90) AS dir_exa,
       ['Ordinario', 'Especial', 'Formal'][c_custkey % 3 + 1] AS tip_con, 'T' || c_custkey % 4 AS tip_cli,
       CAST(c_nationkey AS VARCHAR) AS cod_pai, CAST(c_nationkey AS VARCHAR) AS cod_est, CAST(c_nationkey AS VARCHAR) AS cod_ciu,
       {_GPS} AS gps,
       CAST(c_custkey % 20 AS VARCHAR) AS cod_ven, c_mktsegment AS segmentacion1, c_acctbal AS mon_sal,
       CAST(c_nationkey AS VARCHAR) AS cod_suc, 'A' AS status
FROM customer JOIN nation_tenant nt ON c_nationkey = nt.n_nationkey""", _CLI))

view("stg_vendedores", ["nation_tenant"], landed("vendedores", """
SELECT source_empresa, cod_ven, 'Vendedor ' || cod_ven || '  ' AS nom_ven,
       'Vendedor.' || cod_ven || '@' || source_empresa || '.com' AS correo, 'A' AS status
FROM (SELECT DISTINCT nt.source_empresa, CAST(c_custkey % 20 AS VARCHAR) AS cod_ven
      FROM customer JOIN nation_tenant nt ON c_nationkey = nt.n_nationkey) s""",
      ["cod_ven", "nom_ven", "correo", "status"]))

view("sales_source_lines", ["nation_tenant"], """
SELECT nt.source_empresa,
       CASE WHEN l_returnflag = 'R' THEN 'Devolucion' ELSE 'Factura' END AS tipo_documento,
       CAST(c_nationkey AS VARCHAR) AS cod_suc, CAST(l_orderkey AS VARCHAR) AS documento,
       CAST(l_linenumber AS DOUBLE) AS renglon, o_orderdate AS fec_reg,
       CAST(o_custkey % 20 AS VARCHAR) AS cod_ven, CAST(o_custkey AS VARCHAR) AS cod_cli, c_name AS nom_cli,
       CAST(l_partkey AS VARCHAR) AS cod_art, CAST(l_suppkey AS VARCHAR) AS cod_alm,
       l_quantity AS can_art1, l_extendedprice AS mon_bru,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS mon_net,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS mon_imp1,
       CAST(1 AS DECIMAL(18,6)) AS tasa_doc,
       CAST(l_discount AS DECIMAL(18,2)) * 100 AS por_des1,
       'USD' AS cod_mon, CAST(CAST(round(l_tax * 100) AS INTEGER) AS VARCHAR) AS cod_imp,
       round(l_tax * 100, 2) AS por_imp1,
       l_shipdate AS _ingested_at, o_orderkey, o_orderdate
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
JOIN nation_tenant nt ON c_nationkey = nt.n_nationkey""")

_G = "((CAST(mon_net AS DECIMAL(18,6)) + CAST(mon_imp1 AS DECIMAL(18,6))) * CAST(tasa_doc AS DECIMAL(18,6)))"
_SIGN = "(CASE WHEN tipo_documento = 'Devolucion' THEN -1 ELSE 1 END)"
view("erp_sales_lines", ["sales_source_lines"], f"""
SELECT source_empresa, tipo_documento, cod_suc, documento, renglon, cod_ven, cod_cli, nom_cli, cod_art, cod_alm,
       cod_mon, cod_imp, por_imp1, _ingested_at, o_orderkey, o_orderdate,
       {TS7.format(c='fec_reg')} AS registro,
       CAST(can_art1 AS DOUBLE) * {_SIGN} AS can_ven,
       CAST(mon_bru AS DOUBLE) * {_SIGN} AS monto_bruto,
       CAST(CAST({_G} AS DECIMAL(18,2)) * {_SIGN} AS DOUBLE) AS neto,
       CAST(CAST(CAST(por_des1 AS DECIMAL(18,6)) AS DECIMAL(18,2)) AS DOUBLE) AS dcto,
       CAST(CAST(1.0 / CAST(tasa_doc AS DOUBLE) AS DECIMAL(18,6)) AS DOUBLE) AS tasa,
       CAST(CAST({_G} * (1 - CAST(por_des1 AS DECIMAL(18,6)) * 0.01) AS DECIMAL(18,2)) * {_SIGN} AS DOUBLE) AS neto_dcto
FROM sales_source_lines""")

view("sales_versions", ["erp_sales_lines"], """
SELECT s.* REPLACE (
         CASE WHEN v = 'v3' AND o_orderkey % 97 = 0 THEN '' ELSE documento END AS documento,
         CASE WHEN v = 'v3' AND o_orderkey % 7 = 0 THEN ' ' || cod_suc || '  ' ELSE cod_suc END AS cod_suc,
         nom_cli || '  ' AS nom_cli),
       CASE WHEN v = 'v2' THEN '' ELSE NULL END AS cod_pro, v AS _version
FROM erp_sales_lines s,
     unnest(list_filter([CASE WHEN o_orderdate >= TIMESTAMP '1999-01-01' THEN 'v3' END,
                         CASE WHEN o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '2000-01-01' THEN 'v2' END,
                         CASE WHEN o_orderdate < TIMESTAMP '1997-07-01' THEN 'legacy' END], lambda x: x IS NOT NULL)) AS u(v)""")

_PRESENT_SALES = {"tipo_documento", "cod_suc", "documento", "renglon", "registro", "cod_ven", "cod_cli", "nom_cli", "cod_art",
                  "cod_alm", "can_ven", "monto_bruto", "cod_mon", "cod_imp", "por_imp1", "neto", "dcto", "tasa", "neto_dcto",
                  "cod_pro"}
_WIDE = C.SALES["v2"]
_wcols = []
for _n in _WIDE.names:
    _t = "DOUBLE" if _WIDE.col(_n).type == "number" else "VARCHAR"
    _have = ", ".join(f"'{v}'" for v, e in C.SALES.items() if _n in e.names)
    _src = f"CAST({_n} AS {_t})" if _n in _PRESENT_SALES else f"NULL::{_t}"
    _wcols.append(f"CASE WHEN _version IN ({_have}) THEN {_src} END AS {_n}")
_wk = {n: ("n" if _WIDE.col(n).type == "number" else "s") for n in _WIDE.names}
view("stg_ventas_union", ["sales_versions"], f"""
SELECT *, {row_hash(_wk)} AS _row_hash,
  CASE _version WHEN 'v3' THEN 3 WHEN 'v2' THEN 2 ELSE 1 END AS _priority FROM (
  SELECT source_empresa, _ingested_at, _version, {', '.join(_wcols)} FROM sales_versions) z""")
for _v, _e in C.SALES.items():
    view(f"stg_ventas_{_v}", ["stg_ventas_union"],
         f"SELECT source_empresa, _ingested_at, {', '.join(_e.names)}, _row_hash FROM stg_ventas_union WHERE _version = '{_v}'")

view("stg_renglones_almacenes", ["sales_source_lines"], f"""
SELECT *, {row_hash({'cod_alm': 's', 'cod_art': 's', 'exi_act1': 'n', 'registro': 's'})} AS _row_hash,
       CAST(snapshot_date AS TIMESTAMP) AS _ingested_at, strftime(snapshot_date, '%Y%m%d') AS run_id
FROM (SELECT source_empresa, cod_alm, cod_art, exi_act1, snapshot_date,
             {TS7.format(c='CAST(snapshot_date AS TIMESTAMP)')} AS registro
      FROM (SELECT source_empresa, cod_alm, cod_art,
                   CAST(date_trunc('month', _ingested_at) + INTERVAL 1 MONTH AS DATE) AS snapshot_date,
                   sum(can_art1) AS exi_act1
            FROM sales_source_lines GROUP BY ALL) g) z""")

view("stg_renglones_monedas", ["tenants"], f"""
SELECT *, {row_hash({'cod_mon': 's', 'renglon': 'n', 'fecha': 's', 'tasa': 'n', 'comentario': 's', 'registro': 's'})} AS _row_hash,
       CAST(registro AS TIMESTAMP) AS _ingested_at
FROM (SELECT t.source_empresa, event_type AS cod_mon, CAST(event_id AS DOUBLE) AS renglon,
             {TS7.format(c='ts')} AS fecha, value AS tasa, NULL::VARCHAR AS comentario, {TS7.format(c='ts')} AS registro
      FROM events JOIN tenants t ON user_id % 5 = t.r_regionkey) z""")

view("stg_master_snapshots", ["nation_tenant"], """
SELECT 'clientes' AS entity_name, nt.source_empresa, CAST(o_custkey AS VARCHAR) AS natural_key,
       CAST(o_orderdate AS DATE) AS snapshot_date, strftime(o_orderdate, '%Y%m%d') AS run_id,
       o_orderdate AS ingested_at, o_orderkey, o_orderpriority AS prioridad, o_orderstatus AS estado
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation_tenant nt ON c_nationkey = nt.n_nationkey""")


# ---------------------------------------------------------------- Silver
def clean_expr(e: C.Entity, n: str) -> str:
    spec = e.col(n)
    if spec.type in ("number", "integer"):
        return f"TRY_CAST({n} AS DECIMAL(28,10)) AS {n}"
    if spec.type == "timestamp":
        s = clean_str(n)
        return f"TRY_CAST({s} AS TIMESTAMP) AS {n}"
    x = clean_str(n)
    if spec.default is not None:
        x = f"COALESCE(NULLIF({x}, ''), '{spec.default}')"
    return f"{x} AS {n}"


def required_ok(e: C.Entity, n: str) -> str:
    if e.col(n).type in ("number", "integer", "boolean"):
        return f"{n} IS NOT NULL"
    return f"({n} IS NOT NULL AND {clean_str(n)} <> '')"


def checked_required(e: C.Entity) -> list[str]:
    return [c.name for c in e.columns if c.required and c.default is None]


def valid_sql(e: C.Entity) -> str:
    return " AND ".join(required_ok(e, n) for n in checked_required(e)) or "TRUE"


def reason_sql(e: C.Entity) -> str:
    parts = [f"CASE WHEN NOT {required_ok(e, n)} THEN '{n}' END" for n in checked_required(e)]
    return f"array_to_string(list_filter([{', '.join(parts)}], lambda x: x IS NOT NULL), ', ')"


def silver_sql(e: C.Entity, src: str, present: list[str], keep: list[str], order: list[str]) -> str:
    cleaned = ", ".join([*keep, *[clean_expr(e, n) for n in present]])
    key = ", ".join(e.key)
    ords = ", ".join(f"{o} DESC NULLS LAST" for o in order)
    return (f"SELECT * FROM (SELECT {cleaned} FROM {src} WHERE {valid_sql(e)}) c "
            f"QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {ords}, _row_hash DESC NULLS LAST) = 1")


_PRESENT = {
    "articulos": _ART, "proveedores": ["cod_pro", "nom_pro", "rif", "dir_fis", "status"],
    "almacenes": ["cod_alm", "nom_alm", "cod_suc", "status"], "marcas": ["cod_mar", "nom_mar", "status"],
    "departamentos": ["cod_dep", "nom_dep", "status"], "secciones": ["cod_sec", "nom_sec", "status"],
    "sucursales": ["cod_suc", "nom_suc", "contacto", "status"], "estados": ["cod_est", "nom_est", "status"],
    "paises": ["cod_pai", "nom_pai", "status"], "clases_clientes": ["cod_cla", "nom_cla", "status"], "conceptos": ["cod_con", "nom_con", "status"],
    "impuestos": ["cod_imp", "nom_imp", "por_imp1", "status"],
    "ciudades": ["cod_ciu", "nom_ciu", "status"], "clientes": _CLI, "vendedores": ["cod_ven", "nom_ven", "correo", "status"],
    "renglones_almacenes": ["cod_alm", "cod_art", "exi_act1", "registro"],
    "renglones_monedas": ["cod_mon", "renglon", "fecha", "tasa", "comentario", "registro"],
}
for _name, _pres in _PRESENT.items():
    _e = C.ALL[_name]
    _body = silver_sql(_e, "stg_" + _name, _pres, ["source_empresa", "_ingested_at", "_row_hash"], ["_ingested_at"])
    if _name in C.TRANSACTIONS:
        _body = f"SELECT *, CAST(registro AS DATE) AS fecha_registro FROM ({_body}) q"
    view("sil_" + _name, ["stg_" + _name], _body)
    view("rej_" + _name, ["stg_" + _name],
         f"SELECT *, {reason_sql(_e)} AS motivo_rechazo FROM stg_{_name} WHERE NOT ({valid_sql(_e)})")

GPS_LAT = r"^[+-]?\d+(?:\.\d+)?"
GPS_LON = r"^[+-]?\d+(?:\.\d+)?(?:\s*[,;/]\s*|\s+)([+-]?\s*\d+(?:\.\d+)?)"
_LATX = f"TRY_CAST(NULLIF(regexp_extract({clean_str('gps')}, '{GPS_LAT}', 0), '') AS DOUBLE)"
_LONX = (f"TRY_CAST(regexp_replace(NULLIF(regexp_extract({clean_str('gps')}, '{GPS_LON}', 1), ''), '\\s+', '', 'g') AS DOUBLE)")
V["sil_clientes"] = (V["sil_clientes"][0], f"""
SELECT *, CASE WHEN latitud IS NULL OR longitud IS NULL THEN FALSE
               WHEN latitud BETWEEN 0.6 AND 15.7 AND longitud BETWEEN -73.5 AND -59.7 THEN TRUE ELSE FALSE END AS gps_valido,
          CASE WHEN latitud IS NULL OR longitud IS NULL THEN 'NO_PARSEABLE'
               WHEN latitud BETWEEN 0.6 AND 15.7 AND longitud BETWEEN -73.5 AND -59.7 THEN 'VALIDO_VENEZUELA'
               ELSE 'FUERA_VENEZUELA' END AS gps_estado
FROM (SELECT *, {_LATX} AS latitud, {_LONX} AS longitud FROM ({V["sil_clientes"][1]}) b) g""")

_E2 = C.SALES["v2"]
view("ventas_union", ["stg_ventas_union"], "SELECT * EXCLUDE (_version) FROM stg_ventas_union")
view("sil_ventas_dedup", ["ventas_union"],
     silver_sql(_E2, "ventas_union", _E2.names, ["source_empresa", "_ingested_at", "_row_hash", "_priority"],
                ["_priority", "_ingested_at"]))
view("sil_ventas", ["sil_ventas_dedup", "sil_articulos"], f"""
SELECT v.* REPLACE ({first_nonblank('v.cod_pro', 'a.cod_pro')} AS cod_pro), CAST(v.registro AS DATE) AS fecha_registro
FROM sil_ventas_dedup v LEFT JOIN sil_articulos a ON v.source_empresa = a.source_empresa AND v.cod_art = a.cod_art""")
view("rej_ventas", ["ventas_union"],
     f"SELECT *, {reason_sql(_E2)} AS motivo_rechazo FROM ventas_union WHERE NOT ({valid_sql(_E2)})")

# ---------------------------------------------------------------- Gold
view("dim_empresa", ["tenants"],
     "SELECT source_empresa, nombre_empresa, upper(nombre_empresa) || ' C.A.' AS razon_social FROM tenants")


# One look-up relation of all master names; a name on the line wins over the master's.
_NAMES = {"cli": ("sil_clientes", "cod_cli", "nom_cli"), "rif": ("sil_clientes", "cod_cli", "rif"), "ven": ("sil_vendedores", "cod_ven", "nom_ven"),
          "pro": ("sil_proveedores", "cod_pro", "nom_pro"), "mar": ("sil_marcas", "cod_mar", "nom_mar"), "dep": ("sil_departamentos", "cod_dep", "nom_dep")}
view("master_names", sorted({t for t, _, _ in _NAMES.values()}),
     " UNION ALL ".join(f"SELECT '{k}' AS kind, source_empresa, {code} AS code, {name} AS name FROM {t}" for k, (t, code, name) in _NAMES.items()))


def _named(kind: str, own: str, code: str) -> str:
    return (f"COALESCE({nonblank(own)}, (SELECT max(n.name) FROM master_names n WHERE n.kind = '{kind}' AND n.source_empresa = s.source_empresa "
            f"AND n.code = {code}))")


_FROM_ARTICLE = ["cod_mar", "cod_sec", "modelo", "nom_art", "cod_uni1"]
_MEASURES = {"unidades_vendidas": "can_ven", "cajas_vendidas": "round(CAST(can_ven / nullif(art.cap_bulto, 0) AS DECIMAL(38,10)), 2)",
             "peso_total_kg": "round(can_ven * ifnull(art.peso, 0), 2)",
             "peso_total_toneladas": "round(CAST(can_ven * ifnull(art.peso, 0) / 1000 AS DECIMAL(38,10)), 3)"}
view("lines", ["sil_ventas", "sil_articulos", "master_names"], f"""
SELECT s.* EXCLUDE (art, dep) REPLACE ({_named('mar', 's.nom_mar', 's.cod_mar')} AS nom_mar, {_named('ven', 's.nom_ven', 's.cod_ven')} AS nom_ven,
  {_named('cli', 's.nom_cli', 's.cod_cli')} AS nom_cli, {_named('rif', 's.rif', 's.cod_cli')} AS rif, {_named('pro', 's.nom_pro', 's.cod_pro')} AS nom_pro,
  {_named('dep', 's.nom_dep', 's.dep')} AS nom_dep)
FROM (SELECT v.source_empresa, tipo_documento, cod_suc, documento, renglon, registro, fecha_registro, cod_ven, nom_ven, cod_cli, nom_cli, nom_cla,
    nom_est, nom_ciu, v.cod_art, cod_alm, nom_mar, nom_dep, cod_pro, nom_pro, monto_bruto, cod_mon, rif, cod_imp, neto, dcto, tasa, neto_dcto,
    {', '.join(f"COALESCE({nonblank('v.' + c)}, art.{c}) AS {c}" for c in _FROM_ARTICLE)},
    {', '.join(f'{e} AS {n}' for n, e in _MEASURES.items())}, art, art.cod_dep AS dep
  FROM sil_ventas v LEFT JOIN (SELECT source_empresa AS t, cod_art AS k, a AS art FROM sil_articulos a) ON t = v.source_empresa AND k = v.cod_art) s""")

MONTHS = "['Enero','Febrero','Marzo','Abril','Mayo','Junio','Julio','Agosto','Septiembre','Octubre','Noviembre','Diciembre']"
DAYS = "['Domingo','Lunes','Martes','Miércoles','Jueves','Viernes','Sábado']"


def cal_cols(d: str) -> str:
    return f"""CAST(strftime({d}, '%Y%m%d') AS INTEGER) AS fecha_key, {d} AS fecha, year({d}) AS anio, month({d}) AS mes,
  {MONTHS}[month({d})] AS nombre_mes, substr({MONTHS}[month({d})], 1, 3) AS nombre_mes_corto,
  day({d}) AS dia, dayofyear({d}) AS dia_del_anio, quarter({d}) AS trimestre, 'Q' || quarter({d}) AS trimestre_nombre,
  year({d}) || '-Q' || quarter({d}) AS anio_trimestre, week({d}) AS semana_del_anio,
  isoyear({d}) || '-W' || lpad(CAST(week({d}) AS VARCHAR), 2, '0') AS anio_semana,
  isoyear({d}) * 100 + week({d}) AS anio_semana_num,
  CAST(date_trunc('week', {d}) AS DATE) AS inicio_semana, CAST(date_trunc('week', {d}) AS DATE) + 6 AS fin_semana,
  dayofweek({d}) + 1 AS dia_de_semana, {DAYS}[dayofweek({d}) + 1] AS nombre_dia, dayofweek({d}) IN (0, 6) AS es_fin_de_semana,
  CASE WHEN day({d}) <= 15 THEN 1 ELSE 2 END AS quincena, CASE WHEN day({d}) <= 15 THEN 'Q1' ELSE 'Q2' END AS quincena_nombre,
  strftime({d}, '%Y-%m') AS anio_mes, CAST(strftime({d}, '%Y%m') AS INTEGER) AS anio_mes_num,
  day({d}) = 1 AS es_primer_dia_mes, {d} = last_day({d}) AS es_fin_de_mes"""


view("calendar", ["sil_ventas"], f"""
SELECT {cal_cols('d')} FROM (
  SELECT CAST(unnest(generate_series(CAST(date_trunc('year', min(fecha_registro)) AS TIMESTAMP),
                     CAST(date_trunc('year', max(fecha_registro)) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS TIMESTAMP),
                     INTERVAL 1 DAY)) AS DATE) AS d
  FROM sil_ventas) g""")

view("fct_ventas", ["lines", "dim_empresa", "calendar"], """
SELECT l.*, COALESCE(e.nombre_empresa, l.source_empresa) AS nombre_empresa, e.razon_social AS razon_social_empresa,
       c.fecha_key, c.anio, c.mes, c.nombre_mes, c.anio_mes, c.trimestre, c.trimestre_nombre, c.anio_trimestre,
       c.semana_del_anio, c.anio_semana, c.quincena, c.quincena_nombre
FROM lines l LEFT JOIN dim_empresa e ON l.source_empresa = e.source_empresa
JOIN calendar c ON l.fecha_registro = c.fecha""")

view("branches", ["sil_sucursales"], "SELECT source_empresa, cod_suc, nom_suc FROM sil_sucursales")


# ---------------------------------------------------------------- composition
def _order(names: list[str]) -> list[str]:
    seen: list[str] = []

    def visit(n):
        if n in seen:
            return
        for dep in V[n][0]:
            visit(dep)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def _uses(body: str) -> list[str]:
    return [n for n in V if re.search(rf"\b{re.escape(n)}\b", body)]


#: Views that several others read: made once a query.
SHARED = {"sil_ventas", "stg_ventas_union", "snapshot_lines", "sil_articulos", "stock_now", "lines"}


def ctes(uses: list[str]) -> str:
    if not uses:
        return ""
    return "WITH " + ",\n".join(f"{n} AS {'MATERIALIZED ' if n in SHARED else ''}(\n{V[n][1]}\n)" for n in _order(uses)) + "\n"


def sql(body: str, uses: list[str] | None = None) -> str:
    """Prefix ``body`` with the CTEs it references (found by name) and their dependencies."""
    return ctes(_uses(body) if uses is None else uses) + body


KIND_SQL = {
    "s": "CAST({c} AS VARCHAR)",
    "d": "CAST({c} AS DOUBLE)",
    "i": "CAST({c} AS BIGINT)",
    "b": "CAST({c} AS BOOLEAN)",
    "dt": "CAST(CAST({c} AS DATE) AS VARCHAR)",
    "ts": "strftime(CAST({c} AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f')",
}


def out(body: str, spec: str, uses: list[str] | None = None) -> str:
    """Final projection with the exported types (``name:kind, ...``; kinds in ``KIND_SQL``)."""
    cols = []
    for item in spec.split(","):
        item = item.strip()
        if item:
            name, kind = item.split(":")
            cols.append(KIND_SQL[kind].format(c=f'q."{name}"') + f' AS "{name}"')
    return ctes(_uses(body) if uses is None else uses) + f"SELECT {', '.join(cols)} FROM (\n{body}\n) q"
