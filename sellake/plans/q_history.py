"""History queries: master history, SCD2, typed dims, as-of resolved fact, cutover facts."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import oracle as O
from .lake import AS_OF, Lake
from .q_land import _scratch
from .queries import query
from .. import contracts as C
from ..operators import facts, history, silver
from ..operators.daytable import DayTable

cs = O.clean_str
KEY = ["source_empresa", "tipo_documento", "cod_suc", "documento", "renglon"]
KEY_SPEC = "source_empresa:s, tipo_documento:s, cod_suc:s, documento:s, renglon:d, "

# ---------------------------------------------------------------- oracle views
O.view("stg_cliente_snapshots", ["nation_tenant"], f"""
SELECT *, {O.row_hash({'cod_cli': 's', 'nom_cli': 's', 'prioridad': 's', 'estado': 's'})} AS _row_hash FROM (
  SELECT nt.source_empresa, CAST(o_custkey AS VARCHAR) AS cod_cli, c_name AS nom_cli, o_orderpriority AS prioridad,
         o_orderstatus AS estado, o_orderdate AS _ingested_at, strftime(o_orderdate, '%Y%m%d') AS _run_id
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation_tenant nt ON c_nationkey = nt.n_nationkey) z""")


def _hist_part(entity: str, src: str, key: str, cols: list[str], run: str) -> str:
    e = C.ALL.get(entity)
    fields = []
    for c in cols:
        numeric = e is not None and c in e.names and e.col(c).type == "number"
        fields.append(f"{c} := {c}" if numeric else f"{c} := {cs(c)}")
    return (f"SELECT '{entity}' AS entity_name, trim(source_empresa) AS source_empresa, trim(CAST({key} AS VARCHAR)) AS natural_key, "
            f"CAST(_ingested_at AS DATE) AS snapshot_date, {run} AS run_id, _ingested_at AS ingested_at, "
            f"_row_hash AS record_hash, CAST(to_json(struct_pack({', '.join(fields)})) AS VARCHAR) AS record_json "
            f"FROM {src} WHERE _ingested_at IS NOT NULL")


_RUN = "strftime(_ingested_at, '%Y%m%d%H%M%S')"
_parts = [_hist_part(ent, "stg_cliente_snapshots" if ent == "clientes" else "stg_" + ent, key, cols,
                     f"COALESCE(_run_id, {_RUN})" if ent == "clientes" else _RUN)
          for ent, (key, cols) in Lake.HISTORY_ATTRS.items()]
O.view("master_history", ["stg_cliente_snapshots"] + ["stg_" + e for e in Lake.HISTORY_ATTRS if e != "clientes"],
       "\nUNION ALL\n".join(_parts))
# A version is an island: sightings of a key that follow each other with one hash. Place among all less place among those of the hash is the same within it.
_OF = "entity_name, source_empresa, natural_key"
O.view("scd2", ["master_history"], f"""
WITH sighting AS (SELECT {_OF}, ingested_at AS t, record_hash AS h, max(struct_pack(run := run_id, d := snapshot_date, j := record_json)) AS x FROM master_history GROUP BY ALL),
placed AS (SELECT *, row_number() OVER (PARTITION BY {_OF} ORDER BY t, x.run, h) AS place, row_number() OVER (PARTITION BY {_OF}, h ORDER BY t, x.run) AS own FROM sighting),
island AS (SELECT {_OF}, h, min(place) AS place, min(t) AS t, arg_min(x, place) AS x FROM placed GROUP BY {_OF}, h, place - own),
v AS (SELECT *, count(*) OVER (PARTITION BY {_OF} ORDER BY place) AS n FROM island)
SELECT sha256(entity_name || '|' || source_empresa || '|' || natural_key || '|' || CAST(v.t AS VARCHAR) || '|' || v.h) AS surrogate_key, {_OF}, v.t AS valid_from, w.t AS valid_to,
  w.n IS NULL AS is_current, v.x.d AS snapshot_date, v.x.run AS run_id, v.h AS record_hash, v.x.j AS record_json
FROM v LEFT JOIN (SELECT {_OF}, n - 1 AS n, t FROM v) w USING ({_OF}, n)""")
for _ent, (_key, _cols) in Lake.HISTORY_ATTRS.items():
    _attrs = ", ".join(f"json_extract_string(record_json, '$.{a}') AS {a}" for a in Lake.DIM_ATTRS[_ent])
    O.view(f"dim_{_ent}_scd2", ["scd2"], f"""SELECT surrogate_key, source_empresa, natural_key AS {_key}, valid_from, valid_to,
  is_current, run_id, record_hash, {_attrs} FROM scd2 WHERE entity_name = '{_ent}'""")

_DIMS = [("cliente", "clientes", "cod_cli"), ("articulo", "articulos", "cod_art"), ("vendedor", "vendedores", "cod_ven"),
         ("sucursal", "sucursales", "cod_suc"), ("almacen", "almacenes", "cod_alm"), ("proveedor", "proveedores", "cod_pro")]
# --- Fixed values: resolution labels ---
RESOLVED, BACKFILL, UNRESOLVED, INFERRED = "RESOLVED_SCD2", "CURRENT_MASTER_BACKFILL", "UNKNOWN_UNRESOLVED", "INFERRED_FROM_FACT"
# The six codes of a line are stacked, so that one as-of join and one join to the current versions resolve them all.
_stack = ", ".join(f"struct_pack(d := '{n}', e := '{e}', k := {k})" for n, e, k in _DIMS)
_wide = ", ".join(f"max(a) FILTER (d = '{n}') AS {n}_a, max(c) FILTER (d = '{n}') AS {n}_c" for n, _, _ in _DIMS)
_sks = ", ".join(f"COALESCE({n}_a, {n}_c, 'UNKNOWN') AS {n}_sk, list_extract(['{UNRESOLVED}', '{BACKFILL}', '{RESOLVED}'], "
                 f"1 + if({n}_a IS NOT NULL, 2, ({n}_c IS NOT NULL)::int)) AS {n}_resolution_status" for n, _, _ in _DIMS)
O.view("fct_ventas_v2", ["lines", "scd2"], f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS rid, * FROM lines),
ver AS MATERIALIZED (SELECT * FROM scd2),
code AS (SELECT rid, source_empresa AS t, registro AS r, unnest([{_stack}], recursive := true) FROM v),
hit AS (SELECT rid, d, s.surrogate_key AS a FROM code ASOF JOIN (SELECT * FROM ver WHERE valid_to IS NULL OR valid_to > valid_from) s
  ON s.entity_name = e AND s.source_empresa = t AND s.natural_key = k AND r >= s.valid_from),
now AS (SELECT rid, d, surrogate_key AS c, record_json FROM code JOIN ver ON entity_name = e AND source_empresa = t AND natural_key = k AND is_current),
wide AS (SELECT rid, {_wide}, max(json_extract_string(record_json, '$.nom_cli')) FILTER (d = 'cliente') AS current_nom_cli,
    max(json_extract_string(record_json, '$.nom_alm')) FILTER (d = 'almacen') AS current_nom_alm,
    bool_or(a IS NULL AND c IS NOT NULL) AS back, count(a) < {len(_DIMS)} AS is_inferred
  FROM code LEFT JOIN hit USING (rid, d) LEFT JOIN now USING (rid, d) GROUP BY rid)
SELECT v.* EXCLUDE (rid), {_sks}, current_nom_cli, current_nom_alm, is_inferred,
  if(back, '{BACKFILL}', if(is_inferred, '{INFERRED}', '{RESOLVED}')) AS resolution_status FROM v JOIN wide USING (rid)""")

_T7_COLS = ["cliente_sk", "articulo_sk", "vendedor_sk", "sucursal_sk", "almacen_sk", "proveedor_sk",
            "cliente_resolution_status", "articulo_resolution_status", "vendedor_resolution_status",
            "sucursal_resolution_status", "almacen_resolution_status", "proveedor_resolution_status"]
T7_SPEC = KEY_SPEC + "registro:ts, " + ", ".join(f"{c}:s" for c in _T7_COLS) + \
    ", is_inferred:b, resolution_status:s, source_nom_cli:s, source_nom_alm:s, neto_dcto:d"


# ---------------------------------------------------------------- queries
H_SPEC = "entity_name:s, source_empresa:s, natural_key:s, snapshot_date:dt, run_id:s, ingested_at:ts, record_hash:s, record_json:s"


@query("T1_master_history", O.out("SELECT * FROM master_history", H_SPEC))
def t1(lk):
    """Six masters' snapshots stacked into one history table with record hash and JSON."""
    return lk.master_history


SCD_SPEC = ("surrogate_key:s, entity_name:s, source_empresa:s, natural_key:s, valid_from:ts, valid_to:ts, is_current:b, "
            "snapshot_date:dt, run_id:s, record_hash:s, record_json:s")


@query("T2_scd2_versions", O.out("SELECT * FROM scd2", SCD_SPEC))
def t2(lk):
    """SCD2 versions (repeats dropped, changes kept, closed by the next version)."""
    return lk.scd2


# T4: one range join per dimension, the plain reading of "valid_from <= t < valid_to"; T5: from the stacked look-ups above
_as_of = "\n".join(f"""LEFT JOIN dim_{e}_scd2 {n} ON {n}.source_empresa = v.source_empresa AND {n}.{k} = v.{k} AND {n}.valid_from <= v.registro
  AND (v.registro < {n}.valid_to OR {n}.valid_to IS NULL)""" for n, e, k in _DIMS)


@query("T4_asof_join", O.out(f"""SELECT {', '.join('v.' + k for k in KEY)}, v.registro, {', '.join(f'{n}.surrogate_key AS {n}_sk_asof' for n, _, _ in _DIMS)}
FROM lines v {_as_of}""", KEY_SPEC + "registro:ts, " + ", ".join(f"{n}_sk_asof:s" for n, _, _ in _DIMS)))
def t4(lk):
    """T4: each sales line gets the version of each of its six masters valid at the sale time (valid_from <= t < valid_to)."""
    return lk.fct_ventas_v2.select(*KEY, "registro", *[f"{n}_sk_asof" for n, _, _ in _DIMS])


_T5_COLS = [c for n, _, _ in _DIMS for c in (f"{n}_sk", f"{n}_resolution_status")]


@query("T5_current_fallback", O.out(f"SELECT {', '.join(KEY + _T5_COLS)}, registro FROM fct_ventas_v2", KEY_SPEC + "registro:ts, " + ", ".join(f"{c}:s" for c in _T5_COLS)))
def t5(lk):
    """T5: as-of version of each master, else the current version, else UNKNOWN."""
    return lk.fct_ventas_v2.select(*KEY, "registro", *_T5_COLS)


@query("T6_resolution_status", O.out(f"""SELECT {', '.join(KEY)}, {', '.join(c for c in _T7_COLS if c.endswith('status'))},
  is_inferred, resolution_status FROM fct_ventas_v2""",
                                     KEY_SPEC + ", ".join(f"{c}:s" for c in _T7_COLS if c.endswith("status")) +
                                     ", is_inferred:b, resolution_status:s"))
def t6(lk):
    """Per-dimension and overall resolution status, is_inferred."""
    return lk.fct_ventas_v2.select(*KEY, *[c for c in _T7_COLS if c.endswith("status")], "is_inferred", "resolution_status")


def _t7(lk):
    x = lk.fct_ventas_v2
    return x.select(*KEY, "registro", *_T7_COLS, "is_inferred", "resolution_status",
                    F.coalesce("nom_cli", "current_nom_cli").alias("source_nom_cli"),
                    F.col("current_nom_alm").alias("source_nom_alm"), "neto_dcto")


@query("T7_fact_scd2", O.out(f"""SELECT {', '.join(KEY)}, registro, {', '.join(_T7_COLS)}, is_inferred, resolution_status,
  COALESCE(nom_cli, current_nom_cli) AS source_nom_cli, current_nom_alm AS source_nom_alm, neto_dcto FROM fct_ventas_v2""", T7_SPEC))
def t7(lk):
    """Sales fact with six dimensions resolved as of the sale time."""
    return _t7(lk)


@query("T8_reconciled_view", O.out(f"""
WITH period(pre, resolution_source) AS (VALUES (TRUE, 'PRODUCTION_LEGACY_HISTORY'), (FALSE, 'SCD2_OPERATIONAL')),
renamed(pre, resolution_status, new_name) AS (VALUES (TRUE, '{BACKFILL}', 'LEGACY_FACT_BACKFILL'))
SELECT {', '.join(KEY)}, registro, resolution_status, COALESCE(new_name, resolution_status) AS reconciliation_status, resolution_source
FROM (SELECT *, registro < TIMESTAMP '{Lake.CUTOVER}' AS pre FROM fct_ventas_v2) JOIN period USING (pre) LEFT JOIN renamed USING (pre, resolution_status)""",
                                   KEY_SPEC + "registro:ts, resolution_status:s, reconciliation_status:s, resolution_source:s"))
def t8(lk):
    """Cutover reconciliation: legacy backfill before the cutover, SCD2 after."""
    r = history.reconcile(lk.fct_ventas_v2, Lake.CUTOVER)
    return r.select(*KEY, "registro", "resolution_status", "reconciliation_status", "resolution_source")


_AP = C.ALL["renglones_aprecios"]
O.view("stg_renglones_aprecios", ["sales_source_lines"], f"""
SELECT *, {O.row_hash({n: ('n' if _AP.col(n).type == 'number' else 's') for n in _AP.names})} AS _row_hash FROM (
  SELECT source_empresa, documento, renglon, cod_art, NULL::DOUBLE AS pre_ant, CAST(round(CAST(CAST(mon_bru AS DECIMAL(18,2)) / NULLIF(CAST(can_art1 AS DECIMAL(18,2)), 0) AS DECIMAL(38,10)), 2) AS DOUBLE) AS pre_nue,
         NULL::DOUBLE AS cos_ult1, '1' AS tip_pre, NULL::VARCHAR AS notas, {O.TS7.format(c='_ingested_at')} AS registro,
         _ingested_at FROM sales_source_lines) z""")
O.view("sil_renglones_aprecios", ["stg_renglones_aprecios"],
       "SELECT *, CAST(registro AS DATE) AS fecha_registro FROM (" +
       O.silver_sql(_AP, "stg_renglones_aprecios", _AP.names, ["source_empresa", "_ingested_at", "_row_hash"], ["_ingested_at"]) + ") q")


@query("T9_price_fact", O.out("""SELECT p.source_empresa, p.documento, p.renglon, p.cod_art, p.pre_nue, p.registro,
  COALESCE(d.surrogate_key, 'UNKNOWN') AS articulo_sk
FROM sil_renglones_aprecios p LEFT JOIN dim_articulos_scd2 d ON p.source_empresa = d.source_empresa AND p.cod_art = d.cod_art
  AND d.is_current""", "source_empresa:s, documento:s, renglon:d, cod_art:s, pre_nue:d, registro:ts, articulo_sk:s"))
def t9(lk):
    """Price changes with the current article surrogate key, one row per document line."""
    p = lk.sil("renglones_aprecios")
    return history.fct_prices(p, lk.dim_scd2("articulos")).select(
        "source_empresa", "documento", "renglon", "cod_art", "pre_nue", "registro", "articulo_sk")


@query("T10_rate_fact", O.out("""SELECT source_empresa, cod_mon, renglon, CAST(registro AS DATE) AS fecha, registro, tasa
FROM sil_renglones_monedas""", "source_empresa:s, cod_mon:s, renglon:d, fecha:dt, registro:ts, tasa:d"))
def t10(lk):
    """Currency rate fact."""
    return history.fct_rates(lk.sil("renglones_monedas"))


@query("T11_inventory_fact", O.out(f"""SELECT source_empresa, snapshot_date, run_id, cod_alm AS codigo_almacen,
  cod_art AS codigo_articulo, exi_act1 AS unidades FROM (
  SELECT source_empresa, snapshot_date, run_id, {cs('cod_alm')} AS cod_alm, {cs('cod_art')} AS cod_art,
         TRY_CAST(exi_act1 AS DECIMAL(28,10)) AS exi_act1, _ingested_at, _row_hash FROM stg_renglones_almacenes) s
WHERE cod_alm <> '' AND cod_art <> '' AND exi_act1 IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY source_empresa, snapshot_date, run_id, cod_alm, cod_art
  ORDER BY _ingested_at DESC NULLS LAST, _row_hash DESC NULLS LAST) = 1""",
                                  "source_empresa:s, snapshot_date:dt, run_id:s, codigo_almacen:s, codigo_articulo:s, unidades:d"))
def t11(lk):
    """Periodic inventory snapshot fact (deduplicated snapshot history)."""
    return history.fct_inventory(silver.snapshot_dedup(lk.stg("renglones_almacenes")))


_S8 = [*KEY, "registro", "fecha_registro", "neto_dcto", "_priority", "_ingested_at", "_row_hash"]


@query("S8_incremental_merge", O.out(f"""
SELECT {', '.join(KEY)}, registro + to_days(if(again AND renglon = 1, 40, 0)) AS registro, fecha_registro + if(again AND renglon = 1, 40, 0) AS fecha_registro,
  neto_dcto + again::INT AS neto_dcto, _priority, if(again, sha256('u' || _row_hash), _row_hash) AS _row_hash
FROM (SELECT *, fecha_registro >= DATE '1999-07-01' AS again FROM sil_ventas) s""",
                                     KEY_SPEC + "registro:ts, fecha_registro:dt, neto_dcto:d, _priority:i, _row_hash:s"))
def s8(lk):
    """An overlapping batch merged into an accumulating table by day: lines from July 1999 on come with a new amount, first
    lines also 40 days later; lines before stay, with their files."""
    s = lk.sil_ventas.select(*_S8)
    late = lambda c: F.when(F.col("renglon") == 1, F.date_add("fecha_registro", 40) if c == "fecha_registro" else F.col(c) + F.expr("INTERVAL 40 DAYS")).otherwise(F.col(c))
    new = s.filter(F.col("fecha_registro") >= F.lit("1999-07-01").cast("date")).withColumns({
        "registro": late("registro"), "fecha_registro": late("fecha_registro"), "neto_dcto": (F.col("neto_dcto") + 1).cast(s.schema["neto_dcto"].dataType),
        "_ingested_at": F.col("_ingested_at") + F.expr("INTERVAL 1 DAY"), "_row_hash": F.sha2(F.concat(F.lit("u"), "_row_hash"), 256)})
    table = DayTable(lk.spark, _scratch(lk.spark, "s8"), "fecha_registro", KEY, ["_ingested_at"])
    table.merge(s.filter(F.col("fecha_registro") < F.lit("2000-01-01").cast("date")), "history")
    table.merge(new, "july")
    return table.read().select(*KEY, "registro", "fecha_registro", "neto_dcto", "_priority", "_row_hash")


# ---------------------------------------------------------------- cutover facts
_E3 = C.SALES["legacy"]
O.view("snapshot_lines", ["stg_ventas_legacy"],
       "SELECT *, CAST(registro AS DATE) AS fecha_registro FROM (SELECT source_empresa, _ingested_at, " +
       ", ".join(O.clean_expr(_E3, n) for n in _E3.names) + " FROM stg_ventas_legacy) s")
_ALM = f"COALESCE(NULLIF({cs('cod_alm')}, ''), cod_suc)"
O.view("fct_pre", ["sil_ventas", "snapshot_lines"], f"""
WITH s AS MATERIALIZED (SELECT * REPLACE ({_ALM} AS cod_alm) FROM sil_ventas WHERE fecha_registro < DATE '{Lake.CUTOVER}'),
snap AS (SELECT *, {_ALM.replace('cod_alm', 'NULL')} AS cod_alm FROM snapshot_lines WHERE fecha_registro < DATE '{Lake.SNAPSHOT_UNTIL}')
SELECT {', '.join(KEY)}, registro, fecha_registro, cod_alm, neto_dcto, 'SILVER' AS origen FROM s
UNION ALL
SELECT {', '.join(KEY)}, registro, fecha_registro, cod_alm, neto_dcto, 'SNAPSHOT' AS origen FROM snap ANTI JOIN s USING ({', '.join(KEY)})""")
O.view("fct_post", ["sil_ventas"], f"""SELECT {', '.join(KEY)}, registro, fecha_registro, cod_alm, neto_dcto FROM sil_ventas
WHERE fecha_registro >= DATE '{Lake.CUTOVER}' AND COALESCE(trim(cod_alm), '') <> ''""")
O.view("fct_gold", ["fct_pre", "fct_post"], """
SELECT *, 'PRE_COD_ALM' AS cod_alm_resolution FROM fct_pre UNION ALL SELECT *, 'SILVER', 'POST_COD_ALM' FROM fct_post""")
_PRE_SPEC = KEY_SPEC + "registro:ts, fecha_registro:dt, cod_alm:s, neto_dcto:d"
_PRE_COLS = [*KEY, "registro", "fecha_registro", "cod_alm", "neto_dcto"]


@query("M9_fct_pre_cutover", O.out("SELECT * FROM fct_pre", _PRE_SPEC + ", origen:s"))
def m9(lk):
    """M9: pre-cutover fact: warehouse falls back to the branch; snapshot fills only keys Silver lacks."""
    return lk.fct_pre.select(*_PRE_COLS, "origen")


@query("M10_fct_post_cutover", O.out("""SELECT * REPLACE (neto_dcto + if(renglon = 1 AND fecha_registro >= DATE '2000-10-01', 1, 0) AS neto_dcto) FROM fct_post""", _PRE_SPEC))
def m10(lk):
    """Post-cutover fact of lines with a real (non-blank) warehouse, in two batches: the second overlaps the first by three
    months and brings new amounts of first lines; only the days it touches are written again."""
    s, late = lk.sil_ventas, F.col("fecha_registro") >= F.lit("2000-10-01").cast("date")
    new = s.filter(late).withColumns({"neto_dcto": F.when(F.col("renglon") == 1, F.col("neto_dcto") + 1).otherwise(F.col("neto_dcto")).cast(s.schema["neto_dcto"].dataType),
                                      "_ingested_at": F.col("_ingested_at") + F.expr("INTERVAL 1 DAY")})
    table = DayTable(lk.spark, _scratch(lk.spark, "m10"), "fecha_registro", KEY, ["_ingested_at"])
    facts.merge_post_cutover(table, s.filter(F.col("fecha_registro") <= F.lit("2000-12-31").cast("date")), lk.CUTOVER, "until 2000")
    facts.merge_post_cutover(table, new, lk.CUTOVER, "from October")
    return table.read().select(*_PRE_COLS)


@query("M11_fct_gold", O.out("SELECT * FROM fct_gold", _PRE_SPEC + ", cod_alm_resolution:s, origen:s"))
def m11(lk):
    """Single sales fact with the origin of its warehouse code."""
    return lk.fct_gold.select(*_PRE_COLS, "cod_alm_resolution", "origen")


@query("U2_union_periods", O.out("SELECT cod_alm_resolution, count(*) AS lineas, round(sum(neto_dcto), 2) AS venta FROM fct_gold GROUP BY ALL",
                                 "cod_alm_resolution:s, lineas:i, venta:d"))
def u2(lk):
    """Tagged union of the pre and post cutover periods, summarized per tag."""
    return lk.fct_gold.groupBy("cod_alm_resolution").agg(F.count("*").alias("lineas"), F.round(F.sum("neto_dcto"), 2).alias("venta"))


_MORE = ["cod_ven", "cod_cli", "cod_art", "cod_pro", "cod_mon", "cod_imp", "can_ven", "monto_bruto", "neto", "dcto", "tasa"]
O.view("gold_lines", ["sil_ventas", "snapshot_lines"], f"""
WITH sil AS MATERIALIZED (SELECT * REPLACE (if(fecha_registro < DATE '{Lake.CUTOVER}', {_ALM}, cod_alm) AS cod_alm) FROM sil_ventas)
SELECT {', '.join(KEY + _MORE)}, registro, fecha_registro, cod_alm, neto_dcto FROM sil
WHERE fecha_registro < DATE '{Lake.CUTOVER}' OR trim(cod_alm) <> ''
UNION ALL SELECT {', '.join(KEY + _MORE)}, registro, fecha_registro, cod_suc, neto_dcto
FROM (SELECT * FROM snapshot_lines WHERE fecha_registro < DATE '{Lake.SNAPSHOT_UNTIL}') ANTI JOIN (SELECT * FROM sil WHERE fecha_registro < DATE '{Lake.CUTOVER}') s
  USING ({', '.join(KEY)})""")


def _of(kind: str, code: str) -> str:
    return f"(SELECT max(n.name) FROM master_names n WHERE n.kind = '{kind}' AND n.source_empresa = g.source_empresa AND n.code = {code})"


def _place(table: str, key: str, name: str) -> str:
    return f"(SELECT max(p.{name}) FROM {table} p WHERE p.source_empresa = g.source_empresa AND p.{key} = g.cli.{key})"


# --- Fixed values: columns of the BI fact ---
_BI_SPEC = """source_empresa:s, tipo_documento:s, cod_suc:s, documento:s, renglon:d, registro:ts, cod_ven:s, nom_ven:s, cod_cli:s, nom_cli:s, rif:s, nom_cla:s, nom_est:s, nom_ciu:s,
 cod_art:s, nom_art:s, cod_alm:s, cod_mar:s, nom_mar:s, cod_dep:s, nom_dep:s, cod_sec:s, modelo:s, cod_pro:s, nom_pro:s, cod_uni1:s, cod_mon:s, cod_imp:s, unidades_vendidas:d,
 monto_bruto:d, neto:d, dcto:d, tasa:d, neto_dcto:d, cajas_vendidas:d, peso_total_kg:d, peso_total_toneladas:d"""


O.view("fct_bi", ["gold_lines", "master_names", "sil_clientes", "sil_articulos", "sil_estados", "sil_ciudades"], f"""
SELECT source_empresa, tipo_documento, cod_suc, documento, renglon, registro, cod_ven, {_of('ven', 'g.cod_ven')} AS nom_ven, cod_cli,
  g.cli.nom_cli AS nom_cli, g.cli.rif AS rif, NULL::VARCHAR AS nom_cla, {_place('sil_estados', 'cod_est', 'nom_est')} AS nom_est,
  {_place('sil_ciudades', 'cod_ciu', 'nom_ciu')} AS nom_ciu, cod_art, g.art.nom_art AS nom_art, cod_alm, g.art.cod_mar AS cod_mar,
  {_of('mar', 'g.art.cod_mar')} AS nom_mar, g.art.cod_dep AS cod_dep, {_of('dep', 'g.art.cod_dep')} AS nom_dep, g.art.cod_sec AS cod_sec,
  g.art.modelo AS modelo, cod_pro, {_of('pro', 'g.cod_pro')} AS nom_pro, g.art.cod_uni1 AS cod_uni1, cod_mon, cod_imp, can_ven AS unidades_vendidas,
  monto_bruto, neto, dcto, tasa, neto_dcto, round(CAST(can_ven / nullif(g.art.cap_bulto, 0) AS DECIMAL(38,10)), 2) AS cajas_vendidas,
  round(can_ven * ifnull(g.art.peso, 0), 2) AS peso_total_kg, round(CAST(can_ven * ifnull(g.art.peso, 0) / 1000 AS DECIMAL(38,10)), 3) AS peso_total_toneladas
FROM (SELECT l.*, (SELECT any_value(c) FROM sil_clientes c WHERE c.source_empresa = l.source_empresa AND c.cod_cli = l.cod_cli) AS cli,
    (SELECT any_value(a) FROM sil_articulos a WHERE a.source_empresa = l.source_empresa AND a.cod_art = l.cod_art) AS art
  FROM gold_lines l WHERE fecha_registro BETWEEN DATE '1999-01-01' AND DATE '{AS_OF}') g""")


@query("M12_fct_bi", O.out("SELECT * FROM fct_bi", _BI_SPEC))
def m12(lk):
    """BI fact window [1999-01-01, as_of] with all master names, boxes, kg and tons."""
    return lk.fct_bi.select(*facts.BI_COLUMNS)


_LINE_COLS = [*KEY, "registro", "fecha_registro", "cod_ven", "nom_ven", "cod_cli", "nom_cli", "nom_cla", "nom_est", "nom_ciu", "cod_art", "cod_alm",
              "cod_mar", "nom_mar", "nom_dep", "cod_sec", "modelo", "cod_pro", "nom_pro", "nom_art", "cod_uni1", "unidades_vendidas", "cajas_vendidas",
              "peso_total_kg", "peso_total_toneladas", "monto_bruto", "cod_mon", "rif", "cod_imp", "neto", "dcto", "tasa", "neto_dcto"]
_NUM = {"renglon", "unidades_vendidas", "cajas_vendidas", "peso_total_kg", "peso_total_toneladas", "monto_bruto", "neto", "dcto", "tasa", "neto_dcto"}


def _spec(cols):
    kind = {"registro": "ts", "fecha_registro": "dt", "anio": "i", "mes": "i", "fecha_key": "i", "trimestre": "i", "semana_del_anio": "i", "quincena": "i"}
    return ", ".join(f"{c}:{kind.get(c, 'd' if c in _NUM else 's')}" for c in cols)


@query("M7_sales_line_measures", O.out(f"SELECT {', '.join(_LINE_COLS)} FROM lines", _spec(_LINE_COLS)))
def m7(lk):
    """M7: sales lines with units, boxes, kg and tons, and names back-filled from the masters."""
    return lk.lines.select(*_LINE_COLS)


_FCT_COLS = [*_LINE_COLS, "nombre_empresa", "razon_social_empresa", *facts.CAL_COLS]


@query("M8_fct_ventas_legacy", O.out(f"SELECT {', '.join(_FCT_COLS)} FROM fct_ventas", _spec(_FCT_COLS)))
def m8(lk):
    """M8: sales fact by an inner join to the calendar, with tenant names and calendar attributes."""
    return facts.fct_sales(lk.lines, lk.dim_empresa, lk.calendar).select(*_FCT_COLS)
