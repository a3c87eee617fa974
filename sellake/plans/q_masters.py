"""All masters, transactions and history dimensions, each stacked into one checked result."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import oracle as O
from .queries import query
from .. import contracts as C
from ..operators import dims, silver

# --- Fixed values: code, name, other texts and numbers of each master ---
_MASTERS = {
    "articulos": ("cod_art", "nom_art", "modelo codigo_barras cod_dep cod_sec cod_mar cod_pro cod_uni1 cod_imp status", "peso fraccion cap_bulto gra_lic precio cos_ult1"),
    "impuestos": ("cod_imp", "nom_imp", "status", "por_imp1"), "departamentos": ("cod_dep", "nom_dep", "status", ""), "marcas": ("cod_mar", "nom_mar", "status", ""),
    "secciones": ("cod_sec", "nom_sec", "status", ""), "proveedores": ("cod_pro", "nom_pro", "rif dir_fis status", ""), "paises": ("cod_pai", "nom_pai", "status", ""),
    "estados": ("cod_est", "nom_est", "status", ""), "ciudades": ("cod_ciu", "nom_ciu", "status", ""), "vendedores": ("cod_ven", "nom_ven", "correo status", ""),
    "sucursales": ("cod_suc", "nom_suc", "contacto status", ""), "almacenes": ("cod_alm", "nom_alm", "cod_suc status", ""),
    "clientes": ("cod_cli", "nom_cli", "rif dir_fis dir_exa cod_pai cod_est cod_ciu gps cod_ven segmentacion1 cod_suc tip_con tip_cli status gps_estado", "mon_sal latitud longitud"),
    "clases_clientes": ("cod_cla", "nom_cla", "status", ""), "conceptos": ("cod_con", "nom_con", "status", ""),
}
_TRANSACTIONS = {"renglones_almacenes": ("cod_alm", "cod_art", "exi_act1"), "renglones_monedas": ("cod_mon", "comentario", "renglon tasa"),
                 "renglones_aprecios": ("documento", "cod_art tip_pre notas", "renglon pre_ant pre_nue cos_ult1")}
_HISTORY = {"clientes": ("cod_cli", "nom_cli prioridad estado"), "articulos": ("cod_art", "nom_art cod_mar cod_pro modelo"), "vendedores": ("cod_ven", "nom_ven"),
            "sucursales": ("cod_suc", "nom_suc"), "almacenes": ("cod_alm", "nom_alm"), "proveedores": ("cod_pro", "nom_pro")}
# ------------------------------------------------------------------------


def _cells(texts: str, numbers: str = "", times: str = "") -> str:
    """A list of one struct per column, for the oracle."""
    cells = [f"struct_pack(columna := '{c}', texto := CAST({c} AS VARCHAR), numero := NULL::DOUBLE)" for c in texts.split()]
    cells += [f"struct_pack(columna := '{c}', texto := NULL::VARCHAR, numero := {c}::DOUBLE)" for c in numbers.split()]
    cells += [f"struct_pack(columna := '{c}', texto := strftime({c}, '%Y-%m-%d %H:%M:%S.%f'), numero := NULL::DOUBLE)" for c in times.split()]
    return f"unnest([{', '.join(cells)}], recursive := true)"


def _stack(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _of(lk, entity: str, code: str) -> DataFrame:
    """The contract's columns of a Silver table, with its code named ``codigo``."""
    df = lk.sil(entity)
    more = ["latitud", "longitud", "gps_estado"] if entity == "clientes" else []
    cols = [c for c in [*C.ALL[entity].names, *more] if c in df.columns and c != code and dict(df.dtypes)[c] != "void"]
    return df.select(F.lit(entity).alias("entidad"), "source_empresa", F.col(code).alias("codigo"), *cols)


_CELLS = "columna:s, texto:s, numero:d"


@query("M1_silver_master", O.out("\nUNION ALL ".join(
    f"SELECT '{e}' AS entidad, source_empresa, {code} AS codigo, {_cells(name + ' ' + texts, numbers, "fec_ini" if e == "articulos" else "")} FROM sil_{e}" for e, (code, name, texts, numbers) in _MASTERS.items()),
    "entidad:s, source_empresa:s, codigo:s, " + _CELLS))
def m1(lk):
    """M1: the fifteen current masters (clean, typed, one row per key; customers with GPS columns), a row per key and column."""
    return _stack([silver.unpivot(_of(lk, e, code), ["entidad", "source_empresa", "codigo"]) for e, (code, *_) in _MASTERS.items()])


@query("M2_silver_transaction", O.out("\nUNION ALL ".join(
    f"SELECT '{e}' AS entidad, source_empresa, {key} AS codigo, {_cells(texts, numbers, 'registro')} FROM sil_{e}" for e, (key, texts, numbers) in _TRANSACTIONS.items()),
    "entidad:s, source_empresa:s, codigo:s, " + _CELLS))
def m2(lk):
    """M2: the three current transactions (stock, rates, prices; last row of a key wins), a row per key and column."""
    return _stack([silver.unpivot(_of(lk, e, key).select("entidad", "source_empresa", "codigo", *texts.split(), *numbers.split(), "registro"), ["entidad", "source_empresa", "codigo"])
                   for e, (key, texts, numbers) in _TRANSACTIONS.items()])


@query("M4_dim_passthrough", O.out("\nUNION ALL ".join(
    f"SELECT '{e}' AS dimension, source_empresa, {code} AS codigo, {name} AS nombre, status FROM sil_{e}" for e, (code, name, *_) in _MASTERS.items()),
    "dimension:s, source_empresa:s, codigo:s, nombre:s, status:s"))
def m4(lk):
    """M4: the fifteen conformed dimensions that pass their Silver table on."""
    return _stack([dims.dim_passthrough(lk.sil(e), ["source_empresa", code, name, "status"]).select(
        F.lit(e).alias("dimension"), "source_empresa", F.col(code).alias("codigo"), F.col(name).alias("nombre"), "status") for e, (code, name, *_) in _MASTERS.items()])


_VERSION = ["surrogate_key", "source_empresa", "codigo", "valid_from", "valid_to", "is_current", "run_id", "record_hash"]


@query("T3_scd2_dimension", O.out("\nUNION ALL ".join(
    f"SELECT '{e}' AS dimension, {', '.join(_VERSION).replace('codigo', code + ' AS codigo')}, {_cells(attrs)} FROM dim_{e}_scd2" for e, (code, attrs) in _HISTORY.items()),
    "dimension:s, surrogate_key:s, source_empresa:s, codigo:s, valid_from:ts, valid_to:ts, is_current:b, run_id:s, record_hash:s, " + _CELLS))
def t3(lk):
    """The six typed SCD2 dimensions (JSON parsed once per version), a row per version and attribute."""
    return _stack([silver.unpivot(lk.dim_scd2(e).withColumnRenamed(code, "codigo").withColumn("dimension", F.lit(e)), ["dimension", *_VERSION]) for e, (code, _) in _HISTORY.items()])
