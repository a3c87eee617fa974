"""Entity contracts: the declared, fixed schema of every ERP entity.

A contract is plain driver-side metadata (a few dozen columns); it only
drives plan building (which expressions to put in a ``select``), never data.
Schemas are never inferred from data.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import types as T

# Declared column types of a contract and their staging (landing) Spark type.
# Staging keeps numbers as double (FLOAT64 in the source warehouse) and
# timestamps as text; Silver converts them.
STAGING_TYPES = {
    "string": T.StringType(),
    "number": T.DoubleType(),
    "integer": T.LongType(),
    "boolean": T.BooleanType(),
    "timestamp": T.StringType(),
}

SILVER_DECIMAL = T.DecimalType(28, 10)

# System columns added at landing (fixed values: names of the lineage columns).
AUDIT_COLUMNS = [
    "_ingested_at",
    "source_empresa",
    "_query_id",
    "_query_version",
    "_query_sql_hash",
    "_run_id",
    "_lote_id",
    "_payload_hash",
    "_row_hash",
]


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    type: str = "string"  # string | number | integer | boolean | timestamp
    required: bool = False
    default: str | None = None  # silver default when null / blank after trim
    domain: tuple[str, ...] | None = None
    min: float | None = None


@dataclass(frozen=True)
class Entity:
    name: str
    natural_key: tuple[str, ...]  # without the tenant column
    columns: tuple[ColumnSpec, ...]
    reject_empty: bool = True
    load_strategy: str = "full_snapshot"
    tenant_col: str = "source_empresa"
    extra: dict = field(default_factory=dict, compare=False)

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def required(self) -> list[str]:
        return [c.name for c in self.columns if c.required]

    @property
    def key(self) -> list[str]:
        return [self.tenant_col, *self.natural_key]

    def col(self, name: str) -> ColumnSpec:
        for c in self.columns:
            if c.name == name:
                return c
        raise KeyError(name)

    def staging_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, STAGING_TYPES[c.type], True) for c in self.columns])


def contract_from_json(doc: str | dict) -> Entity:
    """Contract document (JSON) -> Entity. Unknown keys are ignored."""
    d = json.loads(doc) if isinstance(doc, str) else doc
    cols = []
    for c in d["columns"]:
        typ = c.get("type", "string")
        if c.get("silver_type") == "timestamp":
            typ = "timestamp"
        cols.append(
            ColumnSpec(
                name=c["name"],
                type=typ,
                required=bool(c.get("required", False)),
                default=c.get("silver_default"),
                domain=tuple(c["domain"]) if c.get("domain") else None,
                min=c.get("min"),
            )
        )
    key = tuple(k for k in d.get("natural_key", []) if k != "source_empresa")
    return Entity(
        name=d["entity"],
        natural_key=key,
        columns=tuple(cols),
        reject_empty=bool(d.get("reject_empty", True)),
        load_strategy=d.get("load_strategy", "full_snapshot"),
    )


def contract_to_schema(entity: Entity, with_audit: bool = True) -> T.StructType:
    """Declared staging schema, optionally with the landing audit columns."""
    fields = list(entity.staging_schema().fields)
    if with_audit:
        for a in AUDIT_COLUMNS:
            typ = T.TimestampType() if a == "_ingested_at" else T.StringType()
            fields.append(T.StructField(a, typ, True))
    return T.StructType(fields)


def _s(name, **kw):
    return ColumnSpec(name, "string", **kw)


def _n(name, **kw):
    return ColumnSpec(name, "number", **kw)


def _t(name, **kw):
    return ColumnSpec(name, "timestamp", **kw)


def _simple_master(entity: str, code: str, name: str, extra=()) -> Entity:
    return Entity(
        entity,
        (code,),
        (_s(code, required=True), _s(name, required=True), *extra, _s("status", required=True, domain=("A", "I"))),
    )


# --- Fixed values: the entity contracts of the source ERP (columns, keys,
# --- required flags, defaults, domains, minimums) -------------------------
ARTICULOS = Entity(
    "articulos",
    ("cod_art",),
    (
        _s("cod_art", required=True),
        _s("modelo"),
        _s("codigo_barras"),
        _s("nom_art", required=True),
        _s("cod_dep"),
        _s("cod_sec"),
        _s("cod_mar"),
        _s("cod_pro"),
        _s("cod_uni1", required=True, default="UNI"),
        _n("peso", min=0),
        _n("fraccion", min=0),
        _n("cap_bulto", min=0),
        _n("gra_lic", min=0),
        _n("precio", min=0),
        _n("cos_ult1", min=0),
        _s("cod_imp"),
        _s("status", required=True, domain=("A", "I")),
        _t("fec_ini"),
    ),
)

CLIENTES = Entity(
    "clientes",
    ("cod_cli",),
    (
        _s("cod_cli", required=True),
        _s("nom_cli", required=True),
        _s("rif"),
        _s("dir_fis"),
        _s("dir_exa"),
        _s("cod_pai"),
        _s("cod_est"),
        _s("cod_ciu"),
        _s("nom_mun"),
        _s("nom_par"),
        _s("gps"),
        _s("cod_ven"),
        _s("segmentacion1"),
        _s("segmentacion2"),
        _n("mon_sal"),
        _s("cod_suc"),
        _s("tip_con"),
        _s("crm_pos"),
        _s("tip_cli"),
        _s("abc"),
        _s("status", required=True, domain=("A", "I")),
    ),
)

VENDEDORES = _simple_master("vendedores", "cod_ven", "nom_ven", (_s("correo"), _s("cod_pai"), _s("cod_ciu"), _s("cod_suc")))
PROVEEDORES = _simple_master("proveedores", "cod_pro", "nom_pro", (_s("rif"), _s("dir_fis")))
SUCURSALES = _simple_master("sucursales", "cod_suc", "nom_suc", (_s("contacto"),))
ALMACENES = _simple_master("almacenes", "cod_alm", "nom_alm", (_s("cod_suc"),))
IMPUESTOS = _simple_master("impuestos", "cod_imp", "nom_imp", (_n("por_imp1", min=0),))
MARCAS = _simple_master("marcas", "cod_mar", "nom_mar")
DEPARTAMENTOS = _simple_master("departamentos", "cod_dep", "nom_dep")
SECCIONES = _simple_master("secciones", "cod_sec", "nom_sec")
PAISES = _simple_master("paises", "cod_pai", "nom_pai")
ESTADOS = _simple_master("estados", "cod_est", "nom_est")
CIUDADES = _simple_master("ciudades", "cod_ciu", "nom_ciu")
CLASES_CLIENTES = _simple_master("clases_clientes", "cod_cla", "nom_cla")
CONCEPTOS = _simple_master("conceptos", "cod_con", "nom_con")

RENGLONES_ALMACENES = Entity(
    "renglones_almacenes",
    ("cod_alm", "cod_art"),
    (_s("cod_alm", required=True), _s("cod_art", required=True), _n("exi_act1", required=True), _t("registro")),
    load_strategy="full_snapshot",
)
RENGLONES_MONEDAS = Entity(
    "renglones_monedas",
    ("cod_mon", "renglon", "registro"),
    (_s("cod_mon", required=True), _n("renglon", required=True), _t("fecha"), _n("tasa", min=0), _s("comentario"), _t("registro")),
    load_strategy="incremental_by_date",
)
RENGLONES_APRECIOS = Entity(
    "renglones_aprecios",
    ("documento", "renglon"),
    (
        _s("documento", required=True),
        _n("renglon", required=True),
        _s("cod_art"),
        _n("pre_ant"),
        _n("pre_nue"),
        _n("cos_ult1"),
        _s("tip_pre"),
        _s("notas"),
        _t("registro"),
    ),
    load_strategy="incremental_by_date",
)

_SALES_KEY = (_s("tipo_documento", required=True), _s("cod_suc", required=True), _s("documento", required=True), _n("renglon", required=True))
VENTAS_LEGACY = Entity(
    "ventas_diarias",
    ("tipo_documento", "cod_suc", "documento", "renglon"),
    (
        *_SALES_KEY,
        _t("registro"),
        _s("cod_ven"), _s("nom_ven"), _s("cod_cli"), _s("nom_cli"), _s("nom_cla"), _s("nom_est"), _s("nom_ciu"),
        _s("cod_art"), _s("cod_mar"), _s("nom_mar"), _s("nom_dep"), _s("cod_sec"), _s("modelo"), _s("cod_pro"),
        _s("nom_pro"), _s("nom_art"), _s("cod_uni1"),
        _n("can_ven"), _n("monto_bruto"), _s("cod_mon"), _s("rif"), _s("cod_imp"),
        _n("neto"), _n("dcto"), _n("tasa"), _n("neto_dcto"),
    ),
    load_strategy="incremental_by_date",
)
VENTAS_V2 = Entity(
    "ventas_diarias_v2",
    VENTAS_LEGACY.natural_key,
    (*VENTAS_LEGACY.columns, _s("cod_alm"), _n("por_imp1")),
    load_strategy="incremental_by_date",
)
VENTAS_V3 = Entity(
    "ventas_diarias_v3",
    VENTAS_LEGACY.natural_key,
    (
        *_SALES_KEY,
        _t("registro"),
        _s("cod_ven"), _s("cod_cli"), _s("cod_art"), _s("cod_alm"),
        _n("can_ven"), _n("monto_bruto"), _s("cod_mon"), _s("cod_imp"), _n("por_imp1"),
        _n("neto"), _n("dcto"), _n("tasa"), _n("neto_dcto"),
    ),
    load_strategy="incremental_by_date",
)
# --- end of fixed values ---------------------------------------------------

MASTERS = {
    e.name: e
    for e in (
        ARTICULOS, IMPUESTOS, DEPARTAMENTOS, MARCAS, SECCIONES, PROVEEDORES, PAISES, ESTADOS, CIUDADES,
        VENDEDORES, SUCURSALES, ALMACENES, CLIENTES, CLASES_CLIENTES, CONCEPTOS,
    )
}
TRANSACTIONS = {e.name: e for e in (RENGLONES_ALMACENES, RENGLONES_MONEDAS, RENGLONES_APRECIOS)}
SALES = {"v3": VENTAS_V3, "v2": VENTAS_V2, "legacy": VENTAS_LEGACY}
ALL = {**MASTERS, **TRANSACTIONS, **{e.name: e for e in SALES.values()}}

# Contract priority of the sales versions (higher wins in Silver dedup).
SALES_PRIORITY = {"v3": 3, "v2": 2, "legacy": 1}
