"""Row and column security."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import clean_str

# --- Fixed values -------------------------------------------------------------
UNRESTRICTED_ROLES = ("SUPERADMIN", "ANALISTA_VENTAS")
REDACTED = "***REDACTED***"
SENSITIVE_KEYS = ("password", "token", "secret", "authorization", "api_key", "apikey", "client_secret", "rif", "gps",
                  "correo", "email")
# Columns a shared contract view must never expose.
NOT_EXPOSED = ("rif", "gps", "latitud", "longitud", "documento", "renglon")
# -------------------------------------------------------------------------------


#: Tenants up to which their list is broadcast.
MAX_TENANTS = 100_000
_SCOPE = {"source_empresa": "_e", "cod_suc": "_s", "cod_pro": "_p", "cod_ven": "_v"}


def granted(scopes: DataFrame) -> DataFrame:
    """Active scopes as (correo, tenant, cod_suc, cod_pro, cod_ven), NULL where unrestricted. The columns of an unrestricted role are all NULL."""
    free = F.upper("role_type").isin(*UNRESTRICTED_ROLES)
    s = scopes.filter(F.col("status") == "A")
    return s.select(F.lower(clean_str("correo")).alias("correo"), *[F.when(~free, F.col(c)).alias(a) for c, a in _SCOPE.items()]).distinct()


def _by_pattern(s: DataFrame) -> list[tuple[list[str], DataFrame]]:
    """The scopes split by which of their columns are set: the fact's columns to join on, and the scopes renamed to them. At most sixteen parts."""
    found = s.select(*[F.col(a).isNotNull().alias(a) for a in _SCOPE.values()]).distinct().collect()
    parts = []
    for r in sorted(found):
        names, same = [c for c, a in _SCOPE.items() if r[a]], F.lit(True)
        for a in _SCOPE.values():
            same = same & (F.col(a).isNotNull() if r[a] else F.col(a).isNull())
        parts.append((names, s.where(same).select("correo", *[F.col(_SCOPE[c]).alias(c) for c in names]).distinct()))
    return parts


def _of_known_tenants(fact: DataFrame, tenants: DataFrame) -> DataFrame:
    known = tenants.select("source_empresa").distinct()
    return fact.join(F.broadcast(known) if known.limit(MAX_TENANTS + 1).count() <= MAX_TENANTS else known, "source_empresa", "left_semi")


def row_scope(fact: DataFrame, scopes: DataFrame, principal: str, tenants: DataFrame) -> DataFrame:
    """Fact rows visible to ``principal`` (fail closed: an unknown principal, and a tenant not in ``tenants``, see nothing).

    A NULL scope column means "unrestricted" on that column; an unrestricted role sees every row. Scopes are split by which
    columns they set, and each part meets the fact in one equi join on just those columns: no condition beside the keys, and no row
    twice. Scopes of whole tenants are a list of tenants, which is broadcast.
    """
    mine = granted(scopes).where(F.col("correo") == principal.strip().lower())
    out, seen = _of_known_tenants(fact, tenants), F.lit(False)
    for n, (names, part) in enumerate(_by_pattern(mine)):
        if not names:
            return out.select(*fact.columns)
        side = part.drop("correo").withColumn(f"_in{n}", F.lit(True))
        if names == ["source_empresa"] and side.limit(MAX_TENANTS + 1).count() <= MAX_TENANTS:
            side = F.broadcast(side)
        out, seen = out.join(side, names, "left"), seen | F.coalesce(F.col(f"_in{n}"), F.lit(False))
    return out.where(seen).select(*fact.columns)


def row_scopes(fact: DataFrame, scopes: DataFrame, principals: list[str], tenants: DataFrame, key: list[str]) -> DataFrame:
    """X1 for several principals at once: (correo, row) for each row that a principal sees, once; ``key`` is the fact's unique key."""
    wanted, known = [p.strip().lower() for p in principals], _of_known_tenants(fact, tenants)
    parts = []
    for names, part in _by_pattern(granted(scopes).where(F.col("correo").isin(wanted))):
        if names:
            parts.append(known.join(part, names).select("correo", *fact.columns))
        else:  # they see all: one row a principal is the result itself
            everyone = [F.lit(r.correo) for r in part.collect()]  # of the list given
            parts.append(known.select(F.explode(F.array(*everyone)).alias("correo"), *fact.columns))
    if not parts:
        return fact.limit(0).select(F.lit("").alias("correo"), *fact.columns)
    return reduce(DataFrame.unionByName, parts).dropDuplicates(["correo", *key])


def tenant_view(df: DataFrame, tenant: str, sellers: list[str] | None = None) -> DataFrame:
    """Mandatory tenant filter, optional seller list (pushed down as plain predicates)."""
    if not tenant:
        raise ValueError("tenant is required")
    out = df.filter(F.col("source_empresa") == tenant)
    if sellers:
        out = out.filter(F.col("cod_ven").isin(list(sellers)))
    return out


def expose(df: DataFrame, allowed: list[str] | None = None) -> DataFrame:
    """Minimum exposure: keep only allowed columns, never the sensitive ones."""
    cols = allowed if allowed is not None else df.columns
    return df.select(*[c for c in cols if c in df.columns and c.lower() not in NOT_EXPOSED])


def redact(df: DataFrame, keys=SENSITIVE_KEYS) -> DataFrame:
    """Columns whose name (any case) is sensitive are replaced by a marker; map columns
    get the marker on sensitive keys."""
    low = {k.lower() for k in keys}
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name.lower() in low:
            c = F.when(c.isNotNull(), F.lit(REDACTED)).cast("string")
        elif f.dataType.typeName() == "map":
            c = F.transform_values(c, lambda k, v: F.when(F.lower(k).isin(*low), F.lit(REDACTED)).otherwise(v))
        out.append(c.alias(f.name))
    return df.select(*out)
