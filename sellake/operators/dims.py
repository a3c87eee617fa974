"""Dimensions: M4 conformed pass-through, M5 tenant dimension, M6 calendar,
M13 security scope flattening."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import clean_str

# --- Fixed values: Spanish calendar labels ---------------------------------
MONTH_NAMES = ["Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio", "Julio", "Agosto", "Septiembre",
               "Octubre", "Noviembre", "Diciembre"]
# index = day of week with 1 = Sunday
DAY_NAMES = ["Domingo", "Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado"]
FORTNIGHT_LABELS = ("Q1", "Q2")
FORTNIGHT_SPLIT_DAY = 15
# ---------------------------------------------------------------------------


def dim_passthrough(silver: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """M4: a conformed dimension is the Silver current table (optionally projected)."""
    return silver.select(*cols) if cols else silver.drop("_row_hash", "_ingested_at")


def dim_company(tenants: DataFrame) -> DataFrame:
    """M5: tenant dimension from the tenant list (code, display name, legal name)."""
    return tenants.select(
        "source_empresa",
        F.col("nombre_empresa"),
        F.concat(F.upper(F.col("nombre_empresa")), F.lit(" C.A.")).alias("razon_social"),
    )


def _label(idx: Column, names: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), idx)


def calendar_columns(d: Column) -> list[Column]:
    """Calendar attributes of a DATE column (ISO weeks, fortnights, month flags)."""
    month = F.month(d)
    dow = F.dayofweek(d)  # 1 = Sunday
    iso_year = F.extract(F.lit("YEAROFWEEK"), d)
    iso_week = F.weekofyear(d)
    week_start = F.date_trunc("week", d).cast("date")
    return [
        F.date_format(d, "yyyyMMdd").cast("int").alias("fecha_key"),
        d.alias("fecha"),
        F.year(d).alias("anio"),
        month.alias("mes"),
        _label(month, MONTH_NAMES).alias("nombre_mes"),
        F.substring(_label(month, MONTH_NAMES), 1, 3).alias("nombre_mes_corto"),
        F.dayofmonth(d).alias("dia"),
        F.dayofyear(d).alias("dia_del_anio"),
        F.quarter(d).alias("trimestre"),
        F.concat(F.lit("Q"), F.quarter(d)).alias("trimestre_nombre"),
        F.concat(F.year(d), F.lit("-Q"), F.quarter(d)).alias("anio_trimestre"),
        iso_week.alias("semana_del_anio"),
        F.concat(iso_year, F.lit("-W"), F.lpad(iso_week.cast("string"), 2, "0")).alias("anio_semana"),
        (iso_year * 100 + iso_week).cast("int").alias("anio_semana_num"),
        week_start.alias("inicio_semana"),
        F.date_add(week_start, 6).alias("fin_semana"),
        dow.alias("dia_de_semana"),
        _label(dow, DAY_NAMES).alias("nombre_dia"),
        dow.isin(1, 7).alias("es_fin_de_semana"),
        F.when(F.dayofmonth(d) <= FORTNIGHT_SPLIT_DAY, 1).otherwise(2).alias("quincena"),
        F.when(F.dayofmonth(d) <= FORTNIGHT_SPLIT_DAY, F.lit(FORTNIGHT_LABELS[0]))
         .otherwise(F.lit(FORTNIGHT_LABELS[1])).alias("quincena_nombre"),
        F.date_format(d, "yyyy-MM").alias("anio_mes"),
        F.date_format(d, "yyyyMM").cast("int").alias("anio_mes_num"),
        (F.dayofmonth(d) == 1).alias("es_primer_dia_mes"),
        (d == F.last_day(d)).alias("es_fin_de_mes"),
    ]


#: Names of ``calendar_columns``, in their order.
CALENDAR_NAMES = ["fecha_key", "fecha", "anio", "mes", "nombre_mes", "nombre_mes_corto", "dia", "dia_del_anio", "trimestre", "trimestre_nombre", "anio_trimestre",
                  "semana_del_anio", "anio_semana", "anio_semana_num", "inicio_semana", "fin_semana", "dia_de_semana", "nombre_dia", "es_fin_de_semana", "quincena",
                  "quincena_nombre", "anio_mes", "anio_mes_num", "es_primer_dia_mes", "es_fin_de_mes"]


def calendar_named(d: Column) -> dict[str, Column]:
    """The calendar attributes of a DATE column by name."""
    return dict(zip(CALENDAR_NAMES, calendar_columns(d)))


def calendar(spark: SparkSession, start, end) -> DataFrame:
    """M6: one row per day in [start, end]; bounds are dates, strings or scalar Columns.

    The days are exploded from one row in one task: a calendar is small, and its bounds should be parameters where it is joined.
    """
    s = F.lit(start).cast("date") if isinstance(start, str) else start
    e = F.lit(end).cast("date") if isinstance(end, str) else end
    bounds = spark.range(1).select(s.alias("s"), e.alias("e"))
    days = bounds.select(F.explode(F.sequence(F.col("s"), F.col("e"))).alias("d"))
    return days.select(*calendar_columns(F.col("d")))


def calendar_for(spark: SparkSession, df: DataFrame, ts_col: str) -> DataFrame:
    """Calendar covering whole years around the data's own date span."""
    b = df.select(F.min(ts_col).alias("lo"), F.max(ts_col).alias("hi"))
    lo = b.select(F.trunc(F.col("lo").cast("date"), "year")).scalar()
    hi = b.select(F.date_add(F.add_months(F.trunc(F.col("hi").cast("date"), "year"), 12), -1)).scalar()
    return calendar(spark, lo, hi)


# --- Fixed values: roles and states of a scope ---
SELLER, ANALYST, ADMIN = "VENDEDOR", "ANALISTA_VENTAS", "SUPERADMIN"
ACTIVE, INACTIVE = "A", "I"


def flatten_scopes(users: DataFrame, admin: str | None = None, staff_domains: tuple[str, ...] = ()) -> DataFrame:
    """User documents -> one scope row per (mail, tenant, branch, seller).

    ``users`` has ``source``: documents of "vendedores" are sellers, with one row per assignment (or one for their tenant
    when they have none), active when the user and the assignment are. Documents of "users" give a row only for analysts,
    admins and mails of ``staff_domains``; it has no tenant, so it is global. ``admin`` is one more, unrestricted
    administrator. Documents without a mail are left out.
    """
    mail = F.lower(clean_str("email"))
    u = users.filter(F.coalesce(mail, F.lit("")) != "").select(
        "source", F.col("id").alias("uid"), mail.alias("correo"), F.when(mail.contains("@"), F.element_at(F.split(mail, "@"), -1)).alias("domain"),
        F.lower(clean_str("tenantId")).alias("tenant"), F.coalesce("role", F.lit("")).alias("role"),
        F.when(F.coalesce("isActive", F.lit(True)), F.lit(ACTIVE)).otherwise(F.lit(INACTIVE)).alias("state"), "vendedores")
    null = F.lit(None).cast("string")
    out = ["uid", "correo", "domain", "source_empresa", "cod_suc", "cod_pro", "cod_ven", "role_type", "status"]
    sellers = u.filter("source = 'vendedores'").select("*", F.explode_outer("vendedores").alias("v"))
    sellers = sellers.withColumns({
        "source_empresa": F.when(F.col("v").isNull(), F.col("tenant")).otherwise(F.lower(clean_str(F.coalesce("v.empresa", "v.tenantId")))),
        "cod_suc": clean_str(F.col("v.codSucursal")), "cod_pro": null, "cod_ven": clean_str(F.col("v.codVendedor")), "role_type": F.lit(SELLER),
        "status": F.when((F.col("state") == ACTIVE) & (F.coalesce("v.status", F.lit(ACTIVE)) == ACTIVE), F.lit(ACTIVE)).otherwise(F.lit(INACTIVE))})
    analyst, chief = F.col("role").contains("Analista"), F.col("role").contains("Admin")
    staff = u.filter((F.col("source") == "users") & (analyst | chief | F.col("domain").isin(*staff_domains)))
    staff = staff.withColumns({"source_empresa": null, "cod_suc": null, "cod_pro": null, "cod_ven": null, "status": F.col("state"),
                               "role_type": F.when(~analyst & chief, F.lit(ADMIN)).otherwise(F.lit(ANALYST))})
    rows = sellers.select(*out).unionByName(staff.select(*out))
    if admin:
        one = [F.lit("superadmin"), F.lit(admin), F.lit(admin.rpartition("@")[2]), null, null, null, null, F.lit(ADMIN), F.lit(ACTIVE)]
        rows = rows.unionByName(users.sparkSession.range(1).select(*[c.alias(n) for c, n in zip(one, out)]))
    return rows
