"""Business views G10-G19: one enriched relation of sales, one of stock, and a contract of display names for each view.

``stock_star`` and ``sales_star`` make every name and measure that a view may want; a view then is a projection (P11), so
Catalyst prunes the joins' columns that it does not show. Masters are joined left on (tenant, code), one row per code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import to_ts
from .facts import CAL_COLS, star_enrich, tag_calendar

TENANT = "source_empresa"


def show(df: DataFrame, columns: list[tuple[str, str | None]]) -> DataFrame:
    """(display name, column), a NULL text where the source has no such field (None)."""
    return df.select(*[(F.col(c) if c else F.lit(None).cast("string")).alias(name) for name, c in columns])


def _same(*names: str) -> list[tuple[str, str]]:
    return [(n, n) for n in names]


def _per(units, size, digits: int):
    return F.round(F.try_divide(units, F.nullif(size, F.lit(0))), digits)


def stock_star(stock: DataFrame, masters: dict[str, DataFrame], companies: DataFrame | None = None) -> DataFrame:
    """Stock rows (tenant, cod_alm, cod_art, exi_act1, ...) with the names of warehouse, article, brand, department, section and
    supplier, and units, kilos, tons, and boxes by three sizes: the article's fraction, its bulk, and its capacity (bulk, else fraction, else 1)."""
    article = ["nom_art", "modelo", "codigo_barras", "cod_mar", "cod_dep", "cod_sec", "cod_pro", "cod_uni1", "precio", "peso", "fraccion", "cap_bulto"]
    x = star_enrich(stock, [(masters["almacenes"], [TENANT, "cod_alm"], ["nom_alm"]), (masters["articulos"], [TENANT, "cod_art"], article),
                            (masters["marcas"], [TENANT, "cod_mar"], ["nom_mar"]), (masters["departamentos"], [TENANT, "cod_dep"], ["nom_dep"]),
                            (masters["secciones"], [TENANT, "cod_sec"], ["nom_sec"]), (masters["proveedores"], [TENANT, "cod_pro"], ["nom_pro"])])
    if companies is not None:  # one row a tenant
        x = x.join(F.broadcast(companies.select(TENANT, F.col("nombre_empresa").alias("_company"), "razon_social")), TENANT, "left") \
            .withColumn("company", F.coalesce("_company", TENANT))
    units, weight = F.coalesce("exi_act1", F.lit(0)), F.coalesce("peso", F.lit(0))
    capacity = F.coalesce(F.nullif("cap_bulto", F.lit(0)), F.nullif("fraccion", F.lit(0)), F.lit(1))
    return x.withColumns({
        "units": units, "unit_weight": weight, "unit_fraction": F.coalesce(F.nullif("fraccion", F.lit(0)), F.lit(1)), "capacity": capacity,
        "warehouse": F.coalesce("nom_alm", "cod_alm"), "article": F.coalesce("nom_art", "cod_art"), "supplier": F.coalesce("nom_pro", "cod_pro"),
        "by_fraction": _per(F.col("exi_act1"), F.col("fraccion"), 2), "by_bulk": _per(F.col("exi_act1"), F.col("cap_bulto"), 2),
        "by_capacity": F.round(F.try_divide(F.col("exi_act1"), capacity), 2), "kilos": F.round(units * weight, 2),
        "tons": F.round(F.try_divide(units * weight, F.lit(1000)), 3), "volume": F.round(units * F.coalesce("fraccion", F.lit(0)), 3)})


# --- Fixed values: columns of the stock views, in their order ---
G11_COLUMNS = [("empresa", TENANT), ("nombre_empresa", "company"), ("razon_social", "razon_social"), ("codigo_almacen", "cod_alm"),
               ("nombre_almacen", "warehouse"), ("codigo_articulo", "cod_art"), ("nombre_articulo", "article"), ("modelo", "modelo"),
               ("marca", "cod_mar"), ("proveedor", "cod_pro"), ("fraccion_unitaria", "unit_fraction"), ("unidades_totales", "units"),
               ("cajas_totales", "by_fraction"), ("peso_unitario", "unit_weight"), ("kg_totales", "kilos"), ("toneladas_totales", "tons"),
               ("capacidad_bultos", "capacity"), ("bultos_totales", "by_capacity"), ("stock_unidades", "exi_act1"), ("stock_cajas", "by_fraction"),
               ("peso_total_kg", "kilos"), ("fecha_ultima_actualizacion", "registro")]
G12_COLUMNS = [("empresa", TENANT), ("codigo_sucursal", "cod_alm"), ("nombre_sucursal", "warehouse"), ("codigo_articulo", "cod_art"),
               ("nombre_articulo", "article"), ("modelo", "modelo"), ("marca", "cod_mar"), ("codigo_proveedor", "cod_pro"), ("nombre_proveedor", "supplier"),
               ("fecha", "fecha_registro"), *_same("anio", "mes", "nombre_mes", "anio_mes", "trimestre", "trimestre_nombre", "anio_trimestre", "semana_del_anio", "anio_semana", "quincena_nombre"),
               ("stock_unidades_snapshot", "exi_act1"), ("unidades_por_caja", "cap_bulto"), ("stock_cajas_snapshot", "by_bulk"), ("peso_total_kg_snapshot", "kilos"),
               ("fecha_ultima_actualizacion", "registro")]
G13_COLUMNS = [("Source Empresa", TENANT), ("Fecha Snapshot", "snapshot_date"), ("Run ID", "run_id"), ("Cod Alm", "cod_alm"), ("Nom Alm", "nom_alm"),
               ("Cod Art", "cod_art"), ("Nom Art", "nom_art"), ("Modelo", "modelo"), ("Cod Mar", "cod_mar"), ("Nom Mar", "nom_mar"), ("Cod Dep", "cod_dep"),
               ("Nom Dep", "nom_dep"), ("Cod Pro", "cod_pro"), ("Nom Pro", "nom_pro"), ("Unidad", "cod_uni1"), ("Peso Unitario", "peso"),
               ("Fraccion Unitaria", "fraccion"), ("Uni Bulto", "cap_bulto"), ("Stock", "exi_act1"), ("Fracc Total", "by_fraction"), ("Kilos", "kilos"),
               ("Bultos Tot", "by_capacity"), ("Registro", "registro")]
G14_COLUMNS = [("Procedencia", TENANT), ("Código", "cod_pro"), ("Proveedor", "nom_pro"), ("Categoría", "nom_dep"), ("Marca", "nom_mar"), ("Artículo", "cod_art"),
               ("Descripción", "nom_art"), ("Modelo", "codigo_barras"), ("Observación", "nom_sec"), ("Stock", "units"), ("Precio", "precio"), ("Bulto", "cap_bulto"),
               ("Fracción", "fraccion"), ("Peso", "peso"), ("Fracc Total", "by_fraction"), ("Kilos", "kilos"), ("Bultos Tot", "by_capacity"), ("Cód Alm", "cod_alm"),
               ("Nom Alm", "nom_alm"), ("Source Empresa", TENANT)]
G19_COLUMNS = [("tenant", TENANT), ("nombre_empresa", "company"), ("codigo_almacen", "cod_alm"), ("nombre_almacen", "warehouse"), ("codigo_articulo", "cod_art"),
               ("nombre_articulo", "article"), ("modelo", "modelo"), ("codigo_marca", "cod_mar"), ("nombre_marca", "nom_mar"), ("codigo_proveedor", "cod_pro"),
               ("nombre_departamento", "nom_dep"), ("nombre_seccion", "nom_sec"), ("unidades_por_caja", "cap_bulto"), ("fraccion_unitaria", "fraccion"),
               ("peso_unitario_kg", "peso"), ("stock_unidades", "exi_act1"), ("stock_cajas", "by_bulk"), ("fraccion_total", "volume"), ("peso_total_kg", "kilos"),
               ("peso_total_toneladas", "tons"), ("fecha_ultima_actualizacion", "registro")]
# --- Fixed values: columns of the sales and customer views, in their order ---
G10_COLUMNS = [("empresa", TENANT), ("codigo_sucursal", "cod_suc"), ("nombre_sucursal", "branch"), ("codigo_vendedor", "cod_ven"), ("nombre_vendedor", "nom_ven"),
               ("codigo_cliente", "cod_cli"), ("nombre_cliente", "nom_cli"), ("rif_cliente", "fiscal_id"), ("clase_cliente", "nom_cla"), ("estado_cliente", "nom_est"),
               ("ciudad_cliente", "nom_ciu"), ("tipo_documento", "tipo_documento"), ("numero_documento", "documento"), ("numero_renglon", "renglon"),
               ("timestamp_registro", "registro"), ("fecha", "fecha_registro"),
               *_same("anio", "mes", "nombre_mes", "anio_mes", "trimestre", "trimestre_nombre", "anio_trimestre", "semana_del_anio", "anio_semana", "quincena", "quincena_nombre"),
               ("codigo_proveedor", "cod_pro"), ("nombre_proveedor", "nom_pro"), ("codigo_marca", "cod_mar"), ("nombre_marca", "nom_mar"), ("departamento", "nom_dep"),
               ("seccion", "cod_sec"), ("codigo_articulo", "cod_art"), ("nombre_articulo", "nom_art"), ("modelo", "modelo"), ("unidad_medida", "cod_uni1"),
               *_same("unidades_vendidas", "cajas_vendidas", "peso_total_kg", "peso_total_toneladas", "monto_bruto"), ("monto_descuento", "dcto"),
               ("monto_neto", "neto"), ("tasa_cambio", "tasa"), ("monto_total_usd", "neto_dcto")]
G15_COLUMNS = [("S", "cod_suc"), ("Documento", "documento"), ("Fecha", "day"), ("Código", "cod_cli"), ("Nombre Cliente", "nom_cli"), ("Modelo", "modelo"),
               ("Nom_Mar", "nom_mar"), ("Categoria", "nom_dep"), ("Código Artículo", "cod_art"), ("Nombre Artículo", "nom_art"), ("Peso", "peso"), ("Unidad", "cod_uni1"),
               ("Cantidad", "unidades_vendidas"), ("Kilos", "peso_total_kg"), ("Cod_Mon", "cod_mon"), ("Monto Bruto", "monto_bruto"), ("Uni Bulto", "cap_bulto"),
               ("Bultos", "cajas_vendidas"), ("Frac Uni", "fraccion"), ("Fracc_Tot", "fractions"), ("Cod Vend", "cod_ven"), ("Vendedor", "nom_ven"), ("Nom_Ciu", "nom_ciu"),
               ("Nom_Cla", "nom_cla"), ("Nom_Pro", "nom_pro"), ("Rif", "rif"), ("Cod_Imp", "cod_imp"), ("Neto", "neto"), ("Dcto", "dcto"), ("Tasa", "tasa"),
               ("Neto_Dcto", "neto_dcto"), ("Source Empresa", TENANT), ("Tipo Documento", "tipo_documento")]
G16_COLUMNS = [*_same(TENANT, "tipo_documento", "cod_suc", "documento", "renglon", "registro"), ("fec_ini", "day"),
               *_same("cod_ven", "nom_ven", "cod_cli", "nom_cli", "nom_cla", "nom_est", "nom_ciu", "cod_art", "cod_alm", "cod_mar", "nom_mar", "nom_dep", "cod_sec",
                      "modelo", "cod_pro", "nom_pro", "nom_art", "cod_uni1", "unidades_vendidas", "cajas_vendidas", "peso_total_kg", "peso_total_toneladas",
                      "monto_bruto", "cod_mon", "rif", "cod_imp", "neto", "dcto", "tasa", "neto_dcto")]
G17_COLUMNS = [("Cliente", "cod_cli"), ("Nombre", "nom_cli"), ("RIF", "rif"), ("Telefonos", None), ("Fax", None), ("Zona", None), ("Ciudad", "nom_ciu"),
               ("Contribuyente", "tip_con"), ("Categoría", "tip_cli"), ("Forma Pago", None), ("Contacto", None), ("eMail", None), ("Concepto", None),
               ("Dirección Fiscal", "dir_fis"), ("Dirección Entrega", "dir_exa"), ("Status", "status"), ("Codigo Vendedor", "cod_ven"),
               ("Nombre Vendedor", "nom_ven"), ("Web", None), ("Atributo A", "segmentacion1"), ("Sucursal", "cod_suc"), ("Source Empresa", TENANT)]
#: Keys of the shared sales contract: of the fact, then of the article.
G18_KEYS = [("tenant", TENANT), ("nombre_empresa", "nombre_empresa"), ("codigo_sucursal", "cod_suc"), ("codigo_vendedor", "cod_ven"), ("nombre_vendedor", "nom_ven"),
            ("codigo_cliente", "cod_cli"), ("nombre_cliente", "nom_cli"), ("clase_cliente", "nom_cla"), ("ciudad_cliente", "nom_ciu"), ("fecha", "fecha_registro"),
            *_same("anio", "mes", "nombre_mes", "anio_mes", "trimestre", "anio_trimestre", "semana_del_anio", "anio_semana", "quincena", "quincena_nombre"),
            ("codigo_proveedor", "cod_pro"), ("nombre_proveedor", "nom_pro"), ("codigo_marca", "cod_mar"), ("nombre_marca", "nom_mar"), ("codigo_articulo", "cod_art"),
            ("nombre_articulo", "nom_art"), ("nombre_departamento", "nom_dep"), ("nombre_seccion", "nom_sec"), ("fraccion_unitaria", "fraccion"), ("peso_unitario_kg", "peso")]


def inventory_report(stock: DataFrame, companies: DataFrame, masters: dict[str, DataFrame]) -> DataFrame:
    """Stock above 0 by warehouse, in units, boxes, kilos, tons and bulks."""
    return show(stock_star(stock.where("exi_act1 > 0"), masters, companies), G11_COLUMNS)


def inventory_time(stock: DataFrame, cal: DataFrame, masters: dict[str, DataFrame]) -> DataFrame:
    """Stock by the days of a calendar; rows of other days are those of ``facts.calendar_rejects``."""
    return show(stock_star(tag_calendar(stock, cal).where("reason is null"), masters), G12_COLUMNS)


def inventory_history(snapshots: DataFrame, masters: dict[str, DataFrame]) -> DataFrame:
    """Every stock snapshot with all names and measures."""
    return show(stock_star(snapshots.withColumn("registro", to_ts("registro")), masters), G13_COLUMNS)


def inventory_matrix(stock: DataFrame, masters: dict[str, DataFrame]) -> DataFrame:
    """Stock above 0 with supplier, department, brand, section, price and measures."""
    return show(stock_star(stock.where("exi_act1 > 0"), masters), G14_COLUMNS)


def inventory_shared(stock: DataFrame, companies: DataFrame, masters: dict[str, DataFrame]) -> DataFrame:
    """The shared contract of stock above 0."""
    return show(stock_star(stock.where("exi_act1 > 0"), masters, companies), G19_COLUMNS)


def invoice_detail(fact: DataFrame, branches: DataFrame) -> DataFrame:
    """Every invoice line with branch, customer, calendar, product and amounts."""
    x = star_enrich(fact, [(branches, [TENANT, "cod_suc"], ["nom_suc"])])
    return show(x.withColumns({"branch": F.coalesce("nom_suc", "cod_suc"), "fiscal_id": F.nullif(F.trim("rif"), F.lit(""))}), G10_COLUMNS)


def sales_matrix(bi: DataFrame, articles: DataFrame) -> DataFrame:
    """The BI fact with the article's weight, bulk and fraction, and units in fractions. The city is the customer's, as in the fact."""
    x = star_enrich(bi, [(articles, [TENANT, "cod_art"], ["peso", "cap_bulto", "fraccion"])])
    return show(x.withColumns({"day": F.to_date("registro"), "fractions": F.round(F.col("unidades_vendidas") * F.coalesce("fraccion", F.lit(0)), 2)}), G15_COLUMNS)


def sales_consumer(bi: DataFrame) -> DataFrame:
    """The BI fact as its consumers read it, with the day."""
    return show(bi.withColumn("day", F.to_date("registro")), G16_COLUMNS)


def customers_bi(customers: DataFrame, cities: DataFrame, sellers: DataFrame) -> DataFrame:
    """Customers with city and seller; NULL texts for what the source does not have."""
    return show(star_enrich(customers, [(cities, [TENANT, "cod_ciu"], ["nom_ciu"]), (sellers, [TENANT, "cod_ven"], ["nom_ven"])]), G17_COLUMNS)


def sales_shared(fact: DataFrame, articles: DataFrame, sections: DataFrame, lo: str, hi: str) -> DataFrame:
    """The shared contract of sales, by day and 30 keys, without fiscal id or document.

    Lines are first reduced to one row per document, then to one per key, so documents are counted without an expansion and
    both steps combine before they shuffle; names come last, joined to groups and not to lines.
    """
    own = [(n, c) for n, c in G18_KEYS if c not in ("nom_sec", "fraccion", "peso")]
    sums = {"unidades_vendidas": "unidades_vendidas", "cajas_vendidas": "cajas_vendidas", "peso_total_kg": "peso_total_kg",
            "toneladas_vendidas": "peso_total_toneladas", "venta_bruta": "monto_bruto", "descuentos": "dcto", "venta_neta_usd": "neto_dcto"}
    digits = {"cajas_vendidas": 2, "peso_total_kg": 2, "toneladas_vendidas": 3, "venta_bruta": 2, "descuentos": 2, "venta_neta_usd": 2}
    lines = fact.where(F.col("fecha_registro").between(F.lit(lo).cast("date"), F.lit(hi).cast("date")))
    keys = [c for _, c in own]
    by_code = lines.groupBy(*keys, "cod_sec", "documento").agg(*[F.sum(c).alias(f"_{n}") for n, c in sums.items()])
    named = star_enrich(by_code, [(sections, [TENANT, "cod_sec"], ["nom_sec"])])
    again = lambda df, *by: df.groupBy(*keys, "nom_sec", *by)
    by_document = again(named, "documento").agg(*[F.sum(f"_{n}").alias(f"_{n}") for n in sums])
    groups = again(by_document).agg(F.count("documento").alias("documentos_emitidos"), *[F.sum(f"_{n}").alias(f"_{n}") for n in sums])
    x = star_enrich(groups, [(articles, [TENANT, "cod_art"], ["fraccion", "peso"])])
    measures = {n: F.round(f"_{n}", digits[n]) if n in digits else F.col(f"_{n}") for n in sums}
    volume = F.round(F.col("_unidades_vendidas") * F.coalesce("fraccion", F.lit(0)), 3)
    return x.select(*[F.col(c).alias(n) for n, c in G18_KEYS], "documentos_emitidos", *[m.alias(n) for n, m in measures.items()], volume.alias("fraccion_total"))


assert set(CAL_COLS) >= {c for _, c in G12_COLUMNS if c.startswith(("anio", "trimestre", "semana", "quincena"))}
