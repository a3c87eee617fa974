"""Facts: P15 signed lines, P16 money, M7 line measures, M8 sales fact,
M9-M12 cutover facts, U2/U3, J1-J3 joins.

Dimension joins are left equi joins on (tenant, code). Dimensions that grow
with the data (customers, articles) are not hinted: AQE turns the join into a
broadcast only when the measured runtime size is under
``spark.sql.adaptive.autoBroadcastJoinThreshold``; otherwise it stays a
sort-merge join with skew splitting. Only bounded sides (calendar, tenants,
branches keyed by a small code list) are broadcast explicitly.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import first_nonblank, money_columns, safe_ratio
from .silver import finished_numbers

TENANT = "source_empresa"
SIGNED = ("can_ven", "monto_bruto", "neto", "neto_dcto")
RETURN_TYPE = "Devolucion"
INVOICE_TYPE = "Factura"


def sign_lines(df: DataFrame, doc_type: str = "tipo_documento", cols=SIGNED) -> DataFrame:
    """Return documents carry negative units and amounts (one pass over both kinds)."""
    sign = F.when(F.col(doc_type) == RETURN_TYPE, F.lit(-1)).otherwise(F.lit(1))
    return df.withColumns({c: F.col(c) * sign.cast(df.schema[c].dataType) for c in cols if c in df.columns})


def signed_lines(invoices: DataFrame, returns: DataFrame, doc_type: str = "tipo_documento") -> DataFrame:
    """P15 over two separate sources: tag each, union, then sign."""
    u = invoices.withColumn(doc_type, F.lit(INVOICE_TYPE)).unionByName(
        returns.withColumn(doc_type, F.lit(RETURN_TYPE)), allowMissingColumns=True)
    return sign_lines(u, doc_type)


def erp_sales_lines(src: DataFrame) -> DataFrame:
    """The ERP sales extraction as a DataFrame: P16 money rule, then P15 sign.

    Input columns: mon_net, mon_imp1, tasa_doc, por_des1, can_art1, mon_bru, fec_reg.
    Output has the v3 sales contract names; numbers land as doubles like the
    warehouse staging types.
    """
    m = money_columns("mon_net", "mon_imp1", "tasa_doc", "por_des1")
    out = src.withColumns({
        "registro": F.date_format("fec_reg", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSS"),
        "can_ven": F.col("can_art1").cast("double"),
        "monto_bruto": F.col("mon_bru").cast("double"),
        **m,
    })
    out = sign_lines(out)
    return out.withColumns({c: F.col(c).cast("double") for c in ("neto", "dcto", "tasa", "neto_dcto")}) \
        .drop("mon_net", "mon_imp1", "tasa_doc", "por_des1", "can_art1", "mon_bru", "fec_reg")


def _lk(dim: DataFrame, code: str, cols: dict[str, str], code_alias: str | None = None) -> DataFrame:
    sel = [F.col(TENANT), F.col(code).alias(code_alias or code)] + [F.col(s).alias(t) for s, t in cols.items()]
    return dim.select(*sel)


def star_enrich(fact: DataFrame, dims: list[tuple[DataFrame, list[str], list[str]]]) -> DataFrame:
    """Chain of LEFT equi joins; each dim is (df, join keys, columns to add).
    A fact column with the same name as an added column is replaced by the dimension's."""
    out = fact
    for dim, keys, cols in dims:
        out = out.drop(*[c for c in cols if c in out.columns]).join(dim.select(*keys, *cols), keys, "left")
    return out


def with_client(sales: DataFrame, clients: DataFrame) -> DataFrame:
    """The line's customer name and fiscal id, else those of the master (P5)."""
    x = sales.join(_lk(clients, "cod_cli", {"nom_cli": "m_nom_cli", "rif": "m_rif"}), [TENANT, "cod_cli"], "left")
    return x.withColumns({c: first_nonblank(c, f"m_{c}") for c in ("nom_cli", "rif")}).drop("m_nom_cli", "m_rif")


def line_measures(sales: DataFrame, articles: DataFrame, clients: DataFrame | None, sellers: DataFrame,
                  suppliers: DataFrame, brands: DataFrame, departments: DataFrame,
                  years: list[int] | None = None) -> DataFrame:
    """M7: sales line + article master -> units, boxes, kg, tons; names back-filled from masters (P5). Customers come first, as they add
    least to the lines that later joins shuffle; ``clients`` is None where the lines went through ``with_client`` before."""
    s = sales if clients is None else with_client(sales, clients)
    if years:
        s = s.filter(F.year("registro").isin(years))
    art = _lk(articles, "cod_art", {"cod_mar": "a_cod_mar", "cod_sec": "a_cod_sec", "modelo": "a_modelo",
                                    "nom_art": "a_nom_art", "cod_uni1": "a_cod_uni1", "cod_dep": "a_cod_dep",
                                    "cap_bulto": "a_cap_bulto", "peso": "a_peso"})
    x = s.join(art, [TENANT, "cod_art"], "left")
    # one column instead of two, before the next shuffles; suppliers grow, code tables (names on every line) come last
    filled = ["cod_sec", "modelo", "nom_art", "cod_uni1"]
    x = x.withColumns({"_cod_mar": first_nonblank("cod_mar", "a_cod_mar"), **{c: first_nonblank(c, f"a_{c}") for c in filled}})
    x = x.drop("a_cod_mar", *[f"a_{c}" for c in filled])
    x = x.join(_lk(suppliers, "cod_pro", {"nom_pro": "m_nom_pro"}), [TENANT, "cod_pro"], "left")
    x = x.join(_lk(sellers, "cod_ven", {"nom_ven": "m_nom_ven"}), [TENANT, "cod_ven"], "left")
    x = x.join(_lk(brands, "cod_mar", {"nom_mar": "m_nom_mar"}, "_cod_mar"), [TENANT, "_cod_mar"], "left")
    x = x.join(_lk(departments, "cod_dep", {"nom_dep": "m_nom_dep"}, "a_cod_dep"), [TENANT, "a_cod_dep"], "left")
    peso = F.coalesce(F.col("a_peso"), F.lit(0))
    return x.select(
        TENANT, "tipo_documento", "cod_suc", "documento", "renglon", "registro", "fecha_registro",
        "cod_ven", first_nonblank("nom_ven", "m_nom_ven").alias("nom_ven"),
        "cod_cli", "nom_cli",
        "nom_cla", "nom_est", "nom_ciu", "cod_art", "cod_alm",
        F.col("_cod_mar").alias("cod_mar"),
        first_nonblank("nom_mar", "m_nom_mar").alias("nom_mar"),
        first_nonblank("nom_dep", "m_nom_dep").alias("nom_dep"),
        "cod_sec", "modelo",
        "cod_pro",
        first_nonblank("nom_pro", "m_nom_pro").alias("nom_pro"),
        "nom_art", "cod_uni1",
        F.col("can_ven").alias("unidades_vendidas"),
        safe_ratio("can_ven", "a_cap_bulto", 2).alias("cajas_vendidas"),
        F.round(F.col("can_ven") * peso, 2).alias("peso_total_kg"),
        F.round(F.try_divide(F.col("can_ven") * peso, F.lit(1000)), 3).alias("peso_total_toneladas"),
        "monto_bruto", "cod_mon", "rif", "cod_imp", "neto", "dcto", "tasa",
        "neto_dcto",
    )


def article_measures(sales: DataFrame, articles: DataFrame) -> DataFrame:
    """M7's part that the article alone gives, for reports that read no more: supplier and brand code, the article's own names, units, boxes
    and tons. Numbers of ``sales`` may still be as landed; they are cleaned after the join."""
    filled = ["cod_pro", "cod_mar", "nom_art", "modelo"]
    x = finished_numbers(sales.join(_lk(articles, "cod_art", {c: f"a_{c}" for c in [*filled, "cap_bulto", "peso"]}), [TENANT, "cod_art"], "left"))
    return x.withColumns({
        **{c: first_nonblank(c, f"a_{c}") for c in filled},
        "unidades_vendidas": F.col("can_ven"),
        "cajas_vendidas": safe_ratio("can_ven", "a_cap_bulto", 2),
        "peso_total_toneladas": F.round(F.try_divide(F.col("can_ven") * F.coalesce(F.col("a_peso"), F.lit(0)), F.lit(1000)), 3),
    }).drop("can_ven", *[f"a_{c}" for c in [*filled, "cap_bulto", "peso"]])


def with_names(lines: DataFrame, sellers: DataFrame, suppliers: DataFrame, brands: DataFrame) -> DataFrame:
    """The line's names of seller, supplier and brand, else those of the masters (P5); the codes are whole already."""
    for master, code, name in ((sellers, "cod_ven", "nom_ven"), (suppliers, "cod_pro", "nom_pro"), (brands, "cod_mar", "nom_mar")):
        lines = lines.join(_lk(master, code, {name: f"m_{name}"}), [TENANT, code], "left").withColumn(name, first_nonblank(name, f"m_{name}")).drop(f"m_{name}")
    return lines


# --- Fixed value: reject reason of a line whose day the calendar lacks ---
NO_DAY = "NO_CALENDAR_DAY"
#: Days (some 500 years) up to which a calendar is broadcast; a longer one is joined by Spark's own choice.
MAX_BROADCAST_DAYS = 200_000


def tag_calendar(fact: DataFrame, cal: DataFrame, date_col: str = "fecha_registro", cols: list[str] | None = None) -> DataFrame:
    """J2 with rejects: every line once, with the calendar's columns and ``reason``: NULL, or NO_DAY where the calendar has no such day
    (the line is dated outside its bounds, or not at all). ``cal`` has one row per day."""
    cols = cols or CAL_COLS
    c = cal.select(F.col("fecha").alias(date_col), *cols, F.lit(True).alias("_day"))
    side = F.broadcast(c) if cal.limit(MAX_BROADCAST_DAYS + 1).count() <= MAX_BROADCAST_DAYS else c
    return fact.join(side, date_col, "left").withColumn("reason", F.when(F.col("_day").isNull(), F.lit(NO_DAY))).drop("_day")


def with_calendar(fact: DataFrame, cal: DataFrame, date_col: str = "fecha_registro", cols: list[str] | None = None) -> DataFrame:
    """INNER join to the calendar on the day; the lines that it leaves out are those of ``calendar_rejects``."""
    return tag_calendar(fact, cal, date_col, cols).where("reason is null").drop("reason")


def calendar_rejects(fact: DataFrame, cal: DataFrame, date_col: str = "fecha_registro") -> DataFrame:
    """The lines of ``fact`` that J2 leaves out, with their reason."""
    return tag_calendar(fact, cal, date_col, []).where("reason is not null")


CAL_COLS = ["fecha_key", "anio", "mes", "nombre_mes", "anio_mes", "trimestre", "trimestre_nombre", "anio_trimestre",
            "semana_del_anio", "anio_semana", "quincena", "quincena_nombre"]


def fct_sales(lines: DataFrame, companies: DataFrame, cal: DataFrame | None = None) -> DataFrame:
    """M8: line fact + tenant names + calendar attributes (inner on the day).

    With ``cal=None`` the attributes are derived in-line from the day: the same
    result as an inner join to a calendar that covers every day (lines without a
    day are dropped), without a join or a pass to find the date span.
    """
    from .dims import calendar_named

    emp = companies.select(TENANT, F.col("nombre_empresa").alias("_nombre_empresa"),
                           F.col("razon_social").alias("razon_social_empresa"))
    x = lines.join(F.broadcast(emp), TENANT, "left")
    x = x.withColumn("nombre_empresa", F.coalesce("_nombre_empresa", TENANT)).drop("_nombre_empresa")
    if cal is not None:
        return with_calendar(x, cal, cols=CAL_COLS)
    named = calendar_named(F.col("fecha_registro"))
    return x.filter(F.col("fecha_registro").isNotNull()).select("*", *[named[c] for c in CAL_COLS])


def union_tagged(parts: list[tuple[DataFrame, str]], col: str) -> DataFrame:
    """UNION ALL of period parts, each tagged in ``col``."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                  [df.withColumn(col, F.lit(tag)) for df, tag in parts])


def distinct_of(df: DataFrame, cols: list[str]) -> DataFrame:
    """SELECT DISTINCT of the given columns."""
    return df.select(*cols).dropDuplicates()


SALES_KEY = [TENANT, "tipo_documento", "cod_suc", "documento", "renglon"]


def fct_pre_cutover(sales: DataFrame, snapshot: DataFrame, cutover: str, snapshot_until: str,
                    key: list[str] = SALES_KEY) -> DataFrame:
    """M9: lines before the cutover; the warehouse falls back to the branch code.
    Silver wins; the older snapshot only fills keys Silver lacks (left anti)."""
    def alm(df):
        return first_nonblank("cod_alm", "cod_suc") if "cod_alm" in df.columns else F.col("cod_suc")

    s = sales.filter(F.col("fecha_registro") < F.lit(cutover).cast("date"))
    s = s.withColumn("cod_alm", alm(s))
    snap = snapshot.filter(F.col("fecha_registro") < F.lit(snapshot_until).cast("date"))
    snap = snap.withColumn("cod_alm", alm(snap))
    fill = snap.join(s.select(*key), key, "left_anti")
    return union_tagged([(s, "SILVER"), (fill, "SNAPSHOT")], "origen")


def fct_post_cutover(sales: DataFrame, cutover: str, old: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Lines from the cutover with a non-blank warehouse, merged into ``old`` by key.
    Returns (fact, quality row with the number of lines dropped for a blank warehouse)."""
    from .history import merge_by_key

    post = sales.filter(F.col("fecha_registro") >= F.lit(cutover).cast("date"))
    blank = F.coalesce(F.trim(F.col("cod_alm")), F.lit("")) == ""
    kept = post.filter(~blank)
    dropped = post.agg(F.count_if(blank).alias("lineas_sin_almacen")).withColumn("check_name", F.lit("cod_alm_blank"))
    fact = merge_by_key(old, kept, SALES_KEY, ["_ingested_at"]) if old is not None else kept
    return fact, dropped


def merge_post_cutover(table, sales: DataFrame, cutover: str, batch_id: str) -> set[str]:
    """M10 on storage: a batch of lines from the cutover with a non-blank warehouse, merged into the days of ``table`` (a ``DayTable``)."""
    return table.merge(fct_post_cutover(sales, cutover)[0], batch_id)


# --- Fixed values: periods of the warehouse code ---
PRE_TAG, POST_TAG = "PRE_COD_ALM", "POST_COD_ALM"


def fct_gold(pre: DataFrame, post: DataFrame) -> DataFrame:
    """Single fact; ``cod_alm_resolution`` tells the period of the warehouse code, ``origen`` where the line came from."""
    return pre.withColumn("cod_alm_resolution", F.lit(PRE_TAG)).unionByName(
        post.withColumns({"origen": F.lit("SILVER"), "cod_alm_resolution": F.lit(POST_TAG)}), allowMissingColumns=True)


def fct_bi(gold: DataFrame, start: str, as_of: str, masters: dict[str, DataFrame], article_supplier: Column | None = None) -> DataFrame:
    """BI fact: lines in [start, as_of] (P12) with customer, state, city, seller, article, brand, department and
    supplier names of the masters (J1), and boxes, kg and tons from the article. ``masters``: entity -> Silver table.
    ``article_supplier`` marks lines whose supplier code, where blank, is still to be taken from the article (M3's last step), in the
    same join as the article's names."""
    x = gold.filter(F.col("fecha_registro").between(F.lit(start).cast("date"), F.lit(as_of).cast("date")))
    from_article = ["nom_art", "cod_mar", "cod_dep", "cod_sec", "modelo", "cod_uni1", "cap_bulto", "peso"]
    articles = masters["articulos"].withColumnRenamed("cod_pro", "_art_cod_pro")
    x = star_enrich(x, [(masters["clientes"], [TENANT, "cod_cli"], ["nom_cli", "rif", "cod_est", "cod_ciu"]),
                        (articles, [TENANT, "cod_art"], from_article if article_supplier is None else [*from_article, "_art_cod_pro"])])
    if article_supplier is not None:
        x = x.withColumn("cod_pro", F.when(article_supplier, first_nonblank("cod_pro", "_art_cod_pro")).otherwise(F.col("cod_pro"))).drop("_art_cod_pro")
    x = star_enrich(x, [(masters["vendedores"], [TENANT, "cod_ven"], ["nom_ven"]), (masters["proveedores"], [TENANT, "cod_pro"], ["nom_pro"]),
                        (masters["estados"], [TENANT, "cod_est"], ["nom_est"]), (masters["ciudades"], [TENANT, "cod_ciu"], ["nom_ciu"]),
                        (masters["marcas"], [TENANT, "cod_mar"], ["nom_mar"]), (masters["departamentos"], [TENANT, "cod_dep"], ["nom_dep"])])
    weight = F.col("can_ven") * F.coalesce("peso", F.lit(0))
    measures = {"unidades_vendidas": F.col("can_ven"), "cajas_vendidas": safe_ratio("can_ven", "cap_bulto", 2),
                "peso_total_kg": F.round(weight, 2), "peso_total_toneladas": F.round(F.try_divide(weight, F.lit(1000)), 3),
                "nom_cla": F.lit(None).cast("string")}
    return x.withColumns(measures).select(*BI_COLUMNS)


# --- Fixed values: columns of the BI fact ---
BI_COLUMNS = [TENANT, "tipo_documento", "cod_suc", "documento", "renglon", "registro", "cod_ven", "nom_ven", "cod_cli", "nom_cli", "rif",
              "nom_cla", "nom_est", "nom_ciu", "cod_art", "nom_art", "cod_alm", "cod_mar", "nom_mar", "cod_dep", "nom_dep", "cod_sec",
              "modelo", "cod_pro", "nom_pro", "cod_uni1", "cod_mon", "cod_imp", "unidades_vendidas", "monto_bruto", "neto", "dcto",
              "tasa", "neto_dcto", "cajas_vendidas", "peso_total_kg", "peso_total_toneladas"]


def header_line(lines: DataFrame, headers: DataFrame, key: str, statuses: list[str], status_col: str = "status",
                masters: list[tuple[DataFrame, list[str]]] = ()) -> DataFrame:
    """Header ⋈ line with a status filter, then inner joins to masters (orphans dropped)."""
    h = headers.filter(F.col(status_col).isin(statuses))
    out = lines.join(h, key, "inner")
    for m, keys in masters:
        out = out.join(m.select(*keys).dropDuplicates(), keys, "inner")
    return out
