"""Analytic views over the sales and stock facts.

Every view takes ``as_of`` explicitly (no "today" inside a query). Distinct
counts are exact. Where a view needs several distinct counts, the fact is first
reduced to one row per group and member (or to bitmaps of members), so each
count is a plain sum and no row is expanded once per count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TENANT = "source_empresa"


def _d(s: str) -> Column:
    return F.lit(s).cast("date")


def period_summary(fact: DataFrame, companies: DataFrame, lo: str | None = None, hi: str | None = None,
                   by: tuple[str, ...] = ()) -> DataFrame:
    """Lines, invoices, customers, sellers, boxes, tons and amount per tenant (and period columns)."""
    f = fact
    if lo is not None:
        f = f.filter(F.col("fecha_registro") >= _d(lo))
    if hi is not None:
        f = f.filter(F.col("fecha_registro") <= _d(hi))
    # the sums and each kind of member are reduced by themselves, a member to one row before it is counted, so rows are shuffled narrow
    sums = {"total_renglones": None, "cajas_vendidas": "cajas_vendidas", "toneladas_vendidas": "peso_total_toneladas", "venta_usd": "neto_dcto"}
    kinds = {"total_facturas": "documento", "clientes_compradores": "cod_cli", "vendedores_activos": "cod_ven"}
    stacked = f.groupBy(TENANT, *by).agg(*[(F.count("*") if c is None else F.sum(c)).alias(n) for n, c in sums.items()])
    for n, c in kinds.items():
        part = f.select(TENANT, *by, c).dropDuplicates().groupBy(TENANT, *by).agg(F.count(c).alias(n))
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    g = stacked.groupBy(TENANT, *by).agg(*[F.sum(n).alias(n) for n in ("total_renglones", *kinds)], *[F.round(F.sum(n), 2).alias(n) for n in sums if n != "total_renglones"])
    emp = companies.select(TENANT, "nombre_empresa", F.col("razon_social").alias("razon_social_empresa"))
    g = g.join(F.broadcast(emp.withColumnRenamed("nombre_empresa", "_n")), TENANT, "left")
    return g.withColumn("nombre_empresa", F.coalesce("_n", TENANT)).drop("_n")


def _window(fact: DataFrame, as_of: str, days: int) -> DataFrame:
    """Lines of the ``days`` days up to ``as_of`` (inclusive)."""
    return fact.filter(F.col("fecha_registro").between(F.date_sub(_d(as_of), days), _d(as_of)))


def _month_start(as_of: str) -> Column:
    return F.trunc(_d(as_of), "month")


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Equi join where NULL keys match NULL keys (group columns may be NULL)."""
    r = right.select(*[F.col(k).alias("_r_" + k) for k in keys], *[c for c in right.columns if c not in keys])
    cond = [left[k].eqNullSafe(r["_r_" + k]) for k in keys]
    return left.join(r, cond, how).drop(*["_r_" + k for k in keys])


def with_branch_name(fact: DataFrame, branches: DataFrame) -> DataFrame:
    b = branches.select(TENANT, "cod_suc", F.col("nom_suc").alias("_nom_suc"))
    return fact.join(b, [TENANT, "cod_suc"], "left").withColumn(
        "nombre_sucursal", F.coalesce("_nom_suc", "cod_suc")).drop("_nom_suc")


def _named_branch(g: DataFrame, branches: DataFrame) -> DataFrame:
    """The branch's name beside its code in a result: joined to groups, not to lines."""
    b = branches.select(F.col(TENANT).alias("empresa"), F.col("cod_suc").alias("codigo_sucursal"), F.col("nom_suc").alias("_nom_suc"))
    return g.join(b, ["empresa", "codigo_sucursal"], "left").withColumn("nombre_sucursal", F.coalesce("_nom_suc", "codigo_sucursal")).drop("_nom_suc")


def _group_90d() -> list:
    return [F.col(TENANT).alias("empresa"), F.col("cod_suc").alias("codigo_sucursal"), "nombre_sucursal",
             F.col("cod_ven").alias("codigo_vendedor"), F.col("nom_ven").alias("nombre_vendedor"),
             F.col("cod_pro").alias("codigo_proveedor"), F.col("nom_pro").alias("nombre_proveedor"),
             F.col("cod_mar").alias("codigo_marca"), F.col("nom_mar").alias("nombre_marca")]


GROUP_90D_NAMES = ["empresa", "codigo_sucursal", "nombre_sucursal", "codigo_vendedor", "nombre_vendedor",
                   "codigo_proveedor", "nombre_proveedor", "codigo_marca", "nombre_marca"]


def _two_step_activation(f: DataFrame, member: str, as_of: str) -> DataFrame:
    """Exact distinct counts without expanding rows: reduce to one row per (group, member)
    with month flags and partial sums, then count/sum per group (two aggregations)."""
    in_month = F.col("fecha_registro") >= _month_start(as_of)
    per = f.groupBy(*GROUP_90D_NAMES, member).agg(
        F.max(in_month.cast("int")).alias("_m"),
        F.sum(F.when(in_month, F.col("cajas_vendidas")).otherwise(F.lit(0))).alias("_cm"),
        F.sum(F.when(in_month, F.col("neto_dcto")).otherwise(F.lit(0))).alias("_vm"),
        F.sum("cajas_vendidas").alias("_c"),
        F.sum("neto_dcto").alias("_v"),
        F.max("fecha_registro").alias("_f"),
    )
    return per


def activable_90d(fact: DataFrame, branches: DataFrame, as_of: str) -> DataFrame:
    """G1: per branch/seller/supplier/brand: distinct customers in 90 days, activated this month,
    pending, activation %, boxes and amount (month and 90 days), last sale."""
    f = with_branch_name(_window(fact, as_of, 90), branches).select(*_group_90d(), "cod_cli", "fecha_registro",
                                                                     "cajas_vendidas", "neto_dcto")
    per = _two_step_activation(f, "cod_cli", as_of)
    g = per.groupBy(*GROUP_90D_NAMES).agg(
        F.count("cod_cli").alias("base_activable_clientes_90d"),
        F.sum("_m").alias("clientes_activados_mes_actual"),
        F.round(F.sum("_cm"), 2).alias("cajas_vendidas_mes_actual"),
        F.round(F.sum("_vm"), 2).alias("venta_usd_mes_actual"),
        F.round(F.sum("_c"), 2).alias("total_cajas_90d"),
        F.round(F.sum("_v"), 2).alias("monto_total_venta_usd_90d"),
        F.max("_f").alias("fecha_ultima_venta"),
    )
    return g.withColumns({
        "clientes_pendientes_activacion_mes": F.col("base_activable_clientes_90d") - F.col("clientes_activados_mes_actual"),
        "pct_activacion_mes_actual": F.round(F.try_divide(F.col("clientes_activados_mes_actual"),
                                                          F.nullif(F.col("base_activable_clientes_90d"), F.lit(0))) * 100, 2),
    })


def activable_rif_90d(fact: DataFrame, branches: DataFrame, as_of: str) -> DataFrame:
    """Like G1 by fiscal id (blank ids dropped), plus the number of points of sale (customer codes)."""
    rif = F.nullif(F.trim(F.col("rif")), F.lit(""))
    f = _window(fact, as_of, 90).withColumn("_rif", rif).filter(F.col("_rif").isNotNull())
    f = with_branch_name(f, branches).select(*_group_90d(), "_rif", "cod_cli", "fecha_registro", "cajas_vendidas", "neto_dcto")
    per = _two_step_activation(f, "_rif", as_of)
    g = per.groupBy(*GROUP_90D_NAMES).agg(
        F.count("_rif").alias("base_activable_rifs_90d"),
        F.sum("_m").alias("rifs_activados_mes_actual"),
        F.round(F.sum("_cm"), 2).alias("cajas_vendidas_mes_actual"),
        F.round(F.sum("_vm"), 2).alias("venta_usd_mes_actual"),
        F.round(F.sum("_c"), 2).alias("total_cajas_90d"),
        F.round(F.sum("_v"), 2).alias("monto_total_venta_usd_90d"),
        F.max("_f").alias("fecha_ultima_venta"),
    )
    pos = f.groupBy(*GROUP_90D_NAMES).agg(F.count_distinct("cod_cli").alias("total_puntos_de_venta_cod_cli"))
    g = join_null_safe(g, pos, GROUP_90D_NAMES)
    return g.withColumns({
        "rifs_pendientes_activacion_mes": F.col("base_activable_rifs_90d") - F.col("rifs_activados_mes_actual"),
        "pct_activacion_rif_mes_actual": F.round(F.try_divide(F.col("rifs_activados_mes_actual"),
                                                              F.nullif(F.col("base_activable_rifs_90d"), F.lit(0))) * 100, 2),
    })


def activable_volume(fact: DataFrame, as_of: str) -> DataFrame:
    """90-day base per tenant, branch, seller, supplier and brand (codes and names) with distinct customers, SKUs and
    documents, units, boxes, tons, amount and last sale."""
    names = {TENANT: "empresa", "cod_suc": "codigo_sucursal", "cod_ven": "codigo_vendedor", "nom_ven": "nombre_vendedor", "cod_pro": "codigo_proveedor",
             "nom_pro": "nombre_proveedor", "cod_mar": "codigo_marca", "nom_mar": "nombre_marca"}
    keys = list(names.values())
    f = _window(fact, as_of, 90).withColumnsRenamed(names)
    sums = f.groupBy(*keys).agg(F.sum("unidades_vendidas").alias("total_unidades"), F.round(F.sum("cajas_vendidas"), 2).alias("total_cajas"),
                                F.round(F.sum("peso_total_toneladas"), 3).alias("total_toneladas"), F.round(F.sum("neto_dcto"), 2).alias("monto_total_venta_usd"),
                                F.max("fecha_registro").alias("fecha_ultima_venta"))
    # distinct members in two steps, each kind reduced to one row per member before it is counted
    kinds = {"cod_cli": "base_activable_clientes", "cod_art": "skus_distintos_comprados", "documento": "total_documentos"}
    none = {n: F.lit(0).cast("long") for n in kinds.values()}
    parts = [f.select(*keys, c).dropDuplicates().groupBy(*keys).agg(F.count(c).alias("_n")).select(*keys, *[(F.col("_n") if m == n else v).alias(m) for m, v in none.items()])
             for c, n in kinds.items()]
    typed = {c: F.lit(None).cast(sums.schema[c].dataType) for c in sums.columns if c not in keys}
    stacked = sums.withColumns(none)
    for part in parts:
        stacked = stacked.unionByName(part.withColumns(typed))
    return stacked.groupBy(*keys).agg(*[F.max(c).alias(c) for c in typed], *[F.max(c).alias(c) for c in none])


PORTFOLIO_KEY = ["empresa", "codigo_sucursal", "codigo_vendedor", "codigo_proveedor", "codigo_cliente"]


def customer_master(fact: DataFrame, companies: DataFrame, branches: DataFrame, as_of: str) -> DataFrame:
    """Portfolio of customers (whole history) with last purchase, days without purchase
    (999 when none in 90 days), 90-day and month metrics and status labels.

    The 90-day and month metrics come from ONE conditional aggregation over the
    window (not two scans), joined to the portfolio on the code key.
    """
    emp = companies.select(TENANT, F.col("nombre_empresa").alias("_ne"))
    f = with_branch_name(fact, branches).join(F.broadcast(emp), TENANT, "left")
    portfolio = f.select(
        F.col(TENANT).alias("empresa"), F.coalesce("_ne", TENANT).alias("nombre_empresa"),
        F.col("cod_suc").alias("codigo_sucursal"), "nombre_sucursal",
        F.col("cod_ven").alias("codigo_vendedor"), F.col("nom_ven").alias("nombre_vendedor"),
        F.col("cod_pro").alias("codigo_proveedor"), F.col("nom_pro").alias("nombre_proveedor"),
        F.col("cod_cli").alias("codigo_cliente"), F.col("nom_cli").alias("nombre_cliente"),
        F.nullif(F.trim("rif"), F.lit("")).alias("rif_cliente"), F.col("nom_cla").alias("clase_cliente"),
        F.col("nom_est").alias("estado_cliente"), F.col("nom_ciu").alias("ciudad_cliente"),
    ).dropDuplicates()
    in_month = F.col("fecha_registro") >= _month_start(as_of)
    w = _window(fact, as_of, 90).select(
        F.col(TENANT).alias("empresa"), F.col("cod_suc").alias("codigo_sucursal"),
        F.col("cod_ven").alias("codigo_vendedor"), F.col("cod_pro").alias("codigo_proveedor"),
        F.col("cod_cli").alias("codigo_cliente"), "fecha_registro", "cajas_vendidas", "neto_dcto")
    m = w.groupBy(*PORTFOLIO_KEY).agg(
        F.max("fecha_registro").alias("fecha_ultima_compra"),
        F.sum("cajas_vendidas").alias("_c90"), F.sum("neto_dcto").alias("_v90"),
        F.max(F.when(in_month, F.col("fecha_registro"))).alias("_fmes"),
        F.sum(F.when(in_month, F.col("cajas_vendidas"))).alias("_cmes"),
        F.sum(F.when(in_month, F.col("neto_dcto"))).alias("_vmes"),
    )
    x = portfolio.join(m, PORTFOLIO_KEY, "left")
    z = F.lit(0)
    return x.select(
        *[c for c in portfolio.columns], "fecha_ultima_compra",
        F.coalesce(F.datediff(_d(as_of), F.col("fecha_ultima_compra")), F.lit(999)).alias("dias_sin_comprar"),
        F.when(F.col("fecha_ultima_compra").isNotNull(), F.lit("ACTIVADO (<=90d)"))
         .otherwise(F.lit("PENDIENTE POR ACTIVAR (>90d)")).alias("estatus_activacion_90d"),
        F.col("fecha_ultima_compra").isNotNull().alias("es_cliente_activado_90d"),
        F.col("_fmes").isNotNull().alias("compro_en_mes_actual"),
        F.coalesce(F.round("_cmes", 2), z).alias("cajas_mes_actual"),
        F.coalesce(F.round("_vmes", 2), z).alias("venta_usd_mes_actual"),
        F.coalesce(F.round("_c90", 2), z).alias("cajas_totales_90d"),
        F.coalesce(F.round("_v90", 2), z).alias("venta_usd_totales_90d"),
    )


# --- Fixed values: weekly-frequency labels ---------------------------------
FREQ_LABELS = {
    4: "Tipo 4 (Todas las Semanas / Frecuente)",
    3: "Tipo 3 (3 Semanas / Regular)",
    2: "Tipo 2 (2 Semanas / Ocasional)",
    1: "Tipo 1 (1 Semana / Esporádico)",
    0: "Tipo 0 (Inactivo)",
}
# ---------------------------------------------------------------------------


def weekly_frequency(fact: DataFrame, branches: DataFrame) -> DataFrame:
    """Distinct ISO weeks with purchases per customer and month -> frequency type 0-4
    ("type 4" = at least 4 distinct ISO weeks inside the month)."""
    keys = [F.col(TENANT).alias("empresa"), F.col("cod_suc").alias("codigo_sucursal"),
            F.col("cod_ven").alias("codigo_vendedor"), F.col("nom_ven").alias("nombre_vendedor"),
            F.col("cod_pro").alias("codigo_proveedor"), F.col("nom_pro").alias("nombre_proveedor"),
            F.col("cod_mar").alias("codigo_marca"), F.col("nom_mar").alias("nombre_marca"),
            F.col("cod_cli").alias("codigo_cliente"), F.col("nom_cli").alias("nombre_cliente"),
            F.nullif(F.trim("rif"), F.lit("")).alias("rif_cliente"), "anio_mes", "nombre_mes", "anio"]
    # the ISO weeks of a month follow each other, so their numbers modulo 64 are a bitmap that counts them exactly
    week = F.pmod(F.floor(F.datediff("fecha_registro", F.lit("1970-01-05").cast("date")) / 7), F.lit(64)).cast("int")
    g = fact.withColumn("_week", week).groupBy(*keys).agg(
        F.bit_count(F.bit_or(F.expr("shiftleft(1L, _week)"))).cast("long").alias("semanas_con_compra"),
        F.count_distinct("documento").alias("total_facturas_mes"),
        F.round(F.sum("cajas_vendidas"), 2).alias("cajas_compradas_mes"),
        F.round(F.sum("neto_dcto"), 2).alias("venta_usd_mes"),
        F.max("fecha_registro").alias("fecha_ultima_compra_mes"),
    )
    g = _named_branch(g, branches)
    n = F.col("semanas_con_compra")
    num = F.when(n >= 4, 4).when(n == 3, 3).when(n == 2, 2).when(n == 1, 1).otherwise(0)
    label = F.element_at(F.create_map(*[x for k, v in FREQ_LABELS.items() for x in (F.lit(k), F.lit(v))]), num)
    return g.withColumn("tipo_cliente_frecuencia_num", num).withColumn("tipo_cliente_frecuencia_nombre", label)


def frequency_distribution(freq: DataFrame, month: str | None = None) -> DataFrame:
    """Customers and amount per frequency type (for one month, or every month)."""
    f = freq if month is None else freq.filter(F.col("anio_mes") == month)
    return f.groupBy("empresa", "anio_mes", "tipo_cliente_frecuencia_num", "tipo_cliente_frecuencia_nombre").agg(
        F.count_distinct("codigo_cliente").alias("clientes"),
        F.round(F.sum("venta_usd_mes"), 2).alias("venta_usd"),
    )


def number_members(members: DataFrame, scope: str, member: str, number: str = "number") -> DataFrame:
    """Dense numbers 0, 1, 2, ... for the distinct ``member`` of each ``scope``: members are dealt to 256 buckets by the first
    byte of their md5 and numbered in order within a bucket, after the members of the buckets before. So no task sorts a whole scope."""
    each = members.select(scope, member).where(F.col(member).isNotNull()).dropDuplicates().withColumn("_bucket", F.substring(F.md5(F.col(member).cast("string")), 1, 2))
    sizes = each.groupBy(scope, "_bucket").agg(F.count("*").alias("_n"))  # at most 256 rows a scope
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(scope).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select(scope, "_bucket", before.alias("_before"))
    place = F.row_number().over(Window.partitionBy(scope, "_bucket").orderBy(member)) - 1
    return each.withColumn("_place", place).join(starts, [scope, "_bucket"]).select(scope, member, (F.col("_before") + F.col("_place")).alias(number))


def bitmap_words(numbered: DataFrame, keys: list[str], number: str = "number", name: str = "words") -> DataFrame:
    """Exact bitmap of the numbers of each key: a map from word (number div 64) to its 64 bits, merged map-side by bit_or."""
    words = numbered.groupBy(*keys, F.floor(F.col(number) / 64).cast("int").alias("_word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(pmod({number}, 64) as int))")).alias("_bits"))
    return words.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_word", "_bits"))).alias(name))


def bitmap_size(words: Column) -> Column:
    """How many bits a map of words (or an array of them) has set."""
    return F.aggregate(words, F.lit(0).cast("long"), lambda n, w: n + F.bit_count(w))


def zero_sale_sku(fact: DataFrame, branches: DataFrame, as_of: str) -> DataFrame:
    """The zero-sale SKU gaps of each portfolio customer: their number, and which they are.

    Expected are the SKUs of the tenant's 90-day catalogue for every customer in a seller's 90-day portfolio. SKUs get dense
    numbers per tenant, catalogue and purchases of the month (positive amounts) become bitmaps of 64-bit words, and the gaps are
    the catalogue's words less the bought ones: ``brechas``, the words in order as 16 hexadecimal digits each. So a customer's
    gaps take an eighth of a byte per SKU, and no (customer, SKU) pair is ever made; ``gap_skus`` lists them for chosen customers.
    """
    client = ["empresa", "codigo_sucursal", "codigo_vendedor", "codigo_cliente"]
    names = {TENANT: "empresa", "cod_suc": "codigo_sucursal", "cod_ven": "codigo_vendedor", "cod_cli": "codigo_cliente"}
    in_month = F.when(F.col("fecha_registro") >= _month_start(as_of), F.col("neto_dcto"))
    sold = _window(fact, as_of, 90).withColumnsRenamed(names).groupBy(*client, "cod_art").agg(F.sum(in_month).alias("_v"))
    numbers = number_members(sold, "empresa", "cod_art")
    # one row a tenant: all words of its catalogue, full but for the last
    size = numbers.groupBy("empresa").agg(F.count("*").alias("skus_catalogo"))
    last = F.pmod(F.col("skus_catalogo"), F.lit(64)).cast("int")
    words = F.transform(F.sequence(F.lit(0), F.ceil(F.col("skus_catalogo") / 64).cast("int") - 1),
                        lambda i: F.when((i < F.floor(F.col("skus_catalogo") / 64)) | (last == 0), F.lit(-1).cast("long")).otherwise(F.call_function("shiftrightunsigned", F.lit(-1).cast("long"), 64 - last)))
    catalogue = size.withColumn("_all", words)
    bought = bitmap_words(sold.where("_v > 0").join(numbers, ["empresa", "cod_art"]), client, name="_bought")
    portfolio = sold.select(*client).dropDuplicates()
    # a catalogue row per tenant: small beside the portfolio, and left to the optimizer's measured sizes
    x = portfolio.join(catalogue, "empresa").join(bought, client, "left")
    mine = lambda i: F.coalesce(F.try_element_at("_bought", i), F.lit(0).cast("long"))
    gaps = F.transform("_all", lambda w, i: w.bitwiseAND(F.bitwise_not(mine(i))))
    x = x.withColumns({"_gaps": gaps}).withColumns({
        "skus_comprados_mes": F.col("skus_catalogo") - bitmap_size(F.col("_gaps")), "skus_venta_cero": bitmap_size(F.col("_gaps")),
        "brechas": F.array_join(F.transform("_gaps", lambda w: F.lpad(F.lower(F.hex(w)), 16, "0")), "")})
    return _named_branch(x, branches).select("empresa", "codigo_sucursal", "nombre_sucursal", "codigo_vendedor", "codigo_cliente", "skus_catalogo", "skus_comprados_mes",
                                             "skus_venta_cero", "brechas")


def gap_skus(gaps: DataFrame, fact: DataFrame, as_of: str) -> DataFrame:
    """The SKUs behind ``brechas`` of the customers in ``gaps`` (rows of ``zero_sale_sku``, as many as one wants listed)."""
    names = _window(fact, as_of, 90).withColumnRenamed(TENANT, "empresa")
    bits = F.explode(F.sequence(F.lit(0), (F.length("brechas") / 16 * 64).cast("int") - 1)).alias("number")
    each = gaps.where(F.length("brechas") > 0).select("empresa", "codigo_sucursal", "codigo_vendedor", "codigo_cliente", "brechas", bits)
    # bit k of a word is bit k % 4 of its hexadecimal digit 15 - k // 4
    digit = F.substring(F.col("brechas"), (F.floor(F.col("number") / 64) * 16 + 16 - F.floor(F.pmod("number", F.lit(64)) / 4)).cast("int"), F.lit(1))
    held = F.conv(digit, 16, 10).cast("int")
    there = F.pmod(F.floor(held / F.pow(F.lit(2), F.pmod("number", F.lit(4)))), F.lit(2)) == 1
    return each.where(there).join(number_members(names, "empresa", "cod_art"), ["empresa", "number"]).drop("brechas", "number")


#: Stands for all brands of the tenant that a seller did not sell in the window.
REST = '(resto)'


def sku_penetration(fact: DataFrame, as_of: str) -> DataFrame:
    """Per branch, seller and brand: expected pairs = portfolio customers x SKUs of the brand, pairs bought this month,
    gaps and penetration %. Brands sold in the 90-day window have a row each; the others share one row per seller
    (``REST``), so a seller's gaps are complete without a row for every brand. Factors are per-key aggregates joined by key."""
    seller = ["empresa", "codigo_sucursal", "codigo_vendedor"]
    names = {TENANT: "empresa", "cod_suc": "codigo_sucursal", "cod_ven": "codigo_vendedor", "cod_mar": "codigo_marca"}
    in_month = F.when(F.col("fecha_registro") >= _month_start(as_of), F.col("neto_dcto"))
    sold = _window(fact, as_of, 90).withColumnsRenamed(names).groupBy(*seller, "codigo_marca", "cod_cli", "cod_art").agg(F.sum(in_month).alias("_v"))
    # two-step distinct counts: one row per member, then a count
    cust = sold.select(*seller, "cod_cli").dropDuplicates().groupBy(*seller).agg(F.count("cod_cli").alias("clientes_cartera"))
    skus = sold.select("empresa", "codigo_marca", "cod_art").dropDuplicates().groupBy("empresa", "codigo_marca").agg(F.count("cod_art").alias("skus_marca"))
    total = skus.groupBy("empresa").agg(F.sum("skus_marca").alias("_total"))
    seen = sold.groupBy(*seller, "codigo_marca").agg(F.count_if(F.col("_v") > 0).alias("pares_comprados")).alias("a")
    seen = seen.join(skus.alias("b"), (F.col("a.empresa") == F.col("b.empresa")) & F.col("a.codigo_marca").eqNullSafe(F.col("b.codigo_marca"))) \
        .select("a.*", "b.skus_marca")
    rest = seen.groupBy(*seller).agg(F.sum("skus_marca").alias("_seen")).join(total, "empresa").select(
        *seller, F.lit(REST).alias("codigo_marca"), F.lit(0).cast("long").alias("pares_comprados"), (F.col("_total") - F.col("_seen")).alias("skus_marca"))
    x = seen.unionByName(rest).join(cust, seller)
    x = x.withColumn("pares_esperados", (F.col("clientes_cartera") * F.col("skus_marca")).cast("long"))
    return x.withColumns({
        "brechas_venta_cero": F.col("pares_esperados") - F.col("pares_comprados"),
        "pct_penetracion": F.round(F.try_divide(F.col("pares_comprados"), F.nullif(F.col("pares_esperados"), F.lit(0))) * 100, 2),
    })


SELLOUT_KEYS = ["empresa", "codigo_sucursal", "codigo_vendedor", "codigo_proveedor", "codigo_marca", "codigo_articulo"]


def same_day_last_year(daily: DataFrame, prev: DataFrame, keys: list[str], date_col: str = "fecha") -> DataFrame:
    """Current day ⋈ same day last year (prev already shifted to ``fecha_equivalente``)."""
    return daily.join(prev.withColumnRenamed("fecha_equivalente", date_col), [*keys, date_col], "left")


_SELLOUT_SUMS = {"unidades_vendidas_actual": "unidades_vendidas", "cajas_vendidas_actual": "cajas_vendidas", "toneladas_vendidas_actual": "peso_total_toneladas", "venta_usd_actual": "neto_dcto"}


def sellout_daily(fact: DataFrame) -> DataFrame:
    """One row per day, branch, seller, supplier, brand and SKU: documents, customers, units, boxes, tons and amount (not rounded).
    Each document and each customer of a group is reduced to one row before it is counted."""
    keys = [F.col(TENANT).alias("empresa"), F.col("cod_suc").alias("codigo_sucursal"), F.col("cod_ven").alias("codigo_vendedor"), F.col("nom_ven").alias("nombre_vendedor"),
            F.col("cod_pro").alias("codigo_proveedor"), F.col("nom_pro").alias("nombre_proveedor"), F.col("cod_mar").alias("codigo_marca"), F.col("nom_mar").alias("nombre_marca"),
            F.col("cod_art").alias("codigo_articulo"), F.col("nom_art").alias("nombre_articulo"), F.col("modelo"), F.col("fecha_registro").alias("fecha")]
    kinds = {"total_documentos": "documento", "clientes_unicos_compradores": "cod_cli"}
    first = next(iter(kinds))
    member = F.explode(F.array(*[F.struct(F.lit(n).alias("kind"), F.col(c).cast("string").alias("member"), *[F.when(F.lit(n == first), F.col(x)).alias(m) for m, x in _SELLOUT_SUMS.items()])
                                 for n, c in kinds.items()]))
    lines = fact.select(*keys, member.alias("m"))
    names = lines.columns[:-1]
    members = lines.select(*names, "m.*").groupBy(*names, "kind", "member").agg(*[F.sum(m).alias(m) for m in _SELLOUT_SUMS])
    return members.groupBy(*names).agg(*[F.count_if((F.col("kind") == n) & F.col("member").isNotNull()).alias(n) for n in kinds], *[F.sum(m).alias(m) for m in _SELLOUT_SUMS])


def with_last_year(daily: DataFrame, keys: list[str], sums: dict[str, str], date_col: str = "fecha") -> DataFrame:
    """J5 without a join: each row also stands for its day a year later, where its ``sums`` are added up (to 2 digits) over the rows of the same
    keys. A row with a NULL key has no last year. One window over keys and day, for which rows dealt by one of the keys stay where they are."""
    whole = F.lit(True)
    for k in (*keys, date_col):
        whole = whole & F.col(k).isNotNull()
    year = [F.struct(F.lit(k == 0).alias("_now"), (F.col(date_col) if k == 0 else F.add_months(date_col, 12)).alias("_day")) for k in (0, 1)]
    both = daily.withColumn("_at", F.explode(F.when(whole, F.array(*year)).otherwise(F.array(year[0])))).select("*", "_at.*").drop("_at")
    w = Window.partitionBy(*keys, "_day")
    last = {name: F.when(whole, F.round(F.sum(F.when(~F.col("_now"), F.col(c))).over(w), 2)) for c, name in sums.items()}
    return both.withColumns(last).where("_now").drop("_now", "_day")


def sellout_last_year(daily: DataFrame) -> DataFrame:
    """Rows of ``sellout_daily`` with boxes and amount of the same day last year, ``_cp`` and ``_vp``."""
    return with_last_year(daily, SELLOUT_KEYS, {"cajas_vendidas_actual": "_cp", "venta_usd_actual": "_vp"})


def sellout_yoy(daily: DataFrame, branches: DataFrame) -> DataFrame:
    """Daily sell-out (rows of ``sellout_daily``, or a written table of ``sellout_last_year``) with the same day last year (Feb 29 + 1 year = Feb 28), variation and
    growth %. Calendar columns are made from the day and the branch's name is joined to the result."""
    from .dims import calendar_named

    digits = {"cajas_vendidas_actual": 2, "toneladas_vendidas_actual": 3, "venta_usd_actual": 2}
    x = daily if "_cp" in daily.columns else sellout_last_year(daily)
    x = _named_branch(x.withColumns({c: F.round(c, n) for c, n in digits.items()}), branches)
    vp = F.coalesce("_vp", F.lit(0))
    cal = calendar_named(F.col("fecha"))
    return x.withColumns({c: cal[c] for c in ("anio", "mes", "nombre_mes", "anio_mes", "trimestre", "trimestre_nombre", "anio_trimestre", "semana_del_anio", "anio_semana", "quincena", "quincena_nombre")}).withColumns({
        "cajas_vendidas_anio_anterior": F.coalesce("_cp", F.lit(0)),
        "venta_usd_anio_anterior": vp,
        "variacion_venta_usd_yoy": F.round(F.col("venta_usd_actual") - vp, 2),
        "pct_crecimiento_yoy": F.round(F.try_divide(F.col("venta_usd_actual") - vp, F.nullif(F.col("_vp"), F.lit(0))) * 100, 2),
    }).drop("_cp", "_vp")


def project_contract(df: DataFrame, mapping: list[tuple[str, str | None, str]]) -> DataFrame:
    """Business projection: (source column or None, display name, type) -> typed NULL when absent."""
    cols = []
    for src, name, typ in mapping:
        c = F.col(src) if src is not None else F.lit(None)
        cols.append(c.cast(typ).alias(name))
    return df.select(*cols)


SALES_CONSUMER = [("source_empresa", "source_empresa", "string"), ("tipo_documento", "tipo_documento", "string"),
                  ("cod_suc", "cod_suc", "string"), ("documento", "documento", "string"), ("renglon", "renglon", "double"),
                  ("registro", "registro", "timestamp"), ("fecha_registro", "fec_ini", "date"), ("cod_ven", "cod_ven", "string"),
                  ("nom_ven", "nom_ven", "string"), ("cod_cli", "cod_cli", "string"), ("nom_cli", "nom_cli", "string"),
                  ("cod_art", "cod_art", "string"), ("nom_art", "nom_art", "string"), ("cod_pro", "cod_pro", "string"),
                  ("unidades_vendidas", "unidades_vendidas", "double"), ("cajas_vendidas", "cajas_vendidas", "double"),
                  ("neto_dcto", "neto_dcto", "double"), (None, "canal", "string")]


def inventory_sync(silver_stock: DataFrame, gold_report: DataFrame) -> DataFrame:
    """Per tenant rows, warehouses, articles and units of the stock in Silver (above 0) and in the inventory report."""
    def side(df, tenant, alm, art, units, name):
        pairs = df.select(F.col(tenant).alias(TENANT), F.col(alm).alias("_w"), F.col(art).alias("_a"), F.col(units).alias("_u"))
        return pairs.groupBy(TENANT).agg(F.count("*").alias(f"filas_{name}"), F.count_distinct("_w").alias(f"almacenes_{name}"),
                                         F.round(F.sum("_u"), 2).alias(f"unidades_{name}"))
    s = side(silver_stock.filter(F.col("exi_act1") > 0), TENANT, "cod_alm", "cod_art", "exi_act1", "silver")
    g = side(gold_report, "empresa", "codigo_almacen", "codigo_articulo", "unidades_totales", "gold")
    same = (F.col("filas_silver") == F.col("filas_gold")) & (F.col("unidades_silver") == F.col("unidades_gold"))
    return s.join(g, TENANT, "full").withColumn("sincronizado", F.coalesce(same, F.lit(False)))


def gps_coverage(customers: DataFrame) -> DataFrame:
    """Customers with GPS text, with valid coordinates, and coverage %."""
    has_text = F.coalesce(F.col("gps"), F.lit("")) != ""
    g = customers.groupBy(TENANT).agg(F.count("*").alias("clientes"), F.count_if(has_text).alias("con_gps"),
                                      F.count_if(F.col("gps_valido")).alias("gps_validos"))
    return g.withColumn("pct_validos", F.round(F.try_divide(F.col("gps_validos"), F.col("clientes")) * 100, 2))


def scope_summary(scopes: DataFrame) -> DataFrame:
    """Scope rows and distinct users per domain, role, status and tenant."""
    return scopes.groupBy("domain", "role_type", "status", "source_empresa").agg(
        F.count("*").alias("filas"), F.count_distinct("correo").alias("usuarios"))


def usage_monitor(jobs: DataFrame, as_of: str, tz: str, days: int = 30) -> DataFrame:
    """Queries, TiB read and slot seconds per local day and user over a job log,
    SELECT statements of the last ``days`` days only."""
    local = F.from_utc_timestamp(F.col("creation_time"), tz)
    j = jobs.filter((F.col("statement_type") == "SELECT") &
                    (F.to_date(local) > F.date_sub(_d(as_of), days)) & (F.to_date(local) <= _d(as_of)))
    return j.groupBy(F.to_date(local).alias("dia"), "user_email").agg(
        F.count("*").alias("consultas"),
        F.round(F.sum("total_bytes_processed") / F.lit(1024 ** 4), 6).alias("tib_leidos"),
        F.round(F.sum("total_slot_ms") / F.lit(1000), 3).alias("slot_segundos"))


def between_dates(df: DataFrame, col: str, lo: str, hi: str) -> DataFrame:
    """Inclusive date range filter on a date column (a plain predicate, so it reaches the
    parquet scan as a pushed filter and prunes partitions when the table is partitioned by it)."""
    return df.filter(F.col(col).between(_d(lo), _d(hi)))
