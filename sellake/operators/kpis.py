"""Semantic-layer measures (K1-K12) as DataFrame operators.

A scope is a set of grouping columns (tenant, supplier, month, ...) plus
optional filters applied by the caller. Portfolio and activation are exact
distinct counts built from a (scope, customer) set, never from row expansion:
the 90-day portfolio of a month is the set of customers with a positive line in
the three months before it, obtained by shifting each (customer, month) fact by
1..3 months (a fixed, small fan-out) and deduplicating.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TENANT = "source_empresa"
MONTH = "mes_inicio"


def with_month(fact: DataFrame) -> DataFrame:
    return fact.withColumn(MONTH, F.trunc("fecha_registro", "month"))


def net_sales(fact: DataFrame, by: list[str]) -> DataFrame:
    """K1: net sales (sum of neto_dcto) per scope."""
    return fact.groupBy(*by).agg(F.round(F.sum("neto_dcto"), 2).alias("venta_neta"))


def average_ticket(fact: DataFrame, by: list[str]) -> DataFrame:
    """K2: net sales / distinct invoices."""
    return fact.groupBy(*by).agg(
        F.round(F.try_divide(F.sum("neto_dcto"), F.count_distinct("documento")), 2).alias("ticket_promedio"))


def skus_per_invoice(fact: DataFrame, by: list[str]) -> DataFrame:
    """K3: average number of distinct SKUs per invoice (two-step aggregation)."""
    per_doc = fact.groupBy(*by, "documento").agg(F.count_distinct("cod_art").alias("_skus"))
    return per_doc.groupBy(*by).agg(F.round(F.avg("_skus"), 2).alias("skus_por_factura"))


def buyers(fact: DataFrame, by: list[str]) -> DataFrame:
    """Distinct (scope, customer) with a positive line (neto_dcto > 0) in the scope's month."""
    return fact.filter(F.col("neto_dcto") > 0).select(*by, "cod_cli").dropDuplicates()


def portfolio_set(fact: DataFrame, by: list[str]) -> DataFrame:
    """K4 set: per (scope, target month), customers with a positive line in the three
    months before the target month. ``by`` must contain ``mes_inicio``."""
    base = [c for c in by if c != MONTH]
    b = buyers(fact, [*base, MONTH])
    shifted = b.withColumn("_k", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3)))) \
        .withColumn(MONTH, F.add_months(F.col(MONTH), F.col("_k"))).drop("_k")
    return shifted.dropDuplicates()


def portfolio_90d(fact: DataFrame, by: list[str]) -> DataFrame:
    """K4: size of the activable portfolio per scope and month."""
    return portfolio_set(fact, by).groupBy(*by).agg(F.count("*").alias("cartera_90d"))


def activated(fact: DataFrame, by: list[str]) -> DataFrame:
    """K5: customers with a positive line in the period."""
    return buyers(fact, by).groupBy(*by).agg(F.count("*").alias("clientes_activados"))


def activation_rate(fact: DataFrame, by: list[str]) -> DataFrame:
    """K6: activated / portfolio (%), per scope and month present in the fact."""
    scopes = fact.select(*by).dropDuplicates()
    x = scopes.join(activated(fact, by), by, "left").join(portfolio_90d(fact, by), by, "left")
    x = x.fillna(0, ["clientes_activados", "cartera_90d"])
    return x.withColumn("tasa_activacion", F.round(
        F.try_divide(F.col("clientes_activados"), F.nullif(F.col("cartera_90d"), F.lit(0))) * 100, 2))


def zero_sale_customers(fact: DataFrame, by: list[str]) -> DataFrame:
    """K7: portfolio customers without a positive line in the period (set difference, J7)."""
    port = portfolio_set(fact, by)
    return without_purchase(port, buyers(fact, by), [*by, "cod_cli"])


def without_purchase(portfolio: DataFrame, buyers_: DataFrame, key: list[str]) -> DataFrame:
    """Portfolio EXCEPT buyers (left anti join on the key)."""
    return portfolio.join(buyers_.select(*key), key, "left_anti")


def top_customers(fact: DataFrame, by: list[str], n: int = 10) -> DataFrame:
    """K8: top-N customers by net sales per scope, ties broken by customer code.

    Customers are aggregated first (partial aggregation map-side), then ranked
    inside each scope; ``row_number <= n`` is planned as a partial group limit.
    """
    per = fact.groupBy(*by, "cod_cli").agg(F.sum("neto_dcto").alias("_v"))
    w = Window.partitionBy(*by).orderBy(F.col("_v").desc(), F.col("cod_cli").asc())
    r = per.withColumn("posicion", F.row_number().over(w)).filter(F.col("posicion") <= n)
    return r.withColumn("venta_neta", F.round("_v", 2)).drop("_v")


def gps_share(fact: DataFrame, customers: DataFrame, by: list[str]) -> DataFrame:
    """K9: buying customers with valid GPS / buying customers (%), and both counts."""
    b = fact.select(*by, "cod_cli").dropDuplicates()
    c = customers.select(TENANT, "cod_cli", "gps_valido")
    x = b.join(c, [TENANT, "cod_cli"], "left")
    g = x.groupBy(*by).agg(F.count("*").alias("clientes"),
                           F.count_if(F.coalesce(F.col("gps_valido"), F.lit(False))).alias("clientes_gps_valido"))
    return g.withColumn("pct_gps", F.round(F.try_divide(F.col("clientes_gps_valido"), F.col("clientes")) * 100, 2))


def monthly_activation(fact: DataFrame, by: list[str]) -> DataFrame:
    """One table per scope and month with K1, K2, K4, K5, K6, K7 and boxes.

    The fact is reduced once to (scope, month, customer) with amounts and a positive flag. A buyer is activated in its month
    and in the portfolio of the next three; these flags are stacked, folded per customer and summed per scope. Invoices need a
    reduction of their own. All parts meet in one aggregation instead of joins. A scope with a NULL key has no
    activated or portfolio customers.
    """
    scope = [c for c in by if c != MONTH]
    per = fact.groupBy(*by, "cod_cli").agg(F.sum("neto_dcto").alias("_v"), F.sum("cajas_vendidas").alias("_c"), F.max(F.col("neto_dcto") > 0).alias("_pos"))
    whole = F.lit(True)
    for c in by:
        whole = whole & F.col(c).isNotNull()
    buys = per.filter(F.col("_pos") & whole).select(*by, "cod_cli").withColumn("_k", F.explode(F.array(*[F.lit(k) for k in range(4)])))
    buys = buys.select(*scope, F.add_months(MONTH, F.col("_k")).alias(MONTH), "cod_cli", (F.col("_k") == 0).cast("long").alias("_a"), (F.col("_k") > 0).cast("long").alias("_p"))
    flags = buys.groupBy(*by, "cod_cli").agg(F.max("_a").alias("_a"), F.max("_p").alias("_p"))
    docs = fact.filter(F.col("documento").isNotNull()).select(*by, "documento").dropDuplicates()
    parts = [per.select(*by, "_v", "_c", F.lit(1).alias("_seen")), docs.select(*by, F.lit(1).alias("_d")),
             flags.select(*by, "_a", "_p", F.greatest(F.col("_p") - F.col("_a"), F.lit(0)).alias("_z"))]
    x = parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True).groupBy(*by).agg(
        F.sum("_v").alias("_v"), F.sum("_c").alias("_c"), F.sum("_d").alias("_d"), F.max("_seen").alias("_seen"),
        *[F.coalesce(F.sum(s), F.lit(0)).alias(n) for s, n in (("_a", "clientes_activados"), ("_p", "cartera_90d"), ("_z", "clientes_venta_cero"))])
    return x.filter("_seen = 1").select(
        *by, F.round("_v", 2).alias("venta_neta"), F.round(F.try_divide("_v", "_d"), 2).alias("ticket_promedio"), F.round("_c", 2).alias("cajas"),
        "clientes_activados", "cartera_90d",
        F.round(F.try_divide(F.col("clientes_activados"), F.nullif(F.col("cartera_90d"), F.lit(0))) * 100, 2).alias("tasa_activacion"), "clientes_venta_cero")


def seller_productivity(fact: DataFrame, by: list[str]) -> DataFrame:
    """Sales, boxes and activated customers per seller."""
    keys = [*by, "cod_ven"]
    g = fact.groupBy(*keys).agg(F.round(F.sum("neto_dcto"), 2).alias("venta_neta"),
                                F.round(F.sum("cajas_vendidas"), 2).alias("cajas"))
    return g.join(activated(fact, keys), keys, "left").fillna(0, ["clientes_activados"])


def activated_list(fact: DataFrame, by: list[str]) -> DataFrame:
    """Activated customers with seller, sales, boxes and units of their positive lines, in order of sales within each
    scope (a range-partitioned order, no rank: a rank would take a scope's customers to one task)."""
    keys = [*by, "cod_cli", "cod_ven"]
    g = fact.filter(F.col("neto_dcto") > 0).groupBy(*keys).agg(
        F.round(F.sum("neto_dcto"), 2).alias("venta_neta"), F.round(F.sum("cajas_vendidas"), 2).alias("cajas"),
        F.sum("unidades_vendidas").alias("unidades"))
    return g.orderBy(*by, F.col("venta_neta").desc(), "cod_cli", "cod_ven")
