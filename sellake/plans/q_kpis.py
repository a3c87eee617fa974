"""KPI measure queries (K1-K12), per tenant (and supplier/seller) and month over the whole history."""

from __future__ import annotations

from . import oracle as O
from .queries import query
from ..operators import kpis as K

TM = ["source_empresa", "mes_inicio"]
TM_SPEC = "source_empresa:s, mes_inicio:dt, "
O.view("fm", ["fct_ventas"], "SELECT *, CAST(date_trunc('month', fecha_registro) AS DATE) AS mes_inicio FROM fct_ventas")


def _port(by: str) -> str:
    return f"""SELECT DISTINCT {by}, cod_cli, CAST(mes + to_months(k) AS DATE) AS mes_inicio
FROM (SELECT DISTINCT {by}, cod_cli, mes_inicio AS mes FROM fm WHERE neto_dcto > 0) b, unnest([1, 2, 3]) AS t(k)"""


def _buy(by: str) -> str:
    return f"SELECT DISTINCT {by}, cod_cli, mes_inicio FROM fm WHERE neto_dcto > 0"


O.view("port_t", ["fm"], _port("source_empresa"))
O.view("buy_t", ["fm"], _buy("source_empresa"))
O.view("port_tp", ["fm"], _port("source_empresa, cod_pro"))
O.view("buy_tp", ["fm"], _buy("source_empresa, cod_pro"))


def fm(lk):
    """Lines by month for measures that need no article."""
    return K.with_month(lk.coded_fact)


def fm_measured(lk):
    """Lines by month with boxes, units and the supplier."""
    return K.with_month(lk.measured_fact)


@query("K1_net_sales", O.out("SELECT source_empresa, mes_inicio, round(sum(neto_dcto), 2) AS venta_neta FROM fm GROUP BY ALL",
                             TM_SPEC + "venta_neta:d"))
def k1(lk):
    """K1: net sales per tenant and month."""
    return K.net_sales(fm(lk), TM)


@query("K2_average_ticket", O.out("""SELECT source_empresa, mes_inicio,
  round(CAST(sum(neto_dcto) / count(DISTINCT documento) AS DECIMAL(38,10)), 2) AS ticket_promedio FROM fm GROUP BY ALL""",
                                  TM_SPEC + "ticket_promedio:d"))
def k2(lk):
    """K2: net sales / distinct invoices per tenant and month."""
    return K.average_ticket(fm(lk), TM)


@query("K3_skus_per_invoice", O.out("""SELECT source_empresa, mes_inicio, round(avg(n), 2) AS skus_por_factura FROM (
  SELECT source_empresa, mes_inicio, documento, count(DISTINCT cod_art) AS n FROM fm GROUP BY ALL) d GROUP BY ALL""",
                                    TM_SPEC + "skus_por_factura:d"))
def k3(lk):
    """K3: average distinct SKUs per invoice."""
    return K.skus_per_invoice(fm(lk), TM)


@query("K4_portfolio_90d", O.out("SELECT source_empresa, mes_inicio, count(*) AS cartera_90d FROM port_t GROUP BY ALL",
                                 TM_SPEC + "cartera_90d:i"))
def k4(lk):
    """K4: customers with a positive line in the three months before each month."""
    return K.portfolio_90d(fm(lk), TM)


@query("K5_activated", O.out("SELECT source_empresa, mes_inicio, count(*) AS clientes_activados FROM buy_t GROUP BY ALL",
                             TM_SPEC + "clientes_activados:i"))
def k5(lk):
    """K5: customers with a positive line in the month."""
    return K.activated(fm(lk), TM)


K6_SQL = """
WITH s AS (SELECT DISTINCT source_empresa, mes_inicio FROM fm),
a AS (SELECT source_empresa, mes_inicio, count(*) AS n FROM buy_t GROUP BY ALL),
p AS (SELECT source_empresa, mes_inicio, count(*) AS n FROM port_t GROUP BY ALL)
SELECT s.source_empresa, s.mes_inicio, COALESCE(a.n, 0) AS clientes_activados, COALESCE(p.n, 0) AS cartera_90d,
  round(COALESCE(a.n, 0) / NULLIF(COALESCE(p.n, 0), 0) * 100, 2) AS tasa_activacion
FROM s LEFT JOIN a USING (source_empresa, mes_inicio) LEFT JOIN p USING (source_empresa, mes_inicio)"""


@query("K6_activation_rate", O.out(K6_SQL, TM_SPEC + "clientes_activados:i, cartera_90d:i, tasa_activacion:d"))
def k6(lk):
    """K6: activated / portfolio (%) per tenant and month."""
    return K.activation_rate(fm(lk), TM)


@query("K7_zero_sale_customers", O.out("SELECT * FROM port_t EXCEPT SELECT * FROM buy_t", TM_SPEC + "cod_cli:s"))
def k7(lk):
    """K7: portfolio customers with no positive line in the month (list)."""
    return K.zero_sale_customers(fm(lk), TM).select(*TM, "cod_cli")


@query("K8_top_customers", O.out("""SELECT source_empresa, cod_cli, posicion, round(v, 2) AS venta_neta FROM (
  SELECT source_empresa, cod_cli, sum(neto_dcto) AS v,
         row_number() OVER (PARTITION BY source_empresa ORDER BY sum(neto_dcto) DESC, cod_cli ASC) AS posicion
  FROM fct_ventas GROUP BY source_empresa, cod_cli) r WHERE posicion <= 10""", "source_empresa:s, cod_cli:s, posicion:i, venta_neta:d"))
def k8(lk):
    """K8: top 10 customers by net sales per tenant, ties by customer code."""
    return K.top_customers(lk.coded_fact, ["source_empresa"], 10)


@query("K9_gps_share", O.out("""SELECT b.source_empresa, count(*) AS clientes,
  count(*) FILTER (WHERE COALESCE(c.gps_valido, FALSE)) AS clientes_gps_valido,
  round(count(*) FILTER (WHERE COALESCE(c.gps_valido, FALSE)) / count(*) * 100, 2) AS pct_gps
FROM (SELECT DISTINCT source_empresa, cod_cli FROM fct_ventas) b
LEFT JOIN sil_clientes c ON b.source_empresa = c.source_empresa AND b.cod_cli = c.cod_cli GROUP BY ALL""",
                             "source_empresa:s, clientes:i, clientes_gps_valido:i, pct_gps:d"))
def k9(lk):
    """K9: buying customers with valid GPS, and their share, per tenant."""
    return K.gps_share(lk.coded_fact, lk.sil("clientes"), ["source_empresa"])


@query("K10_monthly_activation", O.out("""
WITH base AS (SELECT source_empresa, cod_pro, mes_inicio, round(sum(neto_dcto), 2) AS venta_neta,
    round(CAST(sum(neto_dcto) / count(DISTINCT documento) AS DECIMAL(38,10)), 2) AS ticket_promedio,
    round(sum(cajas_vendidas), 2) AS cajas FROM fm GROUP BY ALL),
a AS (SELECT source_empresa, cod_pro, mes_inicio, count(*) AS n FROM buy_tp GROUP BY ALL),
p AS (SELECT source_empresa, cod_pro, mes_inicio, count(*) AS n FROM port_tp GROUP BY ALL),
z AS (SELECT source_empresa, cod_pro, mes_inicio, count(*) AS n FROM (SELECT * FROM port_tp EXCEPT SELECT * FROM buy_tp) q GROUP BY ALL)
SELECT base.*, COALESCE(a.n, 0) AS clientes_activados, COALESCE(p.n, 0) AS cartera_90d,
  round(COALESCE(a.n, 0) / NULLIF(COALESCE(p.n, 0), 0) * 100, 2) AS tasa_activacion, COALESCE(z.n, 0) AS clientes_venta_cero
FROM base LEFT JOIN a USING (source_empresa, cod_pro, mes_inicio) LEFT JOIN p USING (source_empresa, cod_pro, mes_inicio)
LEFT JOIN z USING (source_empresa, cod_pro, mes_inicio)""",
    "source_empresa:s, cod_pro:s, mes_inicio:dt, venta_neta:d, ticket_promedio:d, cajas:d, clientes_activados:i, "
    "cartera_90d:i, tasa_activacion:d, clientes_venta_cero:i"))
def k10(lk):
    """Monthly activation table per tenant and supplier (K1, K2, K4-K7, boxes)."""
    return K.monthly_activation(fm_measured(lk), ["source_empresa", "cod_pro", "mes_inicio"])


@query("K11_seller_productivity", O.out("""
SELECT g.*, COALESCE(a.n, 0) AS clientes_activados FROM (
  SELECT source_empresa, mes_inicio, cod_ven, round(sum(neto_dcto), 2) AS venta_neta, round(sum(cajas_vendidas), 2) AS cajas
  FROM fm GROUP BY ALL) g
LEFT JOIN (SELECT source_empresa, mes_inicio, cod_ven, count(DISTINCT cod_cli) AS n FROM fm WHERE neto_dcto > 0 GROUP BY ALL) a
USING (source_empresa, mes_inicio, cod_ven)""", TM_SPEC + "cod_ven:s, venta_neta:d, cajas:d, clientes_activados:i"))
def k11(lk):
    """Sales, boxes and activated customers per seller and month."""
    return K.seller_productivity(fm_measured(lk), TM)


@query("K12_activated_list", O.out("""SELECT source_empresa, mes_inicio, cod_cli, cod_ven, round(sum(cajas_vendidas), 2) AS cajas,
  sum(unidades_vendidas) AS unidades, round(sum(neto_dcto), 2) AS venta_neta FROM fm WHERE neto_dcto > 0 GROUP BY ALL""",
                                   TM_SPEC + "cod_cli:s, cod_ven:s, cajas:d, unidades:d, venta_neta:d"))
def k12(lk):
    """Activated customers with seller, sales, boxes and units of their positive lines."""
    return K.activated_list(fm_measured(lk), TM)
