"""P10: customer and sales density per S2 cell."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.s2cell import cell_token

TENANT = "source_empresa"


def geo_density(customers: DataFrame, sales: DataFrame, level: int = 10) -> DataFrame:
    """Valid points (|lat| <= 90, |lng| <= 180) get the S2 cell of ``level``; per cell:
    customers and their net sales. Sales are aggregated per customer before the
    join (one row per customer reaches the cell aggregation)."""
    c = customers.filter(F.col("latitud").between(-90, 90) & F.col("longitud").between(-180, 180))
    c = c.select(TENANT, "cod_cli", cell_token(F.col("latitud"), F.col("longitud"), level).alias("celda"))
    s = sales.groupBy(TENANT, "cod_cli").agg(F.sum("neto_dcto").alias("_v"))
    x = c.join(s, [TENANT, "cod_cli"], "left")
    return x.groupBy(TENANT, "celda").agg(F.count("*").alias("clientes"),
                                          F.round(F.coalesce(F.sum("_v"), F.lit(0)), 2).alias("venta_neta"))
