"""B1: windows of work that still have no successful batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fortnight_start(d) -> "F.Column":
    """Start of the fortnight (1-15 or 16-end) containing day ``d``."""
    m = F.trunc(d, "month")
    return F.when(F.dayofmonth(d) <= 15, m).otherwise(F.date_add(m, 15))


def missing_windows(registry: DataFrame, expected: DataFrame, start: str, as_of: str) -> DataFrame:
    """B1: fortnight windows (1-15, 16-end, clipped at ``as_of``) per pair of ``expected`` (source_empresa, query_id) with no
    SUCCESS batch in the registry; a pair that never landed misses all of them.

    Windows are generated per (tenant, query) by exploding a month sequence (no
    cross join); the registry's successful days are bucketed to their window start,
    so coverage is an equi anti join instead of a range join.
    """
    s, a = F.lit(start).cast("date"), F.lit(as_of).cast("date")
    pairs = expected.select("source_empresa", "query_id").distinct()
    months = pairs.withColumn("_m", F.explode(F.sequence(F.trunc(s, "month"), F.trunc(a, "month"), F.expr("INTERVAL 1 MONTH"))))
    halves = months.withColumn("_h", F.explode(F.array(F.lit(0), F.lit(1))))
    ws = F.when(F.col("_h") == 0, F.col("_m")).otherwise(F.date_add("_m", 15))
    we = F.when(F.col("_h") == 0, F.date_add("_m", 14)).otherwise(F.last_day("_m"))
    w = halves.select("source_empresa", "query_id", ws.alias("window_start"), F.least(we, a).alias("window_end")) \
        .filter((F.col("window_start") <= a) & (F.col("window_end") >= s))
    done = registry.filter(F.col("status") == "SUCCESS").select(
        "source_empresa", F.col("entity").alias("query_id"), fortnight_start(F.col("dt").cast("date")).alias("window_start")).distinct()
    return w.join(done, ["source_empresa", "query_id", "window_start"], "left_anti")
