"""Quality checks as DataFrames (Q1-Q6): every check is one aggregation pass and
returns rows (violations or counts) instead of raising, so a pipeline can report
and go on.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import Entity


def assert_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Q1: keys that appear more than once, with their count (map-side partial counts)."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def assert_non_null(df: DataFrame, cols: list[str], table: str = "") -> DataFrame:
    """Q2: one row per column with its NULL count, from a single aggregation (``stack`` to rows)."""
    agg = df.agg(F.count("*").alias("_total"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    pairs = ", ".join(f"'{c}', `{c}`" for c in cols)
    return agg.select(F.lit(table).alias("tabla"), "_total",
                      F.expr(f"stack({len(cols)}, {pairs}) AS (columna, nulos)")) \
        .withColumnRenamed("_total", "total")


def assert_domain(df: DataFrame, entity: Entity, table: str = "") -> DataFrame:
    """Q3: declared domain and minimum violations per column (one pass)."""
    checks: list[tuple[str, str, Column]] = []
    for c in entity.columns:
        if c.name not in df.columns:
            continue
        if c.domain:
            checks.append((c.name, "domain", F.count_if(F.col(c.name).isNotNull() & ~F.col(c.name).isin(*c.domain))))
        if c.min is not None:
            checks.append((c.name, "min", F.count_if(F.col(c.name) < F.lit(c.min))))
    agg = df.agg(*[e.alias(f"c{i}") for i, (_, _, e) in enumerate(checks)])
    pairs = ", ".join(f"'{n}', '{k}', c{i}" for i, (n, k, _) in enumerate(checks))
    return agg.select(F.lit(table).alias("tabla"),
                      F.expr(f"stack({len(checks)}, {pairs}) AS (columna, regla, violaciones)"))


def quality_report(unique: DataFrame, non_null: DataFrame, domain: DataFrame, run_id: str, entity: str) -> DataFrame:
    """Q4: all checks as ``data_quality_results`` rows (check_id, run, entity, name, status, details)."""
    u = unique.agg(F.count("*").alias("v")).select(F.lit("unique_key").alias("check_name"),
                                                   F.col("v").cast("long").alias("violaciones"),
                                                   F.lit("duplicated keys").alias("detalle"))
    n = non_null.select(F.concat(F.lit("non_null:"), F.col("columna")).alias("check_name"),
                        F.col("nulos").cast("long").alias("violaciones"), F.lit("null values").alias("detalle"))
    d = domain.select(F.concat(F.lit("domain:"), F.col("columna"), F.lit(":"), F.col("regla")).alias("check_name"),
                      F.col("violaciones").cast("long").alias("violaciones"), F.lit("out of domain").alias("detalle"))
    allc = reduce(DataFrame.unionByName, [u, n, d])
    return allc.select(
        F.sha2(F.concat_ws("|", F.lit(run_id), F.lit(entity), F.col("check_name")), 256).alias("check_id"),
        F.lit(run_id).alias("run_id"), F.lit(entity).alias("entity"), "check_name",
        F.when(F.col("violaciones") == 0, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"),
        F.concat(F.col("violaciones").cast("string"), F.lit(" "), F.col("detalle")).alias("details"),
    )


def profile(df: DataFrame, col: str, by: list[str] | None = None) -> DataFrame:
    """Q5: total rows, NULL count and min/max of one column (optionally per group)."""
    aggs = [F.count("*").alias("total"), F.count_if(F.col(col).isNull()).alias("nulos"),
            F.min(col).alias("minimo"), F.max(col).alias("maximo")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


# --- Fixed values: result criteria kinds ------------------------------------
CRITERIA = ("ExactNumeric", "NonZeroNumeric", "PercentageRange", "RowCountExact", "RowCountMinimum", "NonNegativeNumeric")
# ---------------------------------------------------------------------------


def check_results(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Q6: check result values against expectations.

    ``actual``: (case_id, value double, row_count long).
    ``expected``: (case_id, criterion, target double, abs_tol double, rel_tol double, lo double, hi double).
    ``lo`` and ``hi`` are the least value of NonZeroNumeric (exclusive, default 0), the range of PercentageRange (default 0 to
    1) and the row counts of RowCountExact (``hi`` defaults to ``lo``; without either, ``target``). One row per expectation
    with ok flag and detail; a case without result fails.
    """
    x = expected.join(actual, "case_id", "left")
    v, t = F.col("value"), F.col("target")
    tol = F.greatest(F.coalesce(F.col("abs_tol"), F.lit(0.0)), F.coalesce(F.col("rel_tol"), F.lit(0.0)) * F.abs(t))
    c = F.col("criterion")
    ok = (F.when(c == "ExactNumeric", F.abs(v - t) <= tol)
           .when(c == "NonZeroNumeric", v > F.coalesce(F.col("lo"), F.lit(0.0)))
           .when(c == "PercentageRange", v.between(F.coalesce(F.col("lo"), F.lit(0.0)), F.coalesce(F.col("hi"), F.lit(1.0))))
           .when(c == "RowCountExact", F.col("row_count").between(F.coalesce("lo", t), F.coalesce("hi", "lo", t)))
           .when(c == "RowCountMinimum", F.col("row_count") >= F.coalesce(t, F.lit(1.0)))
           .when(c == "NonNegativeNumeric", v >= 0)
           .otherwise(F.lit(False)))
    ok = F.coalesce(ok, F.lit(False))
    detail = F.concat_ws(" ", c, F.lit("value="), F.coalesce(v.cast("string"), F.lit("NULL")),
                         F.lit("rows="), F.coalesce(F.col("row_count").cast("string"), F.lit("NULL")))
    return x.select("case_id", "criterion", ok.alias("ok"), detail.alias("detail"))
