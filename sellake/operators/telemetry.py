"""Telemetry tables (L1-L4): JSON event lines, incident filter, deterministic sampling,
typed attributes, latency summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SUCCESS = "SUCCESS"
# --- Fixed values ---------------------------------------------------------------
SLOW_MS = 10000
DEFAULT_SUCCESS_PCT = 10
HASH_MULT = 2654435761      # multiplicative hash constant (Knuth) for sampling buckets
HASH_MOD = 4294967296
# ---------------------------------------------------------------------------------

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("event_name", T.StringType()),
    T.StructField("request_id", T.StringType()), T.StructField("subject", T.StringType()),
    T.StructField("status", T.StringType()), T.StructField("duration_ms", T.DoubleType()),
    T.StructField("error_code", T.StringType()), T.StructField("ts", T.StringType()),
    T.StructField("attributes", T.StringType()),
])


def parse_event_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """JSON event lines -> typed rows; lines that are not a JSON object are dropped
    (the DROPMALFORMED behaviour, without a driver-side pass)."""
    parsed = lines.select(F.from_json(F.col(col), EVENT_SCHEMA, {"mode": "PERMISSIVE"}).alias("e"),
                          F.col(col).alias("_raw"))
    ok = parsed.filter(F.col("e").isNotNull() & F.col("e.event_id").isNotNull())
    return ok.select("e.*")


def incidents(events: DataFrame, slow_ms: float = SLOW_MS) -> DataFrame:
    """L1: failures or slow calls."""
    return events.filter((F.col("status") != SUCCESS) | (F.col("duration_ms") > slow_ms))


def sample_bucket(id_col: str = "event_id"):
    """(id * HASH_MULT mod 2**32) mod 100, by halves of the id's low 32 bits, so no product overflows."""
    low = F.pmod(F.col(id_col), F.lit(HASH_MOD))
    top = F.pmod(F.shiftright(low, 16) * F.lit(HASH_MULT), F.lit(HASH_MOD)) * F.lit(65536)
    return F.pmod(F.pmod(top + low.bitwiseAND(65535) * F.lit(HASH_MULT), F.lit(HASH_MOD)), F.lit(100))


def sample_success(events: DataFrame, pct: float = DEFAULT_SUCCESS_PCT) -> DataFrame:
    """L2: every failure, and ``pct`` % of successes chosen by a hash bucket of the event id
    (deterministic, so reruns keep the same sample). ``pct`` is clamped to 0..100."""
    p = max(0.0, min(100.0, float(pct)))
    return events.filter((F.col("status") != SUCCESS) | (sample_bucket() < F.lit(p)))


def typed_attributes(events: DataFrame, col: str = "attributes") -> DataFrame:
    """L3: attributes JSON -> long rows ``<name>_d`` (numbers) / ``<name>_s`` (text);
    booleans and nulls dropped. Types come from the JSON itself (VARIANT)."""
    kv = events.select("event_id", F.explode(F.from_json(F.col(col), "map<string,variant>")).alias("k", "v"))
    t = F.schema_of_variant("v")
    numeric = t.rlike("^(BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL.*)$")
    text = t == "STRING"
    kv = kv.filter(numeric | text)
    return kv.select(
        "event_id",
        F.concat(F.col("k"), F.when(numeric, F.lit("_d")).otherwise(F.lit("_s"))).alias("atributo"),
        F.when(numeric, F.expr("try_variant_get(v, '$', 'double')")).alias("valor_d"),
        F.when(text, F.expr("try_variant_get(v, '$', 'string')")).alias("valor_s"),
    )


def latency_summary(events: DataFrame, by: list[str]) -> DataFrame:
    """L4: pass count, total and exact P95 latency (linear interpolation) per group.

    In two steps, so that no group's values meet in one buffer: counts per millisecond find the one or two milliseconds
    that hold the rank, and only values in those are counted one by one.
    """
    totals = events.groupBy(*by).agg(F.count("*").alias("total"), F.count_if(F.col("status") == SUCCESS).alias("pass"))
    timed = events.where(F.col("duration_ms").isNotNull()).select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(by)], "duration_ms", F.floor("duration_ms").alias("_ms"))
    keys = [f"_k{i}" for i in range(len(by))]
    in_order = lambda c: Window.partitionBy(*keys).orderBy(c)
    ms = timed.groupBy(*keys, "_ms").agg(F.count("*").alias("_n"))
    ms = ms.withColumn("_upto", F.sum("_n").over(in_order("_ms"))).withColumn("_all", F.sum("_n").over(Window.partitionBy(*keys)))
    rank = F.lit(0.95) * (F.col("_all") - 1)
    ms = ms.withColumns({"_lo": F.floor(rank), "_hi": F.ceil(rank), "_part": rank - F.floor(rank)})
    ms = ms.where((F.col("_upto") > F.col("_lo")) & (F.col("_upto") - F.col("_n") <= F.col("_hi")))
    target = ms.select(*[F.col(k).alias(f"{k}t") for k in keys], F.col("_ms").alias("_mst"), (F.col("_upto") - F.col("_n")).alias("_before"), "_lo", "_hi", "_part")
    same = (F.col("_ms") == F.col("_mst"))
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"{k}t"))
    values = timed.join(target, same).groupBy(*keys, "duration_ms", "_before", "_lo", "_hi", "_part").agg(F.count("*").alias("_n"))
    values = values.withColumn("_upto", F.min("_before").over(Window.partitionBy(*keys)) + F.sum("_n").over(in_order("duration_ms")))
    at = lambda r: F.min(F.when(F.col("_upto") > F.col(r), F.col("duration_ms")))
    p95 = values.groupBy(*keys).agg(F.round(at("_lo") + (at("_hi") - at("_lo")) * F.min("_part"), 3).alias("p95_ms"))
    both = F.lit(True)
    for k, c in zip(keys, by):
        both = both & F.col(c).eqNullSafe(F.col(k))
    return totals.join(p95, both, "left").select(*by, "total", "pass", "p95_ms")
