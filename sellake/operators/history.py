"""History and temporal joins: S8 merge, T1 master history, T2 SCD2 versions,
T3 typed SCD2 dimensions, T4/T5/T6 as-of resolution, T7 SCD2 sales fact,
T8 reconciled view, T9-T11 snapshot facts.

As-of resolution without a version fan-out: lines and versions are stacked into one
timeline per key and month, and each line takes the last version before it (see ``resolve``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import clean_str
from ..functions.hashing import packed_hash, unpacked_hash
from .silver import latest_by_key

TENANT = "source_empresa"
UNKNOWN = "UNKNOWN"
# --- Fixed values: resolution labels ------------------------------------------
RESOLVED = "RESOLVED_SCD2"
BACKFILL = "CURRENT_MASTER_BACKFILL"
UNRESOLVED = "UNKNOWN_UNRESOLVED"
INFERRED = "INFERRED_FROM_FACT"
LEGACY_BACKFILL = "LEGACY_FACT_BACKFILL"
LEGACY_SOURCE = "PRODUCTION_LEGACY_HISTORY"
SCD2_SOURCE = "SCD2_OPERATIONAL"
# -------------------------------------------------------------------------------


def merge_by_key(old: DataFrame | None, new: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Upsert ``new`` into the accumulating table ``old`` by unique key.

    Old keys never disappear; for a key in both, the newest row (by ``order``,
    then row hash) wins. Idempotent: merging the same batch twice changes nothing.
    """
    if old is None:
        return latest_by_key(new, keys, order)
    u = old.unionByName(new, allowMissingColumns=True)
    return latest_by_key(u, keys, order)


def stack_history(sources: dict[str, tuple[DataFrame, str, list[str]]]) -> DataFrame:
    """Several master snapshots -> one long history table.

    ``sources``: entity -> (staging df, natural key column, business columns).
    Each row: (entity_name, tenant, natural_key, snapshot_date, run_id, ingested_at,
    record_hash, record_json) with the business columns trimmed into JSON
    (NULL fields kept).
    """
    parts = []
    for entity, (df, key, cols) in sources.items():
        types = dict(df.dtypes)
        rec = F.to_json(F.struct(*[clean_str(c).alias(c) if types[c] == "string" else F.col(c) for c in cols]),
                        {"ignoreNullFields": "false"})
        parts.append(df.filter(F.col("_ingested_at").isNotNull()).select(
            F.lit(entity).alias("entity_name"), F.trim(F.col(TENANT)).alias(TENANT),
            F.trim(F.col(key).cast("string")).alias("natural_key"),
            F.to_date("_ingested_at").alias("snapshot_date"),
            F.coalesce(F.col("_run_id"), F.date_format("_ingested_at", "yyyyMMddHHmmss")).alias("run_id")
            if "_run_id" in df.columns else F.date_format("_ingested_at", "yyyyMMddHHmmss").alias("run_id"),
            F.col("_ingested_at").alias("ingested_at"),
            F.col("_row_hash").alias("record_hash"),
            rec.alias("record_json")))
    return reduce(DataFrame.unionByName, parts)


def scd2(history: DataFrame, keys=("entity_name", TENANT, "natural_key"), ts: str = "ingested_at",
         hash_col: str = "record_hash") -> DataFrame:
    """SCD2 versions: exact repeats dropped, a version starts where the hash changes
    (A->B->A gives three versions), closed by the next version's start.

    Ordering inside a key is (time, run, hash) so equal timestamps are resolved
    deterministically. Deleted keys stay current (no delete detection).
    """
    keys = list(keys)
    dedup = latest_by_key(history, [*keys, ts, hash_col], ["run_id"], tie_break=None)
    w = Window.partitionBy(*keys).orderBy(F.col(ts), F.col("run_id"), F.col(hash_col))
    changes = dedup.withColumn("_prev", F.lag(hash_col).over(w)) \
        .filter(F.col("_prev").isNull() | (F.col("_prev") != F.col(hash_col)))
    versions = changes.withColumn("valid_to", F.lead(ts).over(w))
    sk = F.sha2(F.concat_ws("|", F.col("entity_name"), F.col(TENANT), F.col("natural_key"),
                            F.col(ts).cast("string"), F.col(hash_col)), 256)
    return versions.select(
        sk.alias("surrogate_key"), "entity_name", TENANT, "natural_key", F.col(ts).alias("valid_from"), "valid_to",
        F.col("valid_to").isNull().alias("is_current"), "snapshot_date", "run_id", hash_col, "record_json")


def refresh_versions(versions: DataFrame, history: DataFrame, batch: DataFrame, keys=("entity_name", TENANT, "natural_key")) -> DataFrame:
    """T2 kept up: ``versions`` after ``batch`` (rows of the history, of any age) has come to ``history``, which holds it.

    Only keys of the batch are looked at again, so the cost follows the batch and not the masters. A newer snapshot closes the open
    version, an older one splits a closed interval or starts an earlier one, a repeat changes nothing; versions do not depend on
    the order in which batches arrive. (Versions alone are not enough for that: a late row may fall between two sightings
    of what was one version.)
    """
    keys = list(keys)
    touched = batch.select(*keys).distinct()
    again = scd2(history.join(touched, keys, "left_semi"), keys)
    return versions.join(touched, keys, "left_anti").select(*again.columns).unionByName(again)


def scd2_dim(versions: DataFrame, entity: str, code_col: str, attrs: list[str]) -> DataFrame:
    """Typed view of one entity's versions: JSON parsed once (``from_json``), attributes as columns."""
    schema = ", ".join(f"`{a}` STRING" for a in attrs)
    v = versions.filter(F.col("entity_name") == entity)
    parsed = v.withColumn("_r", F.from_json("record_json", schema))
    return parsed.select("surrogate_key", TENANT, F.col("natural_key").alias(code_col), "valid_from", "valid_to",
                         "is_current", "run_id", "record_hash", *[F.col(f"_r.`{a}`").alias(a) for a in attrs])


def _versions(dims: dict[str, tuple[DataFrame, str, str, list[str]]]) -> DataFrame:
    """Versions of all dimensions, stacked: (dim, tenant, code, time of start, run, hash, sk, is_current, extras)."""
    parts = [dim.where(F.col(code).isNotNull() & F.col(TENANT).isNotNull()).select(
        F.lit(name).alias("dim"), F.col(TENANT), F.col(code).cast("string").alias("code"), F.col("valid_from").alias("at"), "run_id", "record_hash",
        packed_hash("surrogate_key").alias("sk"), "is_current", F.array(*[F.col(c).cast("string") for c in extra]).cast("array<string>").alias("extras"))
        for name, (dim, _, code, extra) in dims.items()]
    return reduce(DataFrame.unionByName, parts)


def resolve(fact: DataFrame, dims: dict[str, tuple[DataFrame, str, str, list[str]]], t: str, rid: str) -> DataFrame:
    """T4 + T5 + T6: every dimension of ``fact`` resolved as of ``t``, in one pass over one stacked timeline.

    ``dims``: name -> (typed SCD2 dim, fact code column, dim code column, current attributes); ``rid``: a unique column of ``fact``.
    Adds per dimension ``{name}_sk_asof`` (version with valid_from <= t < valid_to), ``{name}_sk`` (that, else the current version,
    else UNKNOWN), ``{name}_resolution_status`` and ``current_<attribute>`` (of the current version), and the overall
    ``is_inferred`` and ``resolution_status``. A NULL code or tenant resolves to UNKNOWN, a NULL time to the current version.

    The codes of a line are stacked, so all dimensions share each step. A version in force is first carried to the start of those
    months in which its key has lines; then lines, carried versions and versions that start within the month are put in order
    of time and each line takes the last version before it. A task orders one month of a key, not all its lines, and the range
    condition of an as-of join (a fan-out of versions times lines) never arises.
    """
    keys = ["dim", TENANT, "code"]
    stacked = F.explode(F.array(*[F.struct(F.lit(n).alias("dim"), F.col(c).cast("string").alias("code")) for n, (_, c, _, _) in dims.items()]))
    lines = fact.select(F.col(rid).alias("rid"), TENANT, F.col(t).cast("timestamp").alias("at"), stacked.alias("c")).select(
        "rid", TENANT, "at", F.trunc("at", "month").alias("month"), "c.dim", "c.code").where(F.col("code").isNotNull() & F.col(TENANT).isNotNull())
    versions = _versions(dims).withColumn("at", F.col("at").cast("timestamp"))
    marks = lines.select(*keys, "month").distinct().withColumns({"at": F.col("month").cast("timestamp"), "mark": F.lit(True)})
    whole = Window.partitionBy(*keys)
    so_far = whole.orderBy(F.col("at").asc_nulls_first(), F.col("mark").asc_nulls_first(), "run_id", "record_hash").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = versions.unionByName(marks, allowMissingColumns=True).withColumns({
        "sk": F.last("sk", ignorenulls=True).over(so_far), "now": F.max(F.when(F.col("is_current"), F.struct("at", "sk", "extras"))).over(whole)})
    carried = known.where("mark").select(*keys, "month", "at", F.lit(0).alias("kind"), "sk", "now")
    started = versions.select(*keys, F.trunc("at", "month").alias("month"), "at", F.lit(1).alias("kind"), "run_id", "record_hash", "sk")
    timeline = carried.unionByName(started, allowMissingColumns=True).unionByName(lines.withColumn("kind", F.lit(2)), allowMissingColumns=True)
    before = Window.partitionBy(*keys, "month").orderBy(F.col("at").asc_nulls_first(), "kind", "run_id", "record_hash").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = timeline.select("rid", "dim", F.last("sk", ignorenulls=True).over(before).alias("asof"), F.last("now", ignorenulls=True).over(before).alias("now")).where("rid is not null")
    # most versions met are the current one: its key goes on once
    met = met.select("rid", "dim", "asof", F.when(F.col("now").isNotNull(), F.struct(F.when(~F.col("now.sk").eqNullSafe(F.col("asof")), F.col("now.sk")).alias("sk"), "now.extras")).alias("now"))
    of = lambda n, c: F.max(F.when(F.col("dim") == n, F.col(c)))
    wide = met.groupBy("rid").agg(*[x for n in dims for x in (of(n, "asof").alias(f"_{n}_asof"), of(n, "now").alias(f"_{n}_now"))])
    out = fact.join(wide.withColumnRenamed("rid", rid), rid, "left")
    added, missing, backfilled = {}, [], []
    for n, (_, _, _, extra) in dims.items():
        asof, now = F.col(f"_{n}_asof"), F.coalesce(f"_{n}_now.sk", f"_{n}_asof")
        added |= {f"{n}_sk_asof": unpacked_hash(asof), f"{n}_sk": F.coalesce(unpacked_hash(F.coalesce(asof, now)), F.lit(UNKNOWN)),
                  f"{n}_resolution_status": F.when(asof.isNotNull(), F.lit(RESOLVED)).when(now.isNotNull(), F.lit(BACKFILL)).otherwise(F.lit(UNRESOLVED))}
        added |= {f"current_{c}": F.get(F.col(f"_{n}_now.extras"), F.lit(i)) for i, c in enumerate(extra)}
        missing.append(asof.isNull())
        backfilled.append(asof.isNull() & now.isNotNull())
    any_missing, any_backfill = reduce(Column.__or__, missing), reduce(Column.__or__, backfilled)
    added |= {"is_inferred": any_missing, "resolution_status": F.when(any_backfill, F.lit(BACKFILL)).when(any_missing, F.lit(INFERRED)).otherwise(F.lit(RESOLVED))}
    return out.withColumns(added).drop(*[f"_{n}_{x}" for n in dims for x in ("asof", "now")])


def reconcile(df: DataFrame, cutover: str, t: str = "registro") -> DataFrame:
    """Before the cutover, current-master backfills are legacy history; after it, SCD2 operational."""
    before = F.to_date(t) < F.lit(cutover).cast("date")
    return df.withColumns({
        "scd_cutover_date": F.lit(cutover).cast("date"),
        "reconciliation_status": F.when(before & (F.col("resolution_status") == BACKFILL), F.lit(LEGACY_BACKFILL))
                                  .otherwise(F.col("resolution_status")),
        "resolution_source": F.when(before, F.lit(LEGACY_SOURCE)).otherwise(F.lit(SCD2_SOURCE)),
    })


def fct_prices(changes: DataFrame, articles_scd2: DataFrame) -> DataFrame:
    """Price changes with the current article surrogate key, one row per (tenant, document, line)."""
    cur = articles_scd2.filter("is_current").select(TENANT, "cod_art", F.col("surrogate_key").alias("articulo_sk"))
    x = changes.join(cur, [TENANT, "cod_art"], "left")
    x = x.withColumn("articulo_sk", F.coalesce("articulo_sk", F.lit(UNKNOWN)))
    return latest_by_key(x, [TENANT, "documento", "renglon"], ["registro"])


def fct_rates(rates: DataFrame) -> DataFrame:
    """Currency rate fact."""
    return rates.select(TENANT, "cod_mon", "renglon", F.col("fecha_registro").alias("fecha"), "registro", "tasa")


def fct_inventory(hist: DataFrame) -> DataFrame:
    """Periodic inventory snapshot fact."""
    return hist.select(TENANT, "snapshot_date", "run_id", F.col("cod_alm").alias("codigo_almacen"),
                       F.col("cod_art").alias("codigo_articulo"), F.col("exi_act1").alias("unidades"))
