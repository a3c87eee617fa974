"""Silver layer: contract-driven cleaning, required-column split, dedup.

P7 contract_clean, R1 valid_rows, R2 rejected_rows, D1/D2 latest_by_key,
D3 last_per_day, D4 snapshot_dedup, M1 silver_master, M2 silver_transaction,
M3 silver_sales, U1 union_versions.

Dedup is a ``row_number() == 1`` window: Spark plans it as a partial
``WindowGroupLimit`` before the shuffle, so even a key holding a large share of
the rows is cut to one row per map partition before it is exchanged.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..contracts import SALES, SALES_PRIORITY, Entity
from ..functions.columns import clean_str, first_nonblank, to_num, to_ts
from ..functions.hashing import packed_hash, unpacked_hash

TIE_BREAK = "_row_hash"


def _present(df: DataFrame, cols) -> list[str]:
    return [c for c in cols if c in df.columns]


def required_ok(entity: Entity, col: str) -> Column:
    """A required value is present: strings non-blank after trimming, numbers non-null."""
    spec = entity.col(col)
    if spec.type in ("number", "integer", "boolean"):
        return F.col(col).isNotNull()
    return F.col(col).isNotNull() & (clean_str(col) != F.lit(""))


def _checked_required(entity: Entity) -> list[str]:
    # A required column with a declared default is filled in Silver, not rejected.
    return [c.name for c in entity.columns if c.required and c.default is None]


def valid_condition(entity: Entity) -> Column:
    conds = [required_ok(entity, c) for c in _checked_required(entity)]
    return reduce(lambda a, b: a & b, conds, F.lit(True))


def valid_rows(df: DataFrame, entity: Entity) -> DataFrame:
    """Rows whose required columns are all present."""
    return df.filter(valid_condition(entity))


def rejection_reason(entity: Entity) -> Column:
    """Comma list (in contract order) of the required columns that fail."""
    flags = [F.when(~required_ok(entity, c), F.lit(c)) for c in _checked_required(entity)]
    return F.array_join(F.array_compact(F.array(*flags)), ", ")


def rejected_rows(df: DataFrame, entity: Entity, rejected_at: Column | str | None = None) -> DataFrame:
    """R2: complement of R1 with ``motivo_rechazo`` and the rejection time."""
    ts = F.lit(rejected_at).cast("timestamp") if isinstance(rejected_at, str) else rejected_at
    out = df.filter(~valid_condition(entity)).withColumn("motivo_rechazo", rejection_reason(entity))
    if ts is not None:
        out = out.withColumn("_rechazado_en", ts)
    return out


def clean_expr(entity: Entity, name: str) -> Column:
    spec = entity.col(name)
    if spec.type in ("number", "integer"):
        e = to_num(name)
    elif spec.type == "timestamp":
        e = to_ts(name)
    elif spec.type == "boolean":
        e = F.col(name)
    else:
        e = clean_str(name)
        if spec.default is not None:
            e = F.coalesce(F.nullif(e, F.lit("")), F.lit(spec.default))
    return e.alias(name)


def contract_clean(df: DataFrame, entity: Entity, keep: list[str] | None = None, later: Sequence[str] = ()) -> DataFrame:
    """Every contract column typed and cleaned by its declared type; extra columns kept as is, and those of ``later`` too."""
    keep = keep if keep is not None else [c for c in df.columns if c not in entity.names]
    return df.select(*[F.col(c) for c in keep], *[F.col(n) if n in later else clean_expr(entity, n) for n in entity.names if n in df.columns])


def late_numbers(df: DataFrame, entity: Entity) -> list[str]:
    """Number columns of ``df`` outside the key. A landed number takes 8 bytes and a Silver decimal 24, so a plan that shuffles the rows
    cleans these after its last shuffle (cleaning one again changes nothing)."""
    return [c.name for c in entity.columns if c.type in ("number", "integer") and c.name not in entity.key and c.name in df.columns]


def latest_by_key(df: DataFrame, keys: list[str], order: list[Column | str] | None = None,
                  tie_break: str | None = TIE_BREAK, unpack: bool = True) -> DataFrame:
    """Newest row per key; ``order`` is most-significant first, all descending.

    A final tie-break on the row hash (or on every other column) keeps the choice
    deterministic when the ordering columns tie inside a batch. A text hash goes through the shuffle as bytes,
    and stays so (see ``packed_hash``) without ``unpack``.
    """
    packed = bool(tie_break) and tie_break not in keys and dict(df.dtypes).get(tie_break) == "string"
    if packed:
        df = df.withColumn(tie_break, packed_hash(tie_break))
    order = [F.col(o) if isinstance(o, str) else o for o in (order or [F.col("_ingested_at")])]
    if tie_break and tie_break in df.columns:
        ties = [F.col(tie_break)]
    else:
        ties = [F.col(c) for c in df.columns if c not in keys]
    w = Window.partitionBy(*keys).orderBy(*[o.desc_nulls_last() for o in order], *[t.desc_nulls_last() for t in ties])
    out = df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
    return out.withColumn(tie_break, unpacked_hash(tie_break)) if packed and unpack else out


def last_per_day(df: DataFrame, keys: list[str], ts: str, day_col: str = "dia") -> DataFrame:
    """D3: last row per key and calendar day of ``ts``."""
    return latest_by_key(df.withColumn(day_col, F.to_date(ts)), [*keys, day_col], [F.col(ts)])


def silver_master(staging: DataFrame, entity: Entity, rejected_at: str | None = None) -> tuple[DataFrame, DataFrame]:
    """M1: (current master, rejects) = R1 split -> P7 clean -> D1 on the cleaned key."""
    audit = _present(staging, ["source_empresa", "_ingested_at", TIE_BREAK])
    good = contract_clean(valid_rows(staging, entity), entity, keep=audit)
    current = latest_by_key(good, entity.key, ["_ingested_at"])
    return current, rejected_rows(staging, entity, rejected_at)


def silver_transaction(staging: DataFrame, entity: Entity, rejected_at: str | None = None) -> tuple[DataFrame, DataFrame]:
    """M2: transactional table (stock, rates, price changes): M1 plus ``fecha_registro``."""
    cur, rej = silver_master(staging, entity, rejected_at)
    if "registro" in cur.columns:
        cur = cur.withColumn("fecha_registro", F.to_date("registro"))
    return cur, rej


def union_versions(parts: list[tuple[DataFrame, int]], priority_col: str = "_priority") -> DataFrame:
    """UNION ALL of schema versions, missing columns padded with typed NULLs, tagged with priority."""
    tagged = [df.withColumn(priority_col, F.lit(p)) for df, p in parts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def silver_sales(versions: dict[str, DataFrame] | DataFrame, articles: DataFrame,
                 rejected_at: str | None = None) -> tuple[DataFrame, DataFrame]:
    """M3: sales lines from the v3 + v2 + legacy contracts.

    U1 union -> R1 split (rejects come from the whole union) -> P7 clean with the
    widest contract -> D2 dedup (contract priority, then recency, then row hash)
    -> supplier code from the line, else from the current article.
    """
    current, rejects = current_sales(versions, rejected_at)
    return with_article_supplier(current, articles), rejects


def current_sales(versions: dict[str, DataFrame] | DataFrame, rejected_at: str | None = None) -> tuple[DataFrame, DataFrame]:
    """M3 up to its dedup: (one line per key, rejects). Where rows have a hash, it is packed and numbers outside the key are still as landed."""
    entity = SALES["v2"]  # superset of the three contracts' business columns
    if isinstance(versions, DataFrame):  # already one relation tagged with ``_priority``
        union = versions
    else:
        union = union_versions([(df, SALES_PRIORITY[v]) for v, df in versions.items()])
    audit = _present(union, ["source_empresa", "_ingested_at", TIE_BREAK, "_priority"])
    later = late_numbers(union, entity) if TIE_BREAK in union.columns else ()  # without a hash, ties are broken by cleaned values
    good = contract_clean(valid_rows(union, entity), entity, keep=audit, later=later)
    return latest_by_key(good, entity.key, ["_priority", "_ingested_at"], unpack=False), rejected_rows(union, entity, rejected_at)


def with_article_supplier(current: DataFrame, articles: DataFrame) -> DataFrame:
    """M3's last step: supplier code from the line, else from the current article; then ``finished_sales``."""
    art = articles.select("source_empresa", "cod_art", F.col("cod_pro").alias("_art_cod_pro"))
    # one article row per key (Silver articles are unique), so the left join keeps the line grain
    return finished_sales(current.join(art, ["source_empresa", "cod_art"], "left")
                                 .withColumn("cod_pro", first_nonblank("cod_pro", "_art_cod_pro"))
                                 .drop("_art_cod_pro"))


def finished_numbers(current: DataFrame) -> DataFrame:
    """Lines of ``current_sales`` with their numbers cleaned."""
    return current.withColumns({n: clean_expr(SALES["v2"], n) for n in late_numbers(current, SALES["v2"])})


def finished_sales(current: DataFrame) -> DataFrame:
    """Lines of ``current_sales`` as Silver has them: numbers cleaned, hash as text, day of the line."""
    packed = dict(current.dtypes).get(TIE_BREAK) == "binary"
    done = finished_numbers(current).withColumn("fecha_registro", F.to_date("registro"))
    return done.withColumn(TIE_BREAK, unpacked_hash(TIE_BREAK)) if packed else done


def snapshot_dedup(hist: DataFrame, keys=("source_empresa", "snapshot_date", "run_id", "cod_alm", "cod_art"),
                   qty: str = "exi_act1") -> DataFrame:
    """One stock row per (tenant, snapshot day, run, warehouse, article); blank keys and
    non-numeric quantities dropped."""
    cleaned = hist.withColumn("cod_alm", clean_str("cod_alm")).withColumn("cod_art", clean_str("cod_art")) \
        .withColumn(qty, to_num(qty))
    cleaned = cleaned.filter((F.col("cod_alm") != "") & (F.col("cod_art") != "") & F.col(qty).isNotNull())
    return latest_by_key(cleaned, list(keys), ["_ingested_at"])


def silver_clientes(staging: DataFrame, entity: Entity, rejected_at: str | None = None) -> tuple[DataFrame, DataFrame]:
    """M1 for customers: the generic master plus parsed GPS (P8) and its classification."""
    from ..functions.columns import gps_lat_lon, gps_status

    cur, rej = silver_master(staging, entity, rejected_at)
    lat, lon = gps_lat_lon("gps")
    cur = cur.withColumns({"latitud": lat, "longitud": lon})
    valid, state = gps_status("latitud", "longitud")
    return cur.withColumns({"gps_valido": valid, "gps_estado": state}), rej


def unpivot(df: DataFrame, keys: list[str], columns: list[str] | None = None) -> DataFrame:
    """One row per row of ``df`` and column: the keys, ``columna``, ``texto`` and ``numero``. Tables of different columns can then be
    stacked and checked as one; timestamps become text."""
    types = dict(df.dtypes)
    columns = [c for c in df.columns if c not in keys] if columns is None else columns
    number = lambda t: t.startswith("decimal") or t in ("double", "float", "int", "bigint")
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") if types[c].startswith(("timestamp", "date")) else F.col(c).cast("string")
    cells = F.array(*[F.struct(F.lit(c).alias("columna"), (F.lit(None).cast("string") if number(types[c]) else text(c)).alias("texto"),
                               (F.col(c).cast("double") if number(types[c]) else F.lit(None).cast("double")).alias("numero")) for c in columns])
    return df.select(*keys, F.explode(cells).alias("_cell")).select(*keys, "_cell.*")
