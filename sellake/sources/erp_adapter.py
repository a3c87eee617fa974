"""Driver tables -> ERP-shaped staging tables (the stand-in landing input).

This module only gives rows in the schema the ERP jobs expect (tenants, masters,
sales source lines, stock snapshots, rates, master snapshots); it does none of
the jobs' work. Every rule below is a plain column mapping; the dirty rows it
injects (padding, blanks, unparseable text) exist so that the cleaning and
reject operators have something to catch.

Scale notes: the only broadcast sides are ``region`` and ``nation`` (fixed, 5
and 25 rows). Everything that grows with the data (orders, customers, parts,
suppliers) joins by key and is left to AQE, which converts a join to broadcast
only from measured runtime sizes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import ALL, SALES
from ..operators.facts import erp_sales_lines
from ..functions.hashing import with_row_hash
from .tables import read_table

# --- Fixed values of the adapter (stand-in input rules) ---------------------
MASTER_SNAPSHOT_TS = "2001-08-01 06:00:00"   # one master snapshot landed after the last order
DIRTY_MOD = 97          # key % 97 == 0 -> a required value is blank (goes to rejects)
PAD_MOD = 7             # key % 7 == 0 -> the key arrives padded with spaces
NO_UNIT_MOD = 11        # part % 11 == 0 -> unit code missing (Silver default applies)
ZERO_BOX_MOD = 53       # part % 53 == 0 -> bulk capacity 0
SELLERS_PER_TENANT = 20
FISCAL_IDS = 1000
BLANK_RIF_MOD = 50
V3_FROM = "1999-01-01"      # v3 contract lines: orders from this day
V2_FROM, V2_TO = "1997-01-01", "2000-01-01"
LEGACY_TO = "1997-07-01"
RATE_TENANTS = 5
TS_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSS"   # .NET text with 7 fractional digits
# ---------------------------------------------------------------------------


def _ts_text(c: Column) -> Column:
    return F.date_format(c, TS_TEXT)


def _pad(c: Column) -> Column:
    """Right-padded text, as the ERP sends CHAR columns."""
    return F.concat(c, F.lit("  "))


def tenants(spark: SparkSession, d: str) -> DataFrame:
    """One tenant per region: ``source_empresa = lower(replace(r_name, ' ', '_'))``."""
    r = read_table(spark, d, "region", ["r_regionkey", "r_name"])
    return r.select("r_regionkey", F.lower(F.replace(F.col("r_name"), F.lit(" "), F.lit("_"))).alias("source_empresa"),
                    F.col("r_name").alias("nombre_empresa"))


def nation_tenant(spark: SparkSession, d: str) -> DataFrame:
    n = read_table(spark, d, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    return n.join(F.broadcast(tenants(spark, d)), n.n_regionkey == F.col("r_regionkey")).drop("r_regionkey")


def _spread(df: DataFrame) -> DataFrame:
    """The rows of a master table, often one file and one task, dealt over all tasks before they multiply and are sorted."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _per_tenant(spark: SparkSession, d: str, df: DataFrame) -> DataFrame:
    """Every row once per tenant: explode the tenant key range (no cross join)."""
    t = tenants(spark, d)
    hi = t.select(F.max("r_regionkey")).scalar()
    lo = t.select(F.min("r_regionkey")).scalar()
    return df.withColumn("r_regionkey", F.explode(F.sequence(lo, hi))).join(F.broadcast(t), "r_regionkey")


def _landed(df: DataFrame, entity_name: str, ingested_at: Column) -> DataFrame:
    """Attach the audit columns the Silver jobs read: tenant, ingest time and row hash."""
    e = ALL[entity_name]
    cols = [c for c in e.names if c in df.columns]
    out = df.select("source_empresa", *cols)
    out = with_row_hash(out, cols)
    return out.withColumn("_ingested_at", ingested_at)


def _snapshot_ts() -> Column:
    return F.lit(MASTER_SNAPSHOT_TS).cast("timestamp_ntz")


def stg_articulos(spark: SparkSession, d: str) -> DataFrame:
    p = read_table(spark, d, "part", ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"])
    nsupp = read_table(spark, d, "supplier", ["s_suppkey"]).select(F.count("*")).scalar()
    k = F.col("p_partkey")
    a = p.select(
        k.cast("string").alias("cod_art"),
        F.concat(F.lit("M-"), k.cast("string")).alias("modelo"),
        F.lpad(k.cast("string"), 13, "0").alias("codigo_barras"),
        F.when(k % DIRTY_MOD == 0, F.lit("")).otherwise(_pad(F.col("p_name"))).alias("nom_art"),
        F.col("p_type").alias("cod_dep"),
        (F.col("p_size") % 7).cast("string").alias("cod_sec"),
        F.col("p_brand").alias("cod_mar"),
        F.pmod(k, nsupp).cast("string").alias("cod_pro"),
        F.when(k % NO_UNIT_MOD == 0, F.lit(None).cast("string")).otherwise(F.lit("UND")).alias("cod_uni1"),
        (F.col("p_size") * F.lit(0.25)).cast("double").alias("peso"),
        (k % 13).cast("double").alias("fraccion"),
        F.when(k % ZERO_BOX_MOD == 0, F.lit(0.0)).otherwise(F.col("p_size").cast("double")).alias("cap_bulto"),
        F.lit(0.0).alias("gra_lic"),
        F.col("p_retailprice").alias("precio"),
        (F.col("p_retailprice") * F.lit(0.5)).alias("cos_ult1"),
        F.lit("1").alias("cod_imp"),
        F.lit("A").alias("status"),
        F.lit(None).cast("string").alias("fec_ini"),
    )
    return _landed(_per_tenant(spark, d, _spread(a)), "articulos", _snapshot_ts())


def stg_proveedores(spark: SparkSession, d: str) -> DataFrame:
    s = read_table(spark, d, "supplier", ["s_suppkey", "s_name", "s_nationkey"])
    a = s.select(
        F.col("s_suppkey").cast("string").alias("cod_pro"),
        _pad(F.col("s_name")).alias("nom_pro"),
        F.concat(F.lit("J-"), F.lpad(F.col("s_suppkey").cast("string"), 8, "0")).alias("rif"),
        F.lit(None).cast("string").alias("dir_fis"),
        F.lit("A").alias("status"),
    )
    return _landed(_per_tenant(spark, d, _spread(a)), "proveedores", _snapshot_ts())


def stg_almacenes(spark: SparkSession, d: str) -> DataFrame:
    s = read_table(spark, d, "supplier", ["s_suppkey", "s_name", "s_nationkey"])
    a = s.select(
        F.col("s_suppkey").cast("string").alias("cod_alm"),
        _pad(F.concat(F.lit("Almacen "), F.col("s_name"))).alias("nom_alm"),
        F.col("s_nationkey").cast("string").alias("cod_suc"),
        F.lit("A").alias("status"),
    )
    return _landed(_per_tenant(spark, d, _spread(a)), "almacenes", _snapshot_ts())


def _code_table(spark, d, expr: Column, code: str, name_prefix: str, entity: str) -> DataFrame:
    """Code tables (brands, departments, sections) = distinct codes of the part table, per tenant."""
    a = read_table(spark, d, "part").select(expr.alias(code)).distinct()
    a = a.select(F.col(code), _pad(F.concat(F.lit(name_prefix), F.col(code))).alias("nom_" + code[4:]),
                 F.lit("A").alias("status"))
    return _landed(_per_tenant(spark, d, a), entity, _snapshot_ts())


def stg_marcas(spark, d):
    return _code_table(spark, d, F.col("p_brand"), "cod_mar", "Marca ", "marcas")


def stg_departamentos(spark, d):
    return _code_table(spark, d, F.col("p_type"), "cod_dep", "Depto ", "departamentos")


def stg_secciones(spark, d):
    return _code_table(spark, d, (F.col("p_size") % 7).cast("string"), "cod_sec", "Seccion ", "secciones")


def stg_sucursales(spark: SparkSession, d: str) -> DataFrame:
    n = nation_tenant(spark, d)
    a = n.select("source_empresa", F.col("n_nationkey").cast("string").alias("cod_suc"),
                 _pad(F.concat(F.lit("Sucursal "), F.col("n_name"))).alias("nom_suc"),
                 F.lit(None).cast("string").alias("contacto"), F.lit("A").alias("status"))
    return _landed(a, "sucursales", _snapshot_ts())


def stg_estados(spark: SparkSession, d: str) -> DataFrame:
    n = nation_tenant(spark, d)
    a = n.select("source_empresa", F.col("n_nationkey").cast("string").alias("cod_est"),
                 _pad(F.col("n_name")).alias("nom_est"), F.lit("A").alias("status"))
    return _landed(a, "estados", _snapshot_ts())


def stg_ciudades(spark: SparkSession, d: str) -> DataFrame:
    n = nation_tenant(spark, d)
    a = n.select("source_empresa", F.col("n_nationkey").cast("string").alias("cod_ciu"),
                 _pad(F.concat(F.lit("Capital "), F.col("n_name"))).alias("nom_ciu"), F.lit("A").alias("status"))
    return _landed(a, "ciudades", _snapshot_ts())


def stg_paises(spark: SparkSession, d: str) -> DataFrame:
    n = nation_tenant(spark, d)
    a = n.select("source_empresa", F.col("n_nationkey").cast("string").alias("cod_pai"), _pad(F.col("n_name")).alias("nom_pai"), F.lit("A").alias("status"))
    return _landed(a, "paises", _snapshot_ts())


def stg_clases_clientes(spark: SparkSession, d: str) -> DataFrame:
    """Customer classes = market segments, per tenant; one of them is inactive."""
    a = read_table(spark, d, "customer", ["c_mktsegment"]).distinct()
    a = a.select(F.col("c_mktsegment").alias("cod_cla"), _pad(F.concat(F.lit("Clase "), F.lower("c_mktsegment"))).alias("nom_cla"),
                 F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("I")).otherwise(F.lit("A")).alias("status"))
    return _landed(_per_tenant(spark, d, a), "clases_clientes", _snapshot_ts())


def stg_conceptos(spark: SparkSession, d: str) -> DataFrame:
    """Concepts = order priorities, per tenant; the unspecified one comes without a name and is rejected."""
    a = read_table(spark, d, "orders", ["o_orderpriority"]).distinct()
    code = F.substring("o_orderpriority", 1, 1)
    a = a.select(code.alias("cod_con"), F.when(code == "4", F.lit("  ")).otherwise(_pad(F.substring("o_orderpriority", 3, 20))).alias("nom_con"), F.lit("A").alias("status"))
    return _landed(_per_tenant(spark, d, a), "conceptos", _snapshot_ts())


def stg_impuestos(spark: SparkSession, d: str) -> DataFrame:
    """Taxes = discount rates of the lines in whole percent, per tenant."""
    rate = F.round(F.col("l_discount") * 100).cast("int")
    a = read_table(spark, d, "lineitem", ["l_discount"]).select(rate.alias("r")).distinct()
    a = a.select(F.col("r").cast("string").alias("cod_imp"), _pad(F.concat(F.lit("IVA "), F.col("r").cast("string"), F.lit(" %"))).alias("nom_imp"),
                 F.col("r").cast("double").alias("por_imp1"), F.lit("A").alias("status"))
    return _landed(_per_tenant(spark, d, a), "impuestos", _snapshot_ts())


def _gps_text(k: Column, bal: Column) -> Column:
    """Free GPS text in the shapes the ERP holds (several separators, a spaced sign,
    points outside the country, junk, blank, NULL)."""
    lat = (F.lit(0.5) + F.pmod(k, 160) / F.lit(10)).cast("decimal(9,4)").cast("string")
    lon = (F.lit(-74.0) + F.pmod(F.abs(bal).cast("long"), 150) / F.lit(10)).cast("decimal(9,4)").cast("string")
    lon_abs = F.regexp_replace(lon, "^-", "")
    m = F.pmod(k, 9)
    return (F.when(m == 0, F.concat(lat, F.lit(", "), lon))
            .when(m == 1, F.concat(lat, F.lit(";"), lon))
            .when(m == 2, F.concat(lat, F.lit("/"), lon))
            .when(m == 3, F.concat(lat, F.lit(" "), lon))
            .when(m == 4, F.concat(lat, F.lit(", - "), lon_abs))
            .when(m == 5, F.concat(F.lit("+"), lat, F.lit(","), lon))
            .when(m == 6, F.lit("sin coordenadas"))
            .when(m == 7, F.lit(""))
            .otherwise(F.lit(None).cast("string")))


def stg_clientes(spark: SparkSession, d: str) -> DataFrame:
    c = _spread(read_table(spark, d, "customer", ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]))
    c = c.join(F.broadcast(nation_tenant(spark, d)), c.c_nationkey == F.col("n_nationkey"))
    k = F.col("c_custkey")
    nation = F.col("c_nationkey").cast("string")
    a = c.select(
        "source_empresa",
        k.cast("string").alias("cod_cli"),
        F.when(k % DIRTY_MOD == 0, F.lit("   ")).otherwise(_pad(F.col("c_name"))).alias("nom_cli"),
        F.when(k % BLANK_RIF_MOD == 0, F.lit(" ")).otherwise(
            F.concat(F.lit("J-"), F.pmod(k, FISCAL_IDS).cast("string"))).alias("rif"),
        _pad(F.concat(F.lit("Calle "), F.pmod(k, 500).cast("string"))).alias("dir_fis"),
        F.when(k % 5 == 0, F.lit("  ")).otherwise(F.concat(F.lit("Galpon "), F.pmod(k, 90).cast("string"))).alias("dir_exa"),
        F.element_at(F.array(F.lit("Ordinario"), F.lit("Especial"), F.lit("Formal")), (F.pmod(k, 3) + 1).cast("int")).alias("tip_con"),
        F.concat(F.lit("T"), F.pmod(k, 4).cast("string")).alias("tip_cli"),
        nation.alias("cod_pai"), nation.alias("cod_est"), nation.alias("cod_ciu"),
        _gps_text(k, F.col("c_acctbal")).alias("gps"),
        F.pmod(k, SELLERS_PER_TENANT).cast("string").alias("cod_ven"),
        F.col("c_mktsegment").alias("segmentacion1"),
        F.col("c_acctbal").alias("mon_sal"),
        nation.alias("cod_suc"),
        F.lit("A").alias("status"),
    )
    return _landed(a, "clientes", _snapshot_ts())


def stg_vendedores(spark: SparkSession, d: str) -> DataFrame:
    """Sellers = distinct seller codes assigned to the tenant's customers."""
    c = read_table(spark, d, "customer", ["c_custkey", "c_nationkey"])
    c = c.join(F.broadcast(nation_tenant(spark, d)), c.c_nationkey == F.col("n_nationkey"))
    s = c.select("source_empresa", F.pmod("c_custkey", SELLERS_PER_TENANT).cast("string").alias("cod_ven")).distinct()
    a = s.select("source_empresa", "cod_ven", _pad(F.concat(F.lit("Vendedor "), F.col("cod_ven"))).alias("nom_ven"),
                 F.concat(F.lit("Vendedor."), F.col("cod_ven"), F.lit("@"), F.col("source_empresa"), F.lit(".com")).alias("correo"),
                 F.lit("A").alias("status"))
    return _landed(a, "vendedores", _snapshot_ts())


def sales_source_lines(spark: SparkSession, d: str) -> DataFrame:
    """Invoice and return lines as the ERP holds them (positive amounts, header rate, discount %).

    orders ⋈ customer ⋈ nation first (the smaller side), then lineitem by order key.
    """
    o = read_table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    c = read_table(spark, d, "customer", ["c_custkey", "c_name", "c_nationkey"])
    hdr = o.join(c, o.o_custkey == c.c_custkey).join(F.broadcast(nation_tenant(spark, d)),
                                                    F.col("c_nationkey") == F.col("n_nationkey"))
    li = read_table(spark, d, "lineitem", ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                                           "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_shipdate"])
    x = li.join(hdr, li.l_orderkey == hdr.o_orderkey)
    net = F.col("l_extendedprice").cast("decimal(18,2)")
    return x.select(
        "source_empresa",
        F.when(F.col("l_returnflag") == "R", F.lit("Devolucion")).otherwise(F.lit("Factura")).alias("tipo_documento"),
        F.col("c_nationkey").cast("string").alias("cod_suc"),
        F.col("l_orderkey").cast("string").alias("documento"),
        F.col("l_linenumber").cast("double").alias("renglon"),
        F.col("o_orderdate").alias("fec_reg"),
        F.pmod("o_custkey", SELLERS_PER_TENANT).cast("string").alias("cod_ven"),
        F.col("o_custkey").cast("string").alias("cod_cli"),
        F.col("c_name").alias("nom_cli"),
        F.col("l_partkey").cast("string").alias("cod_art"),
        F.col("l_suppkey").cast("string").alias("cod_alm"),
        F.col("l_quantity").alias("can_art1"),
        F.col("l_extendedprice").alias("mon_bru"),
        net.alias("mon_net"),
        (net * F.col("l_tax").cast("decimal(18,2)")).cast("decimal(18,2)").alias("mon_imp1"),
        F.lit(1).cast("decimal(18,6)").alias("tasa_doc"),
        (F.col("l_discount").cast("decimal(18,2)") * 100).alias("por_des1"),
        F.lit("USD").alias("cod_mon"),
        F.round(F.col("l_tax") * 100).cast("int").cast("string").alias("cod_imp"),
        F.round(F.col("l_tax") * 100, 2).alias("por_imp1"),
        F.col("l_shipdate").alias("_ingested_at"),
        F.col("o_orderkey"),
        F.col("o_orderdate"),
    )


def stg_ventas_union(spark: SparkSession, d: str, only: str | None = None) -> DataFrame:
    """Sales staging of the three contract versions (v3, v2, legacy) as ONE tagged relation.

    Each source line is exploded into the versions whose period covers it; columns
    a version's contract lacks are NULL for its rows and the row hash covers that
    widest contract's columns. One scan and one join feed all three versions (instead
    of three filtered copies of the same join). ``_version`` / ``_priority`` tag rows. ``only`` names a version whose rows
    alone are wanted: lines of other days are then left out before the join.

    The ERP source query itself (sign of returns P15, money rule P16) runs here
    through the library's operators.
    """
    from ..contracts import SALES_PRIORITY
    from ..functions.hashing import row_hash_expr

    lines = erp_sales_lines(sales_source_lines(spark, d))
    odate = F.col("o_orderdate")
    ts = lambda s: F.lit(s).cast("timestamp_ntz")
    periods = {"v3": odate >= ts(V3_FROM), "v2": (odate >= ts(V2_FROM)) & (odate < ts(V2_TO)), "legacy": odate < ts(LEGACY_TO)}
    if only:
        lines, periods = lines.where(periods[only]), {only: periods[only]}
    versions = F.array_compact(F.array(*[F.when(p, F.lit(v)) for v, p in periods.items()]))
    lines = lines.withColumn("_version", F.explode(versions))
    k = F.col("o_orderkey")
    is_v = lambda v: F.col("_version") == v
    lines = lines.withColumns({
        "documento": F.when(is_v("v3") & (k % DIRTY_MOD == 0), F.lit("")).otherwise(F.col("documento")),
        "cod_suc": F.when(is_v("v3") & (k % PAD_MOD == 0), F.concat(F.lit(" "), F.col("cod_suc"), F.lit("  ")))
                    .otherwise(F.col("cod_suc")),
        "nom_cli": _pad(F.col("nom_cli")),
        "cod_pro": F.when(is_v("v2"), F.lit("")).otherwise(F.lit(None).cast("string")),
    })
    wide = SALES["v2"]  # superset of the three contracts
    cols = {}
    for c in wide.columns:
        typ = "double" if c.type == "number" else "string"
        have = [v for v, e in SALES.items() if c.name in e.names]
        val = F.col(c.name).cast(typ) if c.name in lines.columns else F.lit(None).cast(typ)
        cols[c.name] = F.when(F.col("_version").isin(*have), val).otherwise(F.lit(None).cast(typ))
    x = lines.select("source_empresa", "_ingested_at", "_version", *[v.alias(n) for n, v in cols.items()])
    prio = F.create_map(*[z for v, p in SALES_PRIORITY.items() for z in (F.lit(v), F.lit(p))])
    # one hash over the widest contract's columns (NULL where the row's version lacks a column)
    return x.withColumn("_row_hash", row_hash_expr(x, wide.names)).withColumn("_priority", F.element_at(prio, F.col("_version")))


def stg_ventas(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """Per-version views of the landed sales staging (each with its own contract's columns)."""
    u = stg_ventas_union(spark, d)
    return {v: u.filter(F.col("_version") == v).select("source_empresa", "_ingested_at", *e.names, "_row_hash")
            for v, e in SALES.items()}


def stg_renglones_almacenes(spark: SparkSession, d: str) -> DataFrame:
    """Stock snapshots: per (tenant, warehouse, article, month of ship date) the shipped units,
    landed on the first day of the next month."""
    src = sales_source_lines(spark, d)
    snap = F.add_months(F.trunc(F.col("_ingested_at"), "month"), 1)
    g = src.groupBy("source_empresa", F.col("cod_alm"), F.col("cod_art"), snap.alias("snapshot_date")) \
        .agg(F.sum("can_art1").alias("exi_act1"))
    g = g.select("source_empresa", "cod_alm", "cod_art", "exi_act1", "snapshot_date",
                 F.date_format(F.col("snapshot_date").cast("timestamp_ntz"), TS_TEXT).alias("registro"))
    landed = with_row_hash(g, ["cod_alm", "cod_art", "exi_act1", "registro"])
    return landed.withColumn("_ingested_at", F.col("snapshot_date").cast("timestamp_ntz")) \
        .withColumn("run_id", F.date_format("snapshot_date", "yyyyMMdd"))


def stg_renglones_monedas(spark: SparkSession, d: str) -> DataFrame:
    """Currency rates: one rate line per event (currency = event type, tenant = user % 5)."""
    e = read_table(spark, d, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    t = tenants(spark, d)
    e = e.join(F.broadcast(t), F.pmod("user_id", RATE_TENANTS) == F.col("r_regionkey"))
    a = e.select("source_empresa", F.col("event_type").alias("cod_mon"), F.col("event_id").cast("double").alias("renglon"),
                 _ts_text(F.col("ts")).alias("fecha"), F.col("value").alias("tasa"),
                 F.lit(None).cast("string").alias("comentario"), _ts_text(F.col("ts")).alias("registro"),
                 F.col("ts").alias("_ts"))
    out = with_row_hash(a.drop("_ts"), ALL["renglones_monedas"].names)
    return out.withColumn("_ingested_at", F.col("registro").cast("timestamp_ntz"))


def stg_cliente_snapshots(spark: SparkSession, d: str) -> DataFrame:
    """Customer master snapshots for history/SCD2: every order day lands a snapshot of the
    ordering customer (name, order priority and status as its changing attributes)."""
    o = read_table(spark, d, "orders", ["o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority"])
    c = read_table(spark, d, "customer", ["c_custkey", "c_name", "c_nationkey"])
    x = o.join(c, o.o_custkey == c.c_custkey).join(F.broadcast(nation_tenant(spark, d)),
                                                  F.col("c_nationkey") == F.col("n_nationkey"))
    a = x.select("source_empresa", F.col("o_custkey").cast("string").alias("cod_cli"), F.col("c_name").alias("nom_cli"),
                 F.col("o_orderpriority").alias("prioridad"), F.col("o_orderstatus").alias("estado"),
                 F.col("o_orderdate").alias("_ingested_at"), F.date_format("o_orderdate", "yyyyMMdd").alias("_run_id"))
    return with_row_hash(a, ["cod_cli", "nom_cli", "prioridad", "estado"])


def stg_renglones_aprecios(spark: SparkSession, d: str) -> DataFrame:
    """Price-change lines: each sold line records the unit price it was sold at."""
    s = sales_source_lines(spark, d)
    a = s.select("source_empresa", F.col("documento"), F.col("renglon"), F.col("cod_art"),
                 F.lit(None).cast("double").alias("pre_ant"),
                 F.round(F.try_divide(F.col("mon_bru").cast("decimal(18,2)"), F.col("can_art1").cast("decimal(18,2)")), 2)
                 .cast("double").alias("pre_nue"),
                 F.lit(None).cast("double").alias("cos_ult1"), F.lit("1").alias("tip_pre"),
                 F.lit(None).cast("string").alias("notas"), _ts_text(F.col("_ingested_at")).alias("registro"),
                 F.col("_ingested_at"))
    return with_row_hash(a, ALL["renglones_aprecios"].names)


def user_documents(spark: SparkSession, d: str) -> DataFrame:
    """Security user documents: per seller one with an assignment; per tenant a supervisor without assignments, an analyst and a
    clerk without a role that counts. Some mails arrive in upper case, some users or assignments are inactive."""
    s = stg_vendedores(spark, d)
    code = F.col("cod_ven").cast("int")
    null = F.lit(None).cast("string")
    sellers = s.select(
        F.lit("vendedores").alias("source"), F.sha2(F.col("correo"), 256).substr(1, 20).alias("id"),
        F.when(code % 3 == 0, F.upper("correo")).otherwise(F.col("correo")).alias("email"),
        (code % 7 != 0).alias("isActive"), F.col("source_empresa").alias("tenantId"), null.alias("role"),
        F.array(F.struct(F.col("source_empresa").alias("empresa"), F.col("source_empresa").alias("tenantId"),
                         F.col("cod_ven").alias("codVendedor"), null.alias("codSucursal"),
                         F.when(code % 5 == 0, F.lit("I")).otherwise(F.lit("A")).alias("status"))).alias("vendedores"))
    t = tenants(spark, d)
    kinds = F.explode(F.array(*[F.struct(F.lit(a).alias("source"), F.lit(b).alias("name"), F.lit(c).alias("role")) for a, b, c in
                                (("vendedores", "supervisor", None), ("users", "analista", "Analista de Ventas"), ("users", "oficina", "Oficina"))]))
    others = t.select("source_empresa", kinds.alias("k")).select(
        F.col("k.source").alias("source"), F.sha2(F.concat("k.name", "source_empresa"), 256).substr(1, 20).alias("id"),
        F.concat(F.col("k.name"), F.lit("@"), F.col("source_empresa"), F.lit(".com")).alias("email"), F.lit(True).alias("isActive"),
        F.col("source_empresa").alias("tenantId"), F.col("k.role").alias("role"), F.array().cast(sellers.schema["vendedores"].dataType).alias("vendedores"))
    return sellers.unionByName(others)


def job_log(spark: SparkSession, d: str) -> DataFrame:
    """Warehouse job log stand-in: one job per event (statement type by event kind)."""
    e = read_table(spark, d, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    return e.select(F.col("event_id").alias("job_id"), F.col("ts").cast("timestamp").alias("creation_time"),
                    F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit("@corp.com")).alias("user_email"),
                    F.when(F.col("event_type").isin("view", "click"), F.lit("SELECT")).otherwise(F.lit("SCRIPT"))
                    .alias("statement_type"),
                    (F.col("value") * 1e9).cast("long").alias("total_bytes_processed"),
                    (F.col("value") * 1000).cast("long").alias("total_slot_ms"))


def telemetry_lines(spark: SparkSession, d: str) -> DataFrame:
    """Telemetry JSON lines from events; every 53rd line arrives truncated (malformed)."""
    e = read_table(spark, d, "events", ["event_id", "ts", "user_id", "event_type", "value", "props"])
    rec = F.to_json(F.struct(
        F.col("event_id"), F.col("event_type").alias("event_name"),
        F.concat(F.lit("req-"), (F.col("event_id") / 3).cast("long").cast("string")).alias("request_id"),
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("subject"),
        F.when(F.col("event_type") == "error", F.lit("ERROR")).otherwise(F.lit("SUCCESS")).alias("status"),
        (F.col("value") * 1000).alias("duration_ms"),
        F.when(F.col("event_type") == "error", F.lit("E500")).alias("error_code"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts"),
        F.col("props").alias("attributes")))
    x = e.select(F.col("event_id"), rec.alias("_r"))
    return x.select(F.when(F.col("event_id") % 53 == 0, F.substring("_r", 1, 20)).otherwise(F.col("_r")).alias("value"))


# --- payload variants (fixed rules of the stand-in envelopes) ------------------
_V3_FIELDS = ["tipo_documento", "cod_suc", "documento", "renglon", "registro", "cod_ven", "cod_cli", "cod_art", "cod_alm",
              "can_ven", "monto_bruto", "cod_mon", "cod_imp", "por_imp1", "neto", "dcto", "tasa", "neto_dcto"]
QUERY_SQL_HASH = "sha256:ventas_diarias_v3:1"


def _pascal(name: str) -> str:
    return "_".join(p[:1].upper() + p[1:] for p in name.split("_"))


def sales_payloads(spark: SparkSession, d: str) -> DataFrame:
    """Raw ERP responses: one JSON envelope per sales document (bounded size), with the
    envelope variants the landing must handle: BOM (k%5), legacy root ``datos`` (k%3),
    Pascal_Case keys (k%11), HTML error page (k%101), llError (k%103), empty table (k%107),
    a row missing a required key (k%109, line 2), an extra column (k%113), a reserved
    ``_`` key (k%127)."""
    lines = erp_sales_lines(sales_source_lines(spark, d))
    k = F.col("o_orderkey")
    cols = {f: F.col(f) for f in _V3_FIELDS}
    cols["documento"] = F.when((k % 109 == 0) & (F.col("renglon") == 2), F.lit(None).cast("string")).otherwise(F.col("documento"))
    extra = F.when(k % 113 == 0, F.lit("x"))
    reserved = F.when(k % 127 == 0, F.lit("1"))
    snake = F.to_json(F.struct(*[c.alias(n) for n, c in cols.items()], extra.alias("campo_extra"), reserved.alias("_interno")))
    pascal = F.to_json(F.struct(*[c.alias(_pascal(n)) for n, c in cols.items()], extra.alias("Campo_Extra"),
                                reserved.alias("_Interno")))
    rows = lines.withColumn("_j", F.when(k % 11 == 0, pascal).otherwise(snake))
    g = rows.groupBy("source_empresa", "o_orderkey", "o_orderdate").agg(
        F.array_join(F.sort_array(F.collect_list("_j")), ",").alias("_rows"))
    # an extraction covers a fortnight (1-15, 16-end)
    window = F.when(F.dayofmonth("o_orderdate") <= 15, F.trunc("o_orderdate", "month")).otherwise(F.date_add(F.trunc("o_orderdate", "month"), 15))
    root = F.when(k % 3 == 0, F.lit("datos")).otherwise(F.lit("d"))
    env = F.concat(F.lit('{"'), root, F.lit('":{"laTablas":[['), F.col("_rows"), F.lit("]]}}"))
    env = F.when(k % 5 == 0, F.concat(F.lit("﻿"), env)).otherwise(env)
    payload = (F.when(k % 101 == 0, F.lit("<html><body>Error 500</body></html>"))
                .when(k % 103 == 0, F.lit('{"llError":true,"d":{"laTablas":[]}}'))
                .when(k % 107 == 0, F.lit('{"d":{"laTablas":[[]]}}'))
                .otherwise(env))
    return g.select(
        F.concat(F.col("source_empresa"), F.lit("-"), k.cast("string")).alias("payload_id"),
        "source_empresa", F.lit("ventas_diarias_v3").alias("query_id"), F.lit("3").alias("query_version"),
        F.lit(QUERY_SQL_HASH).alias("query_sql_hash"),
        F.date_format(window, "yyyy-MM-dd").alias("dt"),
        F.concat(F.lit("run-"), F.date_format(window, "yyyyMMdd")).alias("run_id"),
        (F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).cast("timestamp").alias("_ingested_at"),
        payload.alias("payload"))


def batch_log(payloads_hashed: DataFrame, outcome: DataFrame) -> DataFrame:
    """Append-only batch status log: WRITTEN then the final status one second later;
    every 17th landed batch stays at WRITTEN (crash between stage and promote), and so do all of a run whose day and tenant
    name add up to a multiple of 7 (an extraction that broke down)."""
    x = payloads_hashed.join(outcome, "payload_id")
    k = F.substring_index("payload_id", "-", -1).cast("long")
    broken = F.pmod(F.datediff(F.col("dt").cast("date"), F.lit("1970-01-01").cast("date")) + F.length("source_empresa"), F.lit(7)) == 0
    final = F.when(F.col("final_status") == "SUCCESS", F.when((F.pmod(k, 17) == 0) | broken, F.lit(None)).otherwise(F.lit("SUCCESS"))) \
        .otherwise(F.col("final_status"))
    ev = F.array(F.struct(F.lit("WRITTEN").alias("status"), F.lit(0).alias("o")),
                 F.struct(final.alias("status"), F.lit(1).alias("o")))
    y = x.select("*", F.explode(ev).alias("_e")).filter(F.col("_e.status").isNotNull())
    return y.select(F.col("_lote_id").alias("batch_id"), "run_id", F.col("query_id").alias("entity"), "source_empresa", "dt",
                    F.col("_e.status").alias("status"), "record_count", F.col("_payload_hash").alias("payload_hash"),
                    (F.col("_ingested_at") + F.make_interval(secs=F.col("_e.o"))).alias("inserted_at"))
