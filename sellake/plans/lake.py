"""The medallion plan over one set of source tables: staging -> Silver -> Gold.

Everything here is lazy: each property builds (once per ``Lake``) a DataFrame
plan; nothing is collected. Queries compose these plans and Catalyst prunes
what a query does not read.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import contracts as C
from ..operators import dims, facts, history, reports, silver, views
from ..sources import erp_adapter as A
from . import materialize as MT

AS_OF = "2001-07-31"
REJECTED_AT = "2001-08-01 07:00:00"


class Lake:
    def __init__(self, spark: SparkSession, sf_dir: str, as_of: str = AS_OF):
        self.spark = spark
        self.d = sf_dir
        self.as_of = as_of
        self._stg: dict[str, DataFrame] = {}
        self._sil: dict[str, DataFrame] = {}
        self.key = MT.layer_key(spark, sf_dir, as_of)
        self.source_bytes = MT.source_bytes(spark, sf_dir)

    def table(self, name: str, build, prepare=None, task_bytes: int = MT.TASK_SHUFFLE_BYTES) -> DataFrame:
        """A Silver/Gold boundary: written once, then read (see ``materialize``)."""
        return MT.table(self.spark, self.key, name, build, prepare, self.source_bytes, task_bytes)

    # ---- staging (adapter) -------------------------------------------------
    @cached_property
    def stg_ventas_union(self) -> DataFrame:
        return self.table("stg_ventas_union", lambda: A.stg_ventas_union(self.spark, self.d))

    @property
    def landing_ventas(self) -> DataFrame:
        """The same rows as a plan, for steps that read them once: the join again moves less than the wide table written."""
        return A.stg_ventas_union(self.spark, self.d)

    @cached_property
    def stg_ventas(self) -> dict[str, DataFrame]:
        u = self.stg_ventas_union
        return {v: u.filter(F.col("_version") == v).select("source_empresa", "_ingested_at", *e.names, "_row_hash")
                for v, e in C.SALES.items()}

    def stg(self, entity: str) -> DataFrame:
        if entity not in self._stg:
            self._stg[entity] = getattr(A, "stg_" + entity)(self.spark, self.d)
        return self._stg[entity]

    # ---- Silver --------------------------------------------------------------
    def silver_split(self, entity: str) -> tuple[DataFrame, DataFrame]:
        return self.sil(entity), self.rejects(entity)

    def rejects(self, entity: str) -> DataFrame:
        return self.table(f"rej_{entity}", lambda: self._silver_split(entity)[1])

    def _silver_split(self, entity: str) -> tuple[DataFrame, DataFrame]:
        e = C.ALL[entity]
        if entity in C.TRANSACTIONS:
            return silver.silver_transaction(self.stg(entity), e, REJECTED_AT)
        if entity == "clientes":
            return silver.silver_clientes(self.stg(entity), e, REJECTED_AT)
        return silver.silver_master(self.stg(entity), e, REJECTED_AT)

    def sil(self, entity: str) -> DataFrame:
        if entity not in self._sil:
            self._sil[entity] = self.table(f"sil_{entity}", lambda: self._silver_split(entity)[0])
        return self._sil[entity]

    def _sales_split(self):
        return silver.silver_sales(self.landing_ventas.drop("_version"), self.sil("articulos"), REJECTED_AT)

    @property
    def rej_ventas(self) -> DataFrame:
        return self.table("rej_ventas", lambda: self._sales_split()[1])

    @property
    def sil_ventas_split(self) -> tuple[DataFrame, DataFrame]:
        return self.sil_ventas, self.rej_ventas

    @cached_property
    def sil_ventas(self) -> DataFrame:
        return self.table("sil_ventas", lambda: self._sales_split()[0])

    @property
    def current_ventas(self) -> DataFrame:
        """M3 up to its dedup, for plans that do not give the row hash: ties are broken by its first 60 bits as a number, 8 bytes in the
        shuffle instead of 33 (two rows of one key, contract and time that differ share them once in 2**60)."""
        short = F.conv(F.substring("_row_hash", 1, 15), 16, 10).cast("bigint")
        return silver.current_sales(self.landing_ventas.drop("_version").withColumn("_row_hash", short))[0].drop("_row_hash")

    def ventas(self, cols) -> DataFrame:
        """The named columns of Silver's sales as a plan, for queries that read few: the dedup shuffles these alone, and lines meet the
        articles only for the supplier code."""
        done = silver.with_article_supplier(self.current_ventas, self.sil("articulos")) if "cod_pro" in cols else silver.finished_sales(self.current_ventas)
        return done.select(*cols)

    # ---- Gold ----------------------------------------------------------------
    CALENDAR = ("1990-01-01", "2009-12-31")

    @cached_property
    def tenants(self) -> DataFrame:
        return A.tenants(self.spark, self.d)

    @cached_property
    def dim_empresa(self) -> DataFrame:
        return dims.dim_company(self.tenants)

    @cached_property
    def lines(self) -> DataFrame:
        """M7 over the whole history (no year filter)."""
        return self.lines_numbered.drop("_rid")

    @cached_property
    def lines_numbered(self) -> DataFrame:
        """The written lines with a number of each, by day within each file, so that date windows skip pages. They come from Silver's plan
        and not from its table: deduplicated lines meet the customers while they are narrow, then both article joins in one shuffle."""
        articles, clients = self.sil("articulos"), self.sil("clientes")
        others = [self.sil(n) for n in ("vendedores", "proveedores", "marcas", "departamentos")]

        def build():
            narrow = facts.with_client(self.current_ventas, clients)
            return facts.line_measures(silver.with_article_supplier(narrow, articles), articles, None, *others).withColumn("_rid", F.monotonically_increasing_id())

        return self.table("lines", build, lambda df: df.sortWithinPartitions("fecha_registro"))

    @cached_property
    def calendar(self) -> DataFrame:
        """Some 7,300 days between fixed bounds, so that joins may broadcast it; a line dated outside has no day here."""
        return dims.calendar(self.spark, *self.CALENDAR)

    @cached_property
    def fct_ventas(self) -> DataFrame:
        """M8 over the written lines: a lookup of tenants and columns of the day, not worth a table of their own."""
        return facts.fct_sales(self.lines, self.dim_empresa)

    #: Columns of the lines that the reports by code or name take; the names are those that a line brings itself.
    CODE_COLS = ["source_empresa", "cod_suc", "documento", "cod_ven", "nom_ven", "cod_cli", "nom_cli", "rif", "cod_art", "nom_art", "modelo", "cod_pro", "nom_pro",
                 "cod_mar", "nom_mar", "can_ven", "neto_dcto"]

    @cached_property
    def coded_lines(self) -> DataFrame:
        """The deduplicated lines before any master meets them, as narrow as the reports below; numbers as landed."""
        return self.table("coded_lines", lambda: self.current_ventas.select(*self.CODE_COLS, F.to_date("registro").alias("fecha_registro")))

    def _fact(self, lines: DataFrame) -> DataFrame:
        return facts.fct_sales(lines, self.dim_empresa)

    @cached_property
    def coded_fact(self) -> DataFrame:
        """The fact for reports that take nothing from a master: codes of the line and its amounts."""
        return self._fact(silver.finished_numbers(self.coded_lines))

    @cached_property
    def measured_fact(self) -> DataFrame:
        """The fact for reports by code: units, boxes and tons, supplier and brand of the article."""
        return self._fact(facts.article_measures(self.coded_lines, self.sil("articulos")))

    def _named(self, lines: DataFrame) -> DataFrame:
        return facts.with_names(lines, *(self.sil(n) for n in ("vendedores", "proveedores", "marcas")))

    @cached_property
    def article_fact(self) -> DataFrame:
        """The fact by article, with names but not those of customers. The articles' join comes last of those that shuffle, so that groups
        with the article need no shuffle of their own."""
        return self._fact(self._named(facts.article_measures(self.coded_lines, self.sil("articulos"))))

    def _client_lines(self, lines: DataFrame) -> DataFrame:
        return self._named(facts.with_client(facts.article_measures(lines, self.sil("articulos")), self.sil("clientes")))

    @cached_property
    def client_fact(self) -> DataFrame:
        """The fact by customer, with all names that reports group by; here the customers' join comes last."""
        return self._fact(self._client_lines(self.coded_lines))

    @cached_property
    def fact_90d(self) -> DataFrame:
        """The same for the 90 days up to ``as_of``: written, as reports read it more than once."""
        return self._fact(self.table("lines_90d", lambda: self._client_lines(reports._window(self.coded_lines, self.as_of, 90))))

    # ---- history -----------------------------------------------------------
    HISTORY_ATTRS = {
        "clientes": ("cod_cli", ["cod_cli", "nom_cli", "prioridad", "estado"]),
        "articulos": ("cod_art", ["cod_art", "nom_art", "cod_mar", "cod_pro", "modelo", "peso", "cap_bulto", "status"]),
        "vendedores": ("cod_ven", ["cod_ven", "nom_ven", "status"]),
        "sucursales": ("cod_suc", ["cod_suc", "nom_suc", "status"]),
        "almacenes": ("cod_alm", ["cod_alm", "nom_alm", "status"]),
        "proveedores": ("cod_pro", ["cod_pro", "nom_pro", "status"]),
    }
    DIM_ATTRS = {
        "clientes": ["nom_cli", "prioridad", "estado"], "articulos": ["nom_art", "cod_mar", "cod_pro", "modelo"],
        "vendedores": ["nom_ven"], "sucursales": ["nom_suc"], "almacenes": ["nom_alm"], "proveedores": ["nom_pro"],
    }

    @cached_property
    def master_history(self) -> DataFrame:
        src = {}
        for ent, (key, cols) in self.HISTORY_ATTRS.items():
            df = A.stg_cliente_snapshots(self.spark, self.d) if ent == "clientes" else self.stg(ent)
            src[ent] = (df, key, cols)
        return history.stack_history(src)

    @cached_property
    def scd2(self) -> DataFrame:
        return self.table("scd2", lambda: history.scd2(self.master_history))

    def dim_scd2(self, entity: str) -> DataFrame:
        return history.scd2_dim(self.scd2, entity, self.HISTORY_ATTRS[entity][0], self.DIM_ATTRS[entity])

    @cached_property
    def fct_ventas_v2(self) -> DataFrame:
        dims_ = {
            "cliente": (self.dim_scd2("clientes"), "cod_cli", "cod_cli", ["nom_cli"]),
            "articulo": (self.dim_scd2("articulos"), "cod_art", "cod_art", ["nom_art"]),
            "vendedor": (self.dim_scd2("vendedores"), "cod_ven", "cod_ven", ["nom_ven"]),
            "sucursal": (self.dim_scd2("sucursales"), "cod_suc", "cod_suc", []),
            "almacen": (self.dim_scd2("almacenes"), "cod_alm", "cod_alm", ["nom_alm"]),
            "proveedor": (self.dim_scd2("proveedores"), "cod_pro", "cod_pro", ["nom_pro"]),
        }
        return self.table("fct_ventas_v2", lambda: history.resolve(self.lines_numbered, dims_, "registro", "_rid").drop("_rid"))

    # ---- cutover facts -----------------------------------------------------------
    CUTOVER = "2000-01-01"
    SNAPSHOT_UNTIL = "1998-01-01"

    @cached_property
    def snapshot_lines(self) -> DataFrame:
        """Legacy full snapshot of sales lines (the legacy contract, cleaned)."""
        e = C.SALES["legacy"]
        s = silver.contract_clean(A.stg_ventas_union(self.spark, self.d, only="legacy"), e, keep=["source_empresa", "_ingested_at"])
        return s.withColumn("fecha_registro", F.to_date("registro"))

    #: Columns of the lines that the cutover facts give; those that the BI fact takes besides.
    FACT_COLS = [*facts.SALES_KEY, "registro", "fecha_registro", "cod_alm", "neto_dcto"]
    BI_COLS = ["cod_ven", "cod_cli", "cod_art", "cod_mon", "cod_imp", "can_ven", "monto_bruto", "neto", "dcto", "tasa"]

    @cached_property
    def cutover_ventas(self) -> DataFrame:
        """Silver's sales lines, as narrow as the cutover facts and J2 are; written, as a fact reads them more than once."""
        return self.table("cutover_ventas", lambda: self.ventas(self.FACT_COLS))

    @cached_property
    def checked_ventas(self) -> DataFrame:
        """The columns of Silver's sales that Q4 checks; written, as it reads them twice."""
        return self.table("checked_ventas", lambda: self.ventas([*facts.SALES_KEY, "registro", "cod_cli", "cod_pro"]))

    @cached_property
    def fct_pre(self) -> DataFrame:
        return facts.fct_pre_cutover(self.cutover_ventas, self.snapshot_lines, self.CUTOVER, self.SNAPSHOT_UNTIL)

    @cached_property
    def fct_gold(self) -> DataFrame:
        return facts.fct_gold(self.fct_pre, facts.fct_post_cutover(self.cutover_ventas, self.CUTOVER)[0])

    @cached_property
    def sellout_daily(self) -> DataFrame:
        """G9's days with those of last year. Tasks are small, as each holds its groups three times: by member, by day and for the window."""
        return self.table("sellout_daily", lambda: reports.sellout_last_year(reports.sellout_daily(self.article_fact)), task_bytes=8 << 20)

    @cached_property
    def fct_bi(self) -> DataFrame:
        """The BI fact window with all master names."""
        names = ["clientes", "articulos", "vendedores", "proveedores", "estados", "ciudades", "marcas", "departamentos"]
        start, cols = "1999-01-01", [*self.FACT_COLS, *self.BI_COLS, "cod_pro"]
        window = F.col("fecha_registro").between(F.lit(start).cast("date"), F.lit(self.as_of).cast("date"))
        # a snapshot that ends before the window begins has no line in it; else it, and all keys of Silver that it may fill, are wanted
        filled = F.lit(start < self.SNAPSHOT_UNTIL)
        snapshot = self.snapshot_lines.where(filled)
        # with the supplier code as landed, as the fact takes it from the article; written, as the gold fact reads them twice
        lines = self.table("bi_ventas", lambda: silver.finished_sales(self.current_ventas).select(*cols).where(filled | window))

        def build():
            pre = facts.fct_pre_cutover(lines, snapshot, self.CUTOVER, self.SNAPSHOT_UNTIL)
            gold = facts.fct_gold(pre, facts.fct_post_cutover(lines, self.CUTOVER)[0])
            return facts.fct_bi(gold, start, self.as_of, {n: self.sil(n) for n in names}, article_supplier=F.col("origen") == "SILVER")

        return self.table("fct_bi", build)

    @cached_property
    def gold_stock(self) -> DataFrame:
        """The written inventory report."""
        names = ["almacenes", "articulos", "marcas", "departamentos", "secciones", "proveedores"]
        return self.table("gold_stock", lambda: views.inventory_report(self.sil("renglones_almacenes"), self.dim_empresa, {n: self.sil(n) for n in names}))

    @cached_property
    def branches(self) -> DataFrame:
        return self.sil("sucursales").select("source_empresa", "cod_suc", "nom_suc")
