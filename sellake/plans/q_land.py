"""Landing, batch identity/validation, Bronze/quarantine/table sinks, control log, backfill."""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import oracle as O
from .queries import query
from .. import contracts as C
from ..operators import land as LD
from ..operators.backfill import missing_windows
from ..session import checkpoint_dir
from ..sources import erp_adapter as A

E3 = C.SALES["v3"]
BACKFILL_START = "1995-01-01"


def _scratch(spark, name: str) -> str:
    """A fresh folder under the shared checkpoint location of the session."""
    return f"{checkpoint_dir(spark).rstrip('/')}/sellake-out/{name}-{uuid.uuid4().hex}"


class Landing:
    """Landing tables of one Lake, each written on first use (see ``Lake.table``)."""

    def __init__(self, lk):
        self.lk = lk
        self.payloads = lk.table("payloads", lambda: A.sales_payloads(lk.spark, lk.d))
        self.hashed = LD.with_batch_id(LD.with_payload_hash(self.payloads))

    @cached_property
    def scan(self):
        return LD.split_scan(self.lk.table("scan", lambda: LD.scan_tagged(self.hashed)))

    @property
    def rows(self):
        return self.scan[0]

    @property
    def invalid(self):
        return self.scan[1]

    @cached_property
    def lanes(self):
        """(landed rows, quarantined payloads) as plans."""
        return LD.land(self.payloads, E3, (self.rows, self.invalid))

    @cached_property
    def landed(self):
        return self.lk.table("landed", lambda: self.lanes[0])

    @cached_property
    def quarantined(self):
        return self.lk.table("quarantined", lambda: self.lanes[1])

    def outcome(self):
        return self.lk.table("outcome", self._outcome)

    def _outcome(self):
        """Status and rows of each payload: from the plans, as ids alone are read and the wide tables need not be written for it."""
        landed, quarantined = self.lanes
        cnt = landed.groupBy("payload_id").agg(F.count("*").alias("record_count"))
        q = quarantined.select("payload_id", F.lit("QUARANTINED").alias("_q"))
        x = self.payloads.select("payload_id").join(q, "payload_id", "left").join(cnt, "payload_id", "left")
        return x.select("payload_id", F.coalesce("_q", F.lit("SUCCESS")).alias("final_status"),
                        F.coalesce("record_count", F.lit(0)).alias("record_count"))

    def log(self):
        return A.batch_log(self.hashed, self.outcome())


# ---------------------------------------------------------------- oracle views
def _quoted(name: str) -> str:
    return f'"{name}"'


_snake = ", ".join(f"{n} := {'CASE WHEN o_orderkey % 109 = 0 AND renglon = 2 THEN NULL ELSE documento END' if n == 'documento' else n}"
                   for n in A._V3_FIELDS)
_pasc = ", ".join(f"{_quoted(A._pascal(n))} := {'CASE WHEN o_orderkey % 109 = 0 AND renglon = 2 THEN NULL ELSE documento END' if n == 'documento' else n}"
                  for n in A._V3_FIELDS)
_EXTRA = "CASE WHEN o_orderkey % 113 = 0 THEN 'x' END"
_RES = "CASE WHEN o_orderkey % 127 = 0 THEN '1' END"
_J = (f"regexp_replace(CAST(CASE WHEN o_orderkey % 11 = 0 THEN to_json(struct_pack({_pasc}, \"Campo_Extra\" := {_EXTRA}, \"_Interno\" := {_RES})) "
      f"ELSE to_json(struct_pack({_snake}, campo_extra := {_EXTRA}, _interno := {_RES})) END AS VARCHAR), ',\"[A-Za-z_]+\":null', '', 'g')")
O.view("payloads", ["erp_sales_lines"], f"""
SELECT source_empresa || '-' || CAST(o_orderkey AS VARCHAR) AS payload_id, source_empresa, 'ventas_diarias_v3' AS query_id,
  '3' AS query_version, '{A.QUERY_SQL_HASH}' AS query_sql_hash, strftime(win, '%Y-%m-%d') AS dt,
  'run-' || strftime(win, '%Y%m%d') AS run_id, o_orderdate + INTERVAL 1 DAY AS _ingested_at,
  CASE WHEN o_orderkey % 101 = 0 THEN '<html><body>Error 500</body></html>'
       WHEN o_orderkey % 103 = 0 THEN '{{"llError":true,"d":{{"laTablas":[]}}}}'
       WHEN o_orderkey % 107 = 0 THEN '{{"d":{{"laTablas":[[]]}}}}'
       ELSE (CASE WHEN o_orderkey % 5 = 0 THEN chr(65279) ELSE '' END) || '{{"' ||
            (CASE WHEN o_orderkey % 3 = 0 THEN 'datos' ELSE 'd' END) || '":{{"laTablas":[[' || rows || ']]}}}}' END AS payload
FROM (SELECT source_empresa, o_orderkey, o_orderdate, date_trunc('month', o_orderdate)::DATE + if(day(o_orderdate) > 15, 15, 0) AS win, array_to_string(list_sort(list({_J})), ',') AS rows
      FROM erp_sales_lines GROUP BY source_empresa, o_orderkey, o_orderdate) g""")
O.view("hashed", ["payloads"], """SELECT *, sha256(payload) AS _payload_hash,
  sha256(source_empresa || '|' || query_id || '|' || dt || '|' || sha256(payload)) AS _lote_id FROM payloads""")
O.view("parsed", ["hashed"], """
SELECT *, CASE WHEN doc IS NULL THEN 'schema_mismatch' WHEN err THEN 'schema_mismatch' WHEN root IS NULL OR json_type(root) <> 'OBJECT' THEN 'schema_mismatch'
  WHEN json_type(root, '$.laTablas') IS DISTINCT FROM 'ARRAY' OR json_array_length(root, '$.laTablas') = 0 THEN 'schema_mismatch'
  WHEN json_type(root, '$.laTablas[0]') IS DISTINCT FROM 'ARRAY' THEN 'schema_mismatch'
  WHEN NOT list_bool_and(list_transform(COALESCE(json_extract(root, '$.laTablas[0][*]'), []), lambda r: json_type(r) = 'OBJECT'))
    THEN 'schema_mismatch' END AS reason
FROM (SELECT *, CASE WHEN COALESCE(CAST(json_extract(doc, '$.d') AS VARCHAR), '') IN ('', '{}', 'null') THEN json_extract(doc, '$.datos')
                     ELSE json_extract(doc, '$.d') END AS root,
             lower(COALESCE(json_extract_string(doc, '$.llError'), 'false')) IN ('true', '1') AS err
      FROM (SELECT *, CASE WHEN json_valid(t) AND json_type(t) = 'OBJECT' THEN CAST(t AS JSON) END AS doc
            FROM (SELECT *, regexp_replace(payload, '^' || chr(65279), '') AS t FROM hashed) a) b) c""")
O.view("scan_rows", ["parsed"], """
SELECT p.* EXCLUDE (payload, t, doc, root, err, reason), u.i - 1 AS row_index,
  map_from_entries(list_transform(json_keys(u.r), lambda k: struct_pack(key := lower(k), value := json_extract_string(u.r, '$."' || k || '"'))))
    AS row
FROM parsed p, unnest(json_extract(p.root, '$.laTablas[0][*]')) WITH ORDINALITY AS u(r, i) WHERE p.reason IS NULL""")
O.view("scan_invalid", ["parsed"], "SELECT payload_id, source_empresa, dt, run_id, payload, reason FROM parsed WHERE reason IS NOT NULL")
O.view("scan_empty", ["parsed"], """SELECT payload_id FROM parsed WHERE reason IS NULL
  AND json_array_length(root, '$.laTablas[0]') = 0""")
_REQ = "[" + ", ".join(f"'{c}'" for c in E3.required) + "]"
O.view("v1_missing", ["scan_rows"], f"""
SELECT payload_id, arg_min(row_index, row_index) AS row_index, array_to_string(arg_min(miss, row_index), ',') AS missing FROM (
  SELECT payload_id, row_index, list_sort(list_filter({_REQ}, lambda c: NOT list_contains(map_keys(row), c))) AS miss FROM scan_rows) m
WHERE len(miss) > 0 GROUP BY payload_id""")
O.view("underscore", ["scan_rows"], """SELECT DISTINCT payload_id FROM scan_rows
  WHERE len(list_filter(map_keys(row), lambda k: starts_with(k, '_'))) > 0""")
O.view("bad", ["scan_invalid", "scan_empty", "v1_missing", "underscore"], """
SELECT payload_id, min(reason) AS reason FROM (
  SELECT payload_id, reason FROM scan_invalid UNION ALL SELECT payload_id, 'empty_rejected' FROM scan_empty
  UNION ALL SELECT payload_id, 'schema_mismatch' FROM v1_missing UNION ALL SELECT payload_id, 'schema_mismatch' FROM underscore) u
GROUP BY payload_id""")
_MAPHASH = "sha256(array_to_string(list_transform(list_sort(map_keys(row)), lambda k: COALESCE(row[k], chr(0) || 'NULL' || chr(0))), chr(31)))"
_TYPED = ", ".join(f"TRY_CAST(row['{c.name}'] AS DOUBLE) AS {c.name}" if c.type == "number" else f"row['{c.name}'] AS {c.name}"
                   for c in E3.columns)
O.view("landed", ["scan_rows", "bad"], f"""
SELECT payload_id, row_index, {_TYPED}, _ingested_at, source_empresa, query_id AS _query_id, query_version AS _query_version,
  query_sql_hash AS _query_sql_hash, run_id AS _run_id, _lote_id, _payload_hash, {_MAPHASH} AS _row_hash, dt,
  len(list_filter(map_keys(row), lambda k: NOT list_contains({list(E3.names)}, k))) AS n_extra
FROM scan_rows WHERE payload_id NOT IN (SELECT payload_id FROM bad)""")
O.view("outcome", ["payloads", "bad", "landed"], """
SELECT p.payload_id, CASE WHEN b.payload_id IS NOT NULL THEN 'QUARANTINED' ELSE 'SUCCESS' END AS final_status,
  COALESCE(c.n, 0) AS record_count
FROM payloads p LEFT JOIN bad b USING (payload_id) LEFT JOIN (SELECT payload_id, count(*) AS n FROM landed GROUP BY ALL) c USING (payload_id)""")
O.view("batch_log", ["hashed", "outcome"], """
SELECT _lote_id AS batch_id, run_id, query_id AS entity, source_empresa, dt, status, record_count, _payload_hash AS payload_hash,
  _ingested_at + to_seconds(o) AS inserted_at
FROM (SELECT h.*, o.record_count, unnest([struct_pack(status := 'WRITTEN', o := 0),
        struct_pack(status := CASE WHEN o.final_status = 'SUCCESS'
                                   THEN CASE WHEN CAST(split_part(h.payload_id, '-', -1) AS BIGINT) % 17 = 0
                                                  OR (h.dt::DATE - DATE '1970-01-01' + length(h.source_empresa)) % 7 = 0 THEN NULL ELSE 'SUCCESS' END
                                   ELSE o.final_status END, o := 1)], recursive := true)
      FROM hashed h JOIN outcome o USING (payload_id)) x WHERE status IS NOT NULL""")
O.view("latest_batches", ["batch_log"], """
SELECT * FROM batch_log QUALIFY row_number() OVER (PARTITION BY batch_id ORDER BY inserted_at DESC, status DESC, run_id DESC) = 1""")


def ld(lk):
    return Landing(lk)


@query("H1_payload_hash", O.out("SELECT payload_id, _payload_hash FROM hashed", "payload_id:s, _payload_hash:s"))
def h1(lk):
    """H1: sha256 of each raw payload's exact bytes."""
    return LD.with_payload_hash(A.sales_payloads(lk.spark, lk.d)).select("payload_id", "_payload_hash")


@query("H2_batch_id", O.out("SELECT payload_id, _lote_id FROM hashed", "payload_id:s, _lote_id:s"))
def h2(lk):
    """H2: deterministic batch id sha256(empresa|query|dt|payload_hash)."""
    return ld(lk).hashed.select("payload_id", "_lote_id")


@query("S1_envelope_scan", O.out("""
SELECT payload_id, row_index, row['documento'] AS documento, row['renglon'] AS renglon, row['neto_dcto'] AS neto_dcto,
  cardinality(row) AS n_keys, NULL::VARCHAR AS reason FROM scan_rows
UNION ALL SELECT payload_id, NULL, NULL, NULL, NULL, NULL, NULL FROM scan_empty
UNION ALL SELECT payload_id, NULL, NULL, NULL, NULL, NULL, reason FROM scan_invalid""",
    "payload_id:s, row_index:i, documento:s, renglon:s, neto_dcto:s, n_keys:i, reason:s"))
def s1(lk):
    """Envelopes -> rows (BOM, d/datos root, first table, lower-cased keys) plus invalid payloads with reason."""
    x = ld(lk)
    r = x.rows.select("payload_id", "row_index", F.col("row")["documento"].alias("documento"),
                      F.col("row")["renglon"].alias("renglon"), F.col("row")["neto_dcto"].alias("neto_dcto"),
                      F.size("row").alias("n_keys"), F.lit(None).cast("string").alias("reason"))
    r = r.withColumn("n_keys", F.when(F.col("n_keys") >= 0, F.col("n_keys")))
    i = x.invalid.select("payload_id", *[F.lit(None).cast(t).alias(n) for n, t in
                                         (("row_index", "int"), ("documento", "string"), ("renglon", "string"),
                                          ("neto_dcto", "string"), ("n_keys", "int"))], "reason")
    return r.unionByName(i)


@query("H3_row_hash", O.out(f"SELECT payload_id, row_index, {_MAPHASH} AS _row_hash FROM scan_rows",
                            "payload_id:s, row_index:i, _row_hash:s"))
def h3(lk):
    """H3: row hash over values ordered by column name (0x1F separator, NULL sentinel)."""
    x = ld(lk).rows.filter(F.col("row").isNotNull())
    return x.select("payload_id", "row_index", LD.map_row_hash(F.col("row")).alias("_row_hash"))


_H4 = ("payload_id, row_index, tipo_documento, documento, renglon, neto_dcto, _ingested_at, source_empresa, _query_id, "
       "_query_version, _query_sql_hash, _run_id, _lote_id, _payload_hash, _row_hash, dt, n_extra")


@query("H4_enrich_lineage", O.out(f"SELECT {_H4} FROM landed",
                                  "payload_id:s, row_index:i, tipo_documento:s, documento:s, renglon:d, neto_dcto:d, "
                                  "_ingested_at:ts, source_empresa:s, _query_id:s, _query_version:s, _query_sql_hash:s, "
                                  "_run_id:s, _lote_id:s, _payload_hash:s, _row_hash:s, dt:s, n_extra:i"))
def h4(lk):
    """H4: landed rows typed by the contract with the nine lineage columns; fields outside the contract are kept and counted."""
    return ld(lk).landed.withColumn("n_extra", F.size("_extra")).select(*[c.strip() for c in _H4.split(",")])


@query("V1_required_columns", O.out("SELECT * FROM v1_missing", "payload_id:s, row_index:i, missing:s"))
def v1(lk):
    """V1: first row lacking required columns per payload, with the missing set."""
    return LD.validate_required(ld(lk).rows, E3)


@query("V2_empty_batch", O.out("SELECT payload_id, 'empty_rejected' AS reason FROM scan_empty", "payload_id:s, reason:s"))
def v2(lk):
    """V2: empty results rejected because the entity declares reject_empty."""
    return LD.empty_batches(ld(lk).rows, E3)


@query("V3_duplicate_batch", O.out("""SELECT h.payload_id, CASE WHEN d.payload_hash IS NOT NULL THEN 'SKIPPED' ELSE 'PROCESS' END AS action
FROM hashed h LEFT JOIN (SELECT DISTINCT source_empresa, entity, dt, payload_hash FROM latest_batches WHERE status = 'SUCCESS') d
  ON h.source_empresa = d.source_empresa AND h.query_id = d.entity AND h.dt = d.dt AND h._payload_hash = d.payload_hash""",
                                   "payload_id:s, action:s"))
def v3(lk):
    """V3: re-landing the same payloads: batches already in SUCCESS are SKIPPED (WRITTEN ones are redone)."""
    x = ld(lk)
    reg = LD.latest_batches(x.log())
    new = x.hashed.select("payload_id", "source_empresa", F.col("query_id").alias("entity"), "dt",
                          F.col("_payload_hash").alias("payload_hash"))
    return LD.skip_duplicates(new, reg).select("payload_id", "action")


@query("S4_staging_drift", O.out(f"""SELECT payload_id, array_to_string(list_sort(list(DISTINCT k)), ',') AS columns,
  '{E3.name}' AS entity, 'extra' AS kind FROM (
  SELECT payload_id, unnest(list_filter(map_keys(row), lambda k: NOT list_contains([{', '.join(repr(n) for n in E3.names)}], k))) AS k
  FROM scan_rows) e GROUP BY payload_id
UNION ALL SELECT DISTINCT NULL, 'source_empresa=' || source_empresa || '/run_id=' || run_id, 'sobres', 'unreadable' FROM parsed WHERE doc IS NULL
UNION ALL SELECT NULL, 'no_such_folder', 'conceptos', 'unreadable'""", "payload_id:s, columns:s, entity:s, kind:s"))
def s4(lk):
    """Drift: columns observed in payload rows but not in the contract, per payload; and files that cannot be read, per entity, here raw
    envelopes landed by tenant and run, some of them HTML pages, beside an entity without a folder."""
    base = _scratch(lk.spark, "sobres")
    ld(lk).payloads.select("payload", "source_empresa", "run_id").hint("rebalance", "source_empresa", "run_id").write.partitionBy("source_empresa", "run_id").option("compression", "gzip").text(base)
    envelope = T.StructType([T.StructField(c, T.StringType()) for c in ("d", "datos", "llError")])
    _, faults = LD.load_entities(lk.spark, {"sobres": (base, envelope), "conceptos": (f"{base}/no_such_folder", envelope)})
    where = F.regexp_extract("path", r"(source_empresa=[^/]+/run_id=[^/]+|no_such_folder)", 1)
    unreadable = faults.select(F.lit(None).cast("string").alias("payload_id"), where.alias("columns"), "entity", F.lit("unreadable").alias("kind")).distinct()
    return LD.check_drift(ld(lk).rows, E3).select("payload_id", "columns", "entity", "kind").unionByName(unreadable)


@query("A1_batch_registry", O.out("SELECT batch_id, status, record_count, inserted_at FROM latest_batches",
                                  "batch_id:s, status:s, record_count:i, inserted_at:ts"))
def a1(lk):
    """A1: latest status per batch from the append-only log."""
    return LD.latest_batches(ld(lk).log()).select("batch_id", "status", "record_count", "inserted_at")


@query("A2_run_summary", O.out("""SELECT run_id, min(CASE WHEN status = 'WRITTEN' THEN inserted_at END) AS started_at,
  max(CASE WHEN status <> 'WRITTEN' THEN inserted_at END) AS ended_at,
  arg_max(status, struct_pack(t := COALESCE(CASE WHEN status <> 'WRITTEN' THEN inserted_at END,
                                            CASE WHEN status = 'WRITTEN' THEN inserted_at END), s := status)) AS status,
  epoch(max(CASE WHEN status <> 'WRITTEN' THEN inserted_at END)) - epoch(min(CASE WHEN status = 'WRITTEN' THEN inserted_at END))
    AS duration_s
FROM batch_log GROUP BY run_id""", "run_id:s, started_at:ts, ended_at:ts, status:s, duration_s:i"))
def a2(lk):
    """A2: start and finish rows folded into one run with its duration."""
    log = ld(lk).log()
    runs = log.select("run_id", F.when(F.col("status") == "WRITTEN", F.col("inserted_at")).alias("started_at"),
                      F.when(F.col("status") != "WRITTEN", F.col("inserted_at")).alias("ended_at"), "status")
    return LD.fold_runs(runs)


@query("A3_event_append", O.out("""SELECT batch_id, e AS extras, CASE WHEN strlen(e) > 2048
  THEN '{"__truncated":true,"size_bytes":' || CAST(strlen(e) AS VARCHAR) || '}' ELSE e END AS extras_display FROM (
  SELECT batch_id, CAST(to_json(struct_pack(status := status, record_count := record_count,
           detalle := repeat(payload_hash, CAST(record_count AS INTEGER) * 2))) AS VARCHAR) AS e FROM latest_batches) x""",
                                "batch_id:s, extras:s, extras_display:s"))
def a3(lk):
    """A3: event extras as JSON, whole, and as shown (a marker when over 2048 bytes)."""
    b = LD.latest_batches(ld(lk).log())
    extras = F.to_json(F.struct("status", "record_count",
                                F.repeat(F.col("payload_hash"), (F.col("record_count") * 2).cast("int")).alias("detalle")))
    return LD.with_extras(b, extras).select("batch_id", "extras", "extras_display")


@query("A4_ops_daily", O.out("""WITH b AS (SELECT dt, source_empresa, count(*) AS lotes, count(*) FILTER (WHERE status = 'SUCCESS') AS exitosos,
    count(*) FILTER (WHERE status = 'QUARANTINED') AS cuarentena,
    sum(CASE WHEN status = 'SUCCESS' THEN record_count ELSE 0 END) AS registros FROM latest_batches GROUP BY ALL),
e AS (SELECT dt, source_empresa, round(avg(length(payload)), 3) AS latencia_media_ms FROM payloads GROUP BY ALL)
SELECT b.*, e.latencia_media_ms, round(exitosos / lotes * 100, 2) AS pct_exito, round(cuarentena / lotes * 100, 2) AS tasa_cuarentena
FROM b LEFT JOIN e USING (dt, source_empresa)""",
    "dt:s, source_empresa:s, lotes:i, exitosos:i, cuarentena:i, registros:i, latencia_media_ms:d, pct_exito:d, tasa_cuarentena:d"))
def a4(lk):
    """A4: per day and tenant: success %, quarantine rate, records loaded, mean latency."""
    x = ld(lk)
    # stand-in event log: a transfer takes a millisecond a character
    ev = x.payloads.select("dt", "source_empresa", F.length("payload").alias("duration_ms"))
    return LD.ops_daily(LD.latest_batches(x.log()), ev)


@query("B1_missing_windows", O.out(f"""
WITH pairs AS (SELECT source_empresa, unnest(['ventas_diarias_v3', 'clientes']) AS query_id FROM tenants),
w AS (SELECT source_empresa, query_id, CASE WHEN h = 0 THEN m ELSE m + 15 END AS window_start,
        least(CASE WHEN h = 0 THEN m + 14 ELSE last_day(m) END, DATE '2001-07-31') AS window_end
      FROM pairs, unnest(generate_series(DATE '{BACKFILL_START}', DATE '2001-07-01', INTERVAL 1 MONTH)) AS g(mt),
           LATERAL (SELECT CAST(mt AS DATE) AS m), unnest([0, 1]) AS hh(h)),
done AS (SELECT DISTINCT source_empresa, entity AS query_id,
           CASE WHEN day(CAST(dt AS DATE)) <= 15 THEN CAST(date_trunc('month', CAST(dt AS DATE)) AS DATE)
                ELSE CAST(date_trunc('month', CAST(dt AS DATE)) AS DATE) + 15 END AS window_start
         FROM latest_batches WHERE status = 'SUCCESS')
SELECT * FROM w WHERE window_start <= DATE '2001-07-31' AND window_end >= DATE '{BACKFILL_START}'
  AND NOT EXISTS (SELECT 1 FROM done d WHERE d.source_empresa = w.source_empresa AND d.query_id = w.query_id
                  AND CAST(d.window_start AS DATE) = w.window_start)""",
    "source_empresa:s, query_id:s, window_start:dt, window_end:dt"))
def b1(lk):
    """B1: fortnight windows per expected tenant and query with no successful batch, also where none was ever landed."""
    expected = lk.tenants.select("source_empresa", F.explode(F.array(F.lit("ventas_diarias_v3"), F.lit("clientes"))).alias("query_id"))
    return missing_windows(LD.latest_batches(ld(lk).log()), expected, BACKFILL_START, lk.as_of)


@query("S2_bronze_write", O.out("SELECT source_empresa, dt, _run_id AS run_id, count(*) AS record_count FROM landed GROUP BY ALL",
                                "source_empresa:s, dt:s, run_id:s, record_count:i"))
def s2(lk):
    """Landed rows written as gzip JSON lines in hive layout; counts per partition read back."""
    path = _scratch(lk.spark, "bronze")
    out = LD.write_bronze(ld(lk).landed, path, E3.name)
    return out.select(F.col("source_empresa").cast("string"), F.col("dt").cast("string"), F.col("run_id").cast("string"),
                      "record_count")


@query("S3_staging_load", O.out("SELECT source_empresa, dt, tipo_documento, documento, renglon, neto_dcto, _lote_id FROM landed",
                                "source_empresa:s, dt:s, tipo_documento:s, documento:s, renglon:d, neto_dcto:d, _lote_id:s"))
def s3(lk):
    """S3: Bronze read back with the declared contract schema; partition keys from the path."""
    path = _scratch(lk.spark, "bronze")
    LD.write_bronze(ld(lk).landed, path, E3.name)
    st = LD.load_staging(lk.spark, f"{path}/{E3.name}", E3)
    return st.select(F.col("source_empresa").cast("string"), F.col("dt").cast("string"), "tipo_documento", "documento",
                     "renglon", "neto_dcto", "_lote_id")


@query("S5_quarantine_write", O.out("""SELECT p.source_empresa, b.reason, count(*) AS payloads FROM bad b JOIN payloads p USING (payload_id)
GROUP BY ALL""", "source_empresa:s, reason:s, payloads:i"))
def s5(lk):
    """Quarantined payloads written raw with their reason; counts per tenant and reason read back."""
    path = _scratch(lk.spark, "quarantine")
    return LD.write_quarantine(ld(lk).quarantined, path, E3.name).select(
        F.col("source_empresa").cast("string"), F.col("reason").cast("string"), "payloads")


@query("S7_table_sink", O.out("SELECT strftime(fecha_registro, '%Y-%m') AS _part, count(*) AS filas FROM sil_ventas GROUP BY ALL",
                              "_part:s, filas:i"))
def s7(lk):
    """Silver sales written partitioned by month and clustered (sorted) by tenant/branch/supplier/seller."""
    path = _scratch(lk.spark, "table")
    back = LD.write_table(lk.sil_ventas, path, "fecha_registro", ["source_empresa", "cod_suc", "cod_pro", "cod_ven"])
    return back.groupBy(F.col("_part").cast("string").alias("_part")).agg(F.count("*").alias("filas"))
