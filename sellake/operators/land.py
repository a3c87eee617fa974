"""Landing: envelopes -> rows, batch identity and validation, Bronze and quarantine
writes, control-log folds (S1, S2, S3, S4, S5, S7, V1-V3, H1-H4, A1-A4).

Every payload is one row; parsing is column expressions (``from_json`` into maps),
so a day of responses from every tenant lands in one distributed job.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import AUDIT_COLUMNS, Entity, contract_to_schema
from ..functions.hashing import NULL_SENTINEL, UNIT_SEPARATOR, batch_id, packed_hash, payload_hash, unpacked_hash

# --- Fixed values -------------------------------------------------------------
BOM = "﻿"
ROOT_KEYS = ("d", "datos")
REASONS = ("empty_rejected", "schema_mismatch", "parse_error", "unknown")
MAX_EXTRAS_BYTES = 2048
BATCH_STATUSES = ("WRITTEN", "SUCCESS", "SKIPPED", "QUARANTINED", "FAILED")
# -------------------------------------------------------------------------------


def scan_envelopes(payloads: DataFrame, payload_col: str = "payload") -> tuple[DataFrame, DataFrame]:
    """Payloads -> (rows, invalid), the two sides of ``scan_tagged``."""
    return split_scan(scan_tagged(payloads, payload_col), payload_col)


def split_scan(tagged: DataFrame, payload_col: str = "payload") -> tuple[DataFrame, DataFrame]:
    rows = tagged.filter(F.col("reason").isNull()).drop(payload_col, "reason")
    return rows, tagged.filter(F.col("reason").isNotNull()).drop("row_index", "row")


def scan_tagged(payloads: DataFrame, payload_col: str = "payload") -> DataFrame:
    """Each payload is parsed once; its rows come with ``row_index`` and ``row``, an invalid payload as one row with
    ``reason`` and its text.

    BOM stripped; root object must have ``d`` (or, when that is empty/absent,
    ``datos``); ``llError`` true, a missing/empty ``laTablas``, a first table that
    is not a list, or a row that is not an object make the payload invalid
    (``schema_mismatch``, as any structural fault). Row keys are lower-cased; two keys equal up to case make
    the payload invalid too. An empty first table is valid with zero rows.
    """
    p = F.regexp_replace(F.col(payload_col), f"^{BOM}", "")

    def obj(text):  # only a JSON object parses as one
        return F.ltrim(F.coalesce(text, F.lit(""))).startswith("{")

    # three parses per payload, each its own projection step so it is evaluated once:
    # document fields (raw text) -> root's laTablas (raw texts) -> first table as rows
    x = payloads.withColumn("_doc", F.when(obj(p), F.from_json(p, "struct<llError: string, d: string, datos: string>")))
    d_root = F.col("_doc").getField(ROOT_KEYS[0])
    root_txt = F.when(F.coalesce(d_root, F.lit("")).isin("", "{}", "null", "false", "0", "[]", '""'),
                      F.col("_doc").getField(ROOT_KEYS[1])).otherwise(d_root)
    x = x.withColumn("_root", F.when(obj(root_txt), F.from_json(root_txt, "struct<laTablas: array<string>>")))
    x = x.withColumn("_tables", F.col("_root").getField("laTablas"))
    # a first table that is not a list, or a row that is not an object, comes back NULL here
    x = x.withColumn("_first", F.from_json(F.try_element_at(F.col("_tables"), F.lit(1)), "array<map<string,string>>"))
    x = x.withColumn("_rows", F.col("_first"))
    ok_rows = F.col("_rows").isNotNull() & F.forall(F.col("_rows"), lambda m: m.isNotNull())
    case_clash = F.exists(F.col("_rows"), lambda m: F.size(F.array_distinct(F.transform(F.map_keys(m), F.lower)))
                          != F.size(F.map_keys(m)))
    err = F.lower(F.coalesce(F.col("_doc").getField("llError"), F.lit("false"))).isin("true", "1")
    broken = (F.col("_doc").isNull() | err | F.col("_root").isNull() | F.coalesce(F.size("_tables") == 0, F.lit(True))
              | F.col("_first").isNull() | ~ok_rows | case_clash)
    reason = F.when(F.coalesce(broken, F.lit(True)), F.lit("schema_mismatch"))
    x = x.withColumn("_reason", reason)
    base = [c for c in payloads.columns if c != payload_col]
    bad = F.col("_reason").isNotNull()
    out = x.select(*base, F.when(bad, F.col(payload_col)).alias(payload_col), F.col("_reason").alias("reason"),
                   F.posexplode_outer(F.when(~bad, F.col("_rows"))).alias("row_index", "_m"))
    return out.withColumn("row", F.transform_keys("_m", lambda k, v: F.lower(k))).drop("_m")


def row_count(rows: DataFrame, id_col: str = "payload_id") -> DataFrame:
    """Rows per payload (an empty table gives one placeholder row with NULL ``row``)."""
    return rows.groupBy(id_col).agg(F.count("row").alias("record_count"))


def empty_batches(rows: DataFrame, entity: Entity, id_col: str = "payload_id") -> DataFrame:
    """V2: payloads with no rows are rejected only when the entity says ``reject_empty``."""
    if not entity.reject_empty:
        return rows.limit(0).select(id_col, F.lit("empty_rejected").alias("reason"))
    return row_count(rows, id_col).filter(F.col("record_count") == 0).select(id_col, F.lit("empty_rejected").alias("reason"))


def validate_required(rows: DataFrame, entity: Entity, id_col: str = "payload_id") -> DataFrame:
    """V1: per payload, the first row lacking a required column and its missing set."""
    req = F.array(*[F.lit(c) for c in entity.required])
    miss = rows.filter(F.col("row").isNotNull()).withColumn("_miss", F.array_sort(F.array_except(req, F.map_keys("row"))))
    miss = miss.filter(F.size("_miss") > 0)
    return miss.groupBy(id_col).agg(F.min_by(F.struct("row_index", "_miss"), "row_index").alias("_f")).select(
        id_col, F.col("_f.row_index").alias("row_index"), F.array_join("_f._miss", ",").alias("missing"))


def underscore_keys(rows: DataFrame, id_col: str = "payload_id") -> DataFrame:
    """Payloads whose rows carry a key starting with ``_`` (reserved for lineage)."""
    bad = rows.filter(F.exists(F.map_keys("row"), lambda k: k.startswith("_")))
    return bad.select(id_col).distinct().withColumn("reason", F.lit("schema_mismatch"))


def check_drift(rows: DataFrame, entity: Entity, id_col: str = "payload_id") -> DataFrame:
    """Columns seen in payload rows but absent from the contract, per payload (sorted list)."""
    known = F.array(*[F.lit(c) for c in entity.names])
    extra = rows.filter(F.col("row").isNotNull()).select(
        id_col, F.explode(F.array_except(F.map_keys("row"), known)).alias("col")).distinct()
    return extra.groupBy(id_col).agg(F.array_join(F.array_sort(F.collect_list("col")), ",").alias("columns")) \
        .withColumn("entity", F.lit(entity.name)).withColumn("kind", F.lit("extra"))


def with_payload_hash(df: DataFrame, payload_col: str = "payload") -> DataFrame:
    """H1: sha256 of the exact payload bytes."""
    return df.withColumn("_payload_hash", payload_hash(payload_col))


def with_batch_id(df: DataFrame) -> DataFrame:
    """H2: sha256('empresa|query|dt|payload_hash')."""
    return df.withColumn("_lote_id", batch_id("source_empresa", "query_id", "dt", "_payload_hash"))


def map_row_hash(m: Column) -> Column:
    """H3 over a map row: values ordered by key, 0x1F-joined, NULL as a sentinel."""
    keys = F.array_sort(F.map_keys(m))
    vals = F.transform(keys, lambda k: F.coalesce(m[k], F.lit(NULL_SENTINEL)))
    return F.sha2(F.array_join(vals, UNIT_SEPARATOR), 256)


def enrich(rows: DataFrame, entity: Entity, id_col: str = "payload_id") -> DataFrame:
    """H4: typed contract columns from the row map + the nine lineage columns. Nothing of the row is lost: ``_extra`` has the
    fields outside the contract, ``_bad_numbers`` the text of numbers that do not parse (their columns are NULL).

    ``rows`` carry their batch attributes (query, version, sql hash, run, batch id,
    payload hash, ingest time) from the envelope scan. Payloads with reserved
    (``_``) keys are quarantined before this step.
    """
    x = rows.filter(F.col("row").isNotNull())
    typed = []
    for c in entity.columns:
        v = F.col("row").getItem(c.name)
        typed.append((v.try_cast("double") if c.type == "number" else v).alias(c.name))
    number = F.array(*[F.lit(c.name) for c in entity.columns if c.type == "number"])
    known = F.array(*[F.lit(c) for c in entity.names])
    extra = F.map_filter("row", lambda k, v: ~F.array_contains(known, k))
    bad = F.map_filter("row", lambda k, v: F.array_contains(number, k) & v.isNotNull() & v.try_cast("double").isNull())
    return x.select(id_col, "row_index", *typed, extra.alias("_extra"), bad.alias("_bad_numbers"),
                    F.col("_ingested_at"), F.col("source_empresa"), F.col("query_id").alias("_query_id"),
                    F.col("query_version").alias("_query_version"), F.col("query_sql_hash").alias("_query_sql_hash"),
                    F.col("run_id").alias("_run_id"), "_lote_id", "_payload_hash", map_row_hash(F.col("row")).alias("_row_hash"),
                    "dt")


def land(payloads: DataFrame, entity: Entity, scanned: tuple[DataFrame, DataFrame] | None = None
         ) -> tuple[DataFrame, DataFrame]:
    """S1 + V1/V2 + H1-H4: (landed rows, quarantined payloads with reason).
    ``scanned`` may pass an already computed (rows, invalid) scan of the hashed payloads."""
    hashed = with_batch_id(with_payload_hash(payloads))
    rows, invalid = scanned if scanned is not None else scan_envelopes(hashed)
    bad = reduce(DataFrame.unionByName, [
        invalid.select("payload_id", "reason"),
        empty_batches(rows, entity),
        validate_required(rows, entity).select("payload_id", F.lit("schema_mismatch").alias("reason")),
        underscore_keys(rows),
    ])
    enriched = enrich(rows, entity)
    # one reason per payload: an empty table is rejected before its columns are looked at
    order = F.when(F.col("reason") == "empty_rejected", 0).otherwise(1)
    bad = bad.groupBy("payload_id").agg(F.min_by("reason", order).alias("reason"))
    # typed columns are narrower than the row's map, and hashes as bytes: so they go through the shuffle
    hashes = [c for c, t in enriched.dtypes if c in ("_lote_id", "_payload_hash", "_row_hash") and t == "string"]
    narrow = enriched.withColumns({c: packed_hash(c) for c in hashes})
    landed = narrow.join(bad.select("payload_id"), "payload_id", "left_anti").withColumns({c: unpacked_hash(c) for c in hashes})
    quarantined = payloads.join(bad, "payload_id").join(hashed.select("payload_id", "_payload_hash", "_lote_id"), "payload_id")
    return landed, quarantined


def _promote(df: DataFrame, target: str, parts: list[str], order: list[str], **options: str) -> DataFrame:
    """Write ``df`` as JSON lines below ``target``, one folder per value of ``parts``, and return the rows per folder.

    Spark stages the files beside the target and moves them when all tasks are done; a folder that is written again is replaced
    (dynamic overwrite), so a batch landed twice stays once and a failed job changes nothing. Rows are sorted within a file, so equal
    rows give equal bytes. Rows are counted by the writing job itself (observed metrics), not by reading them back; the counts per
    folder come from the columns of ``parts`` alone and must add up to it.
    """
    seen = Observation()
    # REBALANCE brings a folder's rows together in files of the advisory size: a large one is split over tasks
    out = df.hint("rebalance", *parts).sortWithinPartitions(*parts, *order).observe(seen, F.count(F.lit(1)).alias("rows"))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**options).partitionBy(*parts).json(target)
    counts = df.groupBy(*parts).agg(F.count("*").alias("record_count"))
    counted = counts.agg(F.coalesce(F.sum("record_count"), F.lit(0))).head()[0]
    if counted != seen.get["rows"]:
        raise RuntimeError(f"{seen.get['rows']} rows promoted to {target}, {counted} in the batch")
    return counts


def write_bronze(df: DataFrame, path: str, entity: str) -> DataFrame:
    """Gzip JSON lines in hive layout ``<entity>/source_empresa=/dt=/run_id=/``, each batch folder promoted once (see
    ``_promote``). Returns (source_empresa, dt, run_id, record_count, uri) per folder."""
    target = f"{path.rstrip('/')}/{entity}"
    parts = ["source_empresa", "dt", "run_id"]
    order = [c for c in ("payload_id", "row_index", "_row_hash") if c in df.columns]
    return _promote(df.withColumnRenamed("_run_id", "run_id"), target, parts, order, compression="gzip").withColumn(
        "uri", F.concat(F.lit(target + "/source_empresa="), F.col("source_empresa"), F.lit("/dt="), F.col("dt").cast("string"),
                        F.lit("/run_id="), F.col("run_id")))


def load_staging(spark: SparkSession, path: str, entity: Entity) -> DataFrame:
    """S3: all Bronze runs of an entity with the DECLARED schema (never inferred);
    unknown fields ignored, partition keys from the path."""
    schema = contract_to_schema(entity, with_audit=False)
    for a in AUDIT_COLUMNS:
        if a not in ("source_empresa", "_run_id"):
            schema = schema.add(a, "timestamp" if a == "_ingested_at" else "string")
    for m in ("_extra", "_bad_numbers"):
        schema = schema.add(m, T.MapType(T.StringType(), T.StringType()))
    # partition columns (source_empresa, dt, run_id) are discovered from the directory layout
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


# --- Fixed values: faults of a landed file ---
DAMAGED, BAD_ROWS, MISSING = "damaged_file", "unreadable_rows", "missing"


def _damaged(files: DataFrame) -> DataFrame:
    """Paths of gzip files that do not unpack to their end. Files are unpacked a megabyte at a time, and the rows thrown away."""
    def check(batches):
        import zlib

        import pyarrow as pa

        for b in batches:
            bad = []
            for path, content in zip(b.column(0).to_pylist(), b.column(1)):
                raw, unpack = content.as_buffer(), zlib.decompressobj(31)
                try:
                    for i in range(0, len(raw), 1 << 20):
                        unpack.decompress(raw[i : i + (1 << 20)])
                    if not unpack.eof:
                        bad.append(path)
                except zlib.error:
                    bad.append(path)
            yield pa.RecordBatch.from_arrays([pa.array(bad, pa.string())], names=["path"])

    return files.select("path", "content").mapInArrow(check, "path string")


def load_readable(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """The rows of all readable files below ``path``, and the faults: (path, reason, bad_rows) of each file that is not.

    A file is unreadable as a whole if it is damaged or if a row of it is no JSON of the schema; none of its rows are loaded, and no
    other file is affected. Faults are found by file (path and corrupt-record column), so one bad file never fails a job.
    """
    corrupt, file = "_corrupt_record", F.col("_metadata.file_path")
    declared = T.StructType([*schema, T.StructField(corrupt, T.StringType())])
    lines = spark.read.option("ignoreCorruptFiles", "true").text(path)
    parts = [c for c in lines.columns if c != "value"]  # columns of the folder names
    parsed = F.from_json(F.regexp_replace("value", "^\ufeff", ""), declared, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
    rows = lines.where(F.trim("value") != "").select(*parts, file.alias("_file"), parsed.alias("_row"))
    packed = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").option("recursiveFileLookup", "true").load(path)
    damaged = _damaged(packed.select(file.alias("path"), "content")).select("path", F.lit(DAMAGED).alias("reason"), F.lit(None).cast("long").alias("bad_rows"))
    bad = rows.where(F.col(f"_row.{corrupt}").isNotNull()).groupBy(F.col("_file").alias("path")).agg(F.count("*").alias("bad_rows"))
    bad = bad.join(damaged, "path", "left_anti").select("path", F.lit(BAD_ROWS).alias("reason"), "bad_rows")
    faults = damaged.unionByName(bad)
    good = rows.join(faults.select(F.col("path").alias("_file")), "_file", "left_anti").select(*parts, *[F.col(f"_row.`{f.name}`").alias(f.name) for f in schema])
    return good, faults


def load_entities(spark: SparkSession, folders: dict[str, tuple[str, T.StructType]]) -> tuple[dict[str, DataFrame], DataFrame]:
    """S4 over several entities (name -> folder and schema): the readable rows of each, and all faults with their entity. An
    entity whose folder cannot be listed is a fault; the others load."""
    loaded, faults = {}, []
    for name, (path, schema) in folders.items():
        try:
            loaded[name], found = load_readable(spark, path, schema)
            faults.append(found.select(F.lit(name).alias("entity"), "path", "reason", "bad_rows"))
        except AnalysisException:
            faults.append(spark.createDataFrame([(name, path, MISSING, None)], "entity string, path string, reason string, bad_rows long"))
    return loaded, reduce(DataFrame.unionByName, faults)


def quarantine_files(spark: SparkSession, root: str, faults: DataFrame, target: str) -> DataFrame:
    """Copies of the files in ``faults`` (entity, path, reason), byte for byte, below ``target``: one row a file, by entity."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select(F.col("_metadata.file_path").alias("path"), "length", "content")
    files.join(faults.select("entity", "path", "reason"), "path").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("entity").parquet(target)
    return spark.read.parquet(target)


def write_quarantine(df: DataFrame, path: str, entity: str) -> DataFrame:
    """Raw payload + reason under ``<entity>/source_empresa=/dt=/run_id=/reason=<r>/``, each folder promoted once; counts per tenant and reason."""
    target = f"{path.rstrip('/')}/{entity}"
    cols = ["source_empresa", "dt", "run_id", "reason", "payload_id", "payload", "_payload_hash"]
    done = _promote(df.select(*cols), target, cols[:4], ["payload_id", "_payload_hash"])
    return done.groupBy("source_empresa", "reason").agg(F.sum("record_count").alias("payloads"))


#: Values that range bounds are taken from, at most, and bits of a range number.
BOUND_SAMPLE, RANGE_BITS = 4096, 4


def range_number(df: DataFrame, column: str) -> Column:
    """Which of 16 ranges of about equal size a value of ``column`` falls into; NULL is in the first. Bounds come from at most
    BOUND_SAMPLE values, those of least hash; they affect where rows lie, never which rows there are."""
    held = df.select(column).where(F.col(column).isNotNull()).orderBy(F.xxhash64(F.struct(*df.columns))).limit(BOUND_SAMPLE)
    values = sorted(r[0] for r in held.collect())
    n = 1 << RANGE_BITS
    bounds = sorted({values[len(values) * k // n] for k in range(1, n)}) if values else []
    return reduce(Column.__add__, [F.coalesce((F.col(column) >= F.lit(b)).cast("int"), F.lit(0)) for b in bounds], F.lit(0))


def interleaved(numbers: list[Column]) -> Column:
    """The bits of several range numbers in turn, highest first: rows that are near in every column are near in this number."""
    out, k = F.lit(0), len(numbers)
    for bit in range(RANGE_BITS):
        for i, n in enumerate(numbers):
            out = out + F.call_function("shiftright", n, F.lit(bit)).bitwiseAND(F.lit(1)) * F.lit(1 << bit * k + (k - 1 - i))
    return out


def write_table(df: DataFrame, path: str, partition_date: str, cluster_cols: list[str], grain: str = "month") -> DataFrame:
    """Partitioned + clustered table: a real partition column derived from the date (pruning works on it), and within it
    rows in order of the interleaved ranges of up to four cluster columns, so that a filter on any of them skips row groups."""
    part = F.date_format(F.col(partition_date), "yyyy-MM" if grain == "month" else "yyyy-MM-dd")
    z = interleaved([range_number(df, c) for c in cluster_cols[:4]])
    hashes = [c for c, t in df.dtypes if c == "_row_hash" and t == "string"]  # as bytes through the shuffle
    out = df.withColumns({"_part": part, "_z": z, **{c: packed_hash(c) for c in hashes if c not in cluster_cols}})
    # ranges of (month, place): a large month goes to several tasks, each with places next to each other; small ones share files
    ordered = out.repartitionByRange("_part", "_z").sortWithinPartitions("_part", "_z", *cluster_cols).drop("_z").withColumns({c: unpacked_hash(c) for c in hashes if c not in cluster_cols})
    ordered.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("_part").parquet(path)
    return out.sparkSession.read.parquet(path)


# ------------------------------------------------------------------ control log

def latest_batches(log: DataFrame) -> DataFrame:
    """A1: append-only status log -> latest status per batch (one aggregation). A batch that was landed again in another run
    stays one row, with the run of its last status; at equal times the greatest status and run count."""
    rest = ["run_id", "entity", "source_empresa", "dt", "payload_hash", "status", "record_count", "inserted_at"]
    last = F.max_by(F.struct(*rest), F.struct("inserted_at", "status", "run_id"))
    return log.groupBy("batch_id").agg(last.alias("_l")).select("batch_id", *[f"_l.{c}" for c in rest])


def fold_runs(log: DataFrame) -> DataFrame:
    """A2: start row + finish row per run -> one run with duration in seconds; at equal times the greatest status counts."""
    g = log.groupBy("run_id").agg(F.min("started_at").alias("started_at"), F.max("ended_at").alias("ended_at"),
                                  F.max_by("status", F.struct(F.coalesce("ended_at", "started_at"), "status")).alias("status"))
    return g.withColumn("duration_s", F.col("ended_at").cast("long") - F.col("started_at").cast("long"))


def with_extras(df: DataFrame, extras: Column, max_bytes: int = MAX_EXTRAS_BYTES) -> DataFrame:
    """A3: event extras as JSON text, whole, and ``extras_display``: the same, or a marker with its size over ``max_bytes``."""
    size = F.octet_length("extras")
    marker = F.concat(F.lit('{"__truncated":true,"size_bytes":'), size.cast("string"), F.lit("}"))
    return df.withColumn("extras", extras).withColumn("extras_display", F.when(size > max_bytes, marker).otherwise(F.col("extras")))


def skip_duplicates(new: DataFrame, registry: DataFrame) -> DataFrame:
    """V3: a new batch whose (empresa, entity, dt, payload_hash) already ended in SUCCESS is SKIPPED.
    Only SUCCESS counts: a batch stuck at WRITTEN is processed again."""
    keys = ["source_empresa", "entity", "dt", "payload_hash"]
    done = registry.filter(F.col("status") == "SUCCESS").select(*keys).distinct().withColumn("_done", F.lit(True))
    x = new.join(done, keys, "left")
    return x.withColumn("action", F.when(F.col("_done"), F.lit("SKIPPED")).otherwise(F.lit("PROCESS"))).drop("_done")


def ops_daily(batches: DataFrame, events: DataFrame) -> DataFrame:
    """A4: per day and tenant: success %, quarantine rate, records loaded, mean latency."""
    b = batches.groupBy("dt", "source_empresa").agg(
        F.count("*").alias("lotes"), F.count_if(F.col("status") == "SUCCESS").alias("exitosos"),
        F.count_if(F.col("status") == "QUARANTINED").alias("cuarentena"),
        F.sum(F.when(F.col("status") == "SUCCESS", F.col("record_count")).otherwise(F.lit(0))).alias("registros"))
    e = events.groupBy("dt", "source_empresa").agg(F.round(F.avg("duration_ms"), 3).alias("latencia_media_ms"))
    x = b.join(e, ["dt", "source_empresa"], "left")
    return x.withColumns({
        "pct_exito": F.round(F.try_divide(F.col("exitosos"), F.col("lotes")) * 100, 2),
        "tasa_cuarentena": F.round(F.try_divide(F.col("cuarentena"), F.col("lotes")) * 100, 2),
    })
