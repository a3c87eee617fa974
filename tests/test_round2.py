"""Landing keeps the whole row, layers follow their source files, replays build on committed versions."""

import datetime as dt
import os
import shutil
import tempfile

from pyspark.sql import functions as F

from sellake import contracts as C
from sellake.operators import facts, land, quality
from sellake.operators.daytable import DayTable
from sellake.plans import materialize
from sellake.plans.lake import Lake

E3 = C.SALES["v3"]


def test_unknown_fields_and_bad_numbers_survive_to_staging(spark):
    row = {c: "1" for c in E3.names} | {"neto_dcto": "12,5x", "nuevo": "keep me"}
    rows = spark.createDataFrame(
        [("p", 0, row, dt.datetime(2024, 1, 1), "t", "q", "3", "h", "r", "b", "ph", "2024-01-01")],
        "payload_id string, row_index int, row map<string,string>, _ingested_at timestamp, source_empresa string, query_id string, "
        "query_version string, query_sql_hash string, run_id string, _lote_id string, _payload_hash string, dt string")
    path = tempfile.mkdtemp()
    land.write_bronze(land.enrich(rows, E3), path, E3.name)
    got = land.load_staging(spark, f"{path}/{E3.name}", E3).collect()
    assert len(got) == 1 and got[0]._extra == {"nuevo": "keep me"} and got[0]._bad_numbers == {"neto_dcto": "12,5x"} and got[0].neto_dcto is None


def test_layers_see_new_source_files(spark):
    d = tempfile.mkdtemp()
    for f in os.listdir("/root/testdata/sf0.001"):  # contents only: the test folder's own mode is read-only
        shutil.copyfile(f"/root/testdata/sf0.001/{f}", f"{d}/{f}")
    before = materialize.layer_key(spark, d, "2001-07-31")
    assert before == materialize.layer_key(spark, d, "2001-07-31")
    spark.range(3).write.parquet(f"{d}/more.parquet")
    assert before == materialize.layer_key(spark, d, "2001-07-31")  # not a source table
    names = {r.source_empresa for r in Lake(spark, d).sil("marcas").select("source_empresa").distinct().collect()}
    parts = Lake(spark, d).sil("articulos").count()
    more = spark.read.parquet(f"{d}/part.parquet")
    more = more.union(more.orderBy("p_partkey").limit(1).withColumn("p_partkey", F.lit(10**6).cast(more.schema["p_partkey"].dataType)))
    more.coalesce(1).write.parquet(f"{d}/grown")
    grown = [f for f in os.listdir(f"{d}/grown") if f.endswith(".parquet")]
    shutil.copyfile(f"{d}/grown/{grown[0]}", f"{d}/part.parquet")
    assert before != materialize.layer_key(spark, d, "2001-07-31")
    assert Lake(spark, d).sil("articulos").count() == parts + len(names)  # the new part, once a tenant, through a written layer
    n = [0]

    def build():
        n[0] += 1
        return spark.range(5)

    key = tempfile.mktemp(dir="/").strip("/")
    assert [materialize.table(spark, key, "x", build).count() for _ in range(2)] == [5, 5] and n[0] == 1


def test_a_merge_rewrites_the_days_it_touches_only(spark):
    """Untouched days keep their files; moved rows leave their old day; a replay, and a crash before the commit, change nothing."""
    cols = "k int, v string, day date, _ingested_at timestamp, _row_hash string"
    row = lambda k, v, d, t: (k, v, d and dt.date(2024, 1, d), dt.datetime(2024, 2, t), v)
    path = tempfile.mkdtemp() + "/table"
    table = DayTable(spark, path, "day", ["k"], ["_ingested_at"])
    table.merge(spark.createDataFrame([row(1, "a", 1, 1), row(2, "b", 2, 1), row(3, "c", 3, 1), row(4, "d", None, 1)], cols), "one")
    kept = lambda days: {f: os.stat(f).st_mtime_ns for f in _files(path, ".parquet") if any(f"_day=2024-01-0{d}" in f for d in days)}
    before = kept([1])
    touched = table.merge(spark.createDataFrame([row(2, "B", 2, 2), row(3, "C", 5, 2), row(5, "e", 6, 2), row(1, "old", 2, 0 + 1)][:3], cols), "two")
    assert touched == {"2024-01-02", "2024-01-03", "2024-01-05", "2024-01-06"} and kept([1]) == before
    now = lambda: sorted((r.k, r.v, r.day and r.day.day) for r in table.read().collect())
    want = [(1, "a", 1), (2, "B", 2), (3, "C", 5), (4, "d", None), (5, "e", 6)]
    assert now() == want and "2024-01-03" not in table.state()["days"]
    files = _files(path, ".parquet")
    assert table.merge(spark.createDataFrame([row(2, "again", 2, 9)], cols), "two") == set() and _files(path, ".parquet") == files
    spark.createDataFrame([row(9, "x", 9, 9)], cols).write.parquet(f"{path}/data/000000002-crash")  # written, never committed
    assert now() == want and sorted(r.k for r in table.read(table.versions()[0]).collect()) == [1, 2, 3, 4]
    table.merge(spark.createDataFrame([row(2, "older", 2, 1)], cols), "three")
    assert now() == want
    assert DayTable(spark, path + "-none", "day", ["k"], ["_ingested_at"]).state()["days"] == {}


def test_batch_landed_again_in_another_run_is_one_row(spark):
    t = dt.datetime(2024, 1, 1)
    log = spark.createDataFrame([("b", r, "e", "t", "2024-01-01", s, n, "h", t + dt.timedelta(seconds=k)) for r, s, n, k in
                                 (("r1", "WRITTEN", 1, 0), ("r1", "SUCCESS", 1, 1), ("r2", "WRITTEN", 1, 5), ("r2", "SKIPPED", 1, 5))],
                                "batch_id string, run_id string, entity string, source_empresa string, dt string, status string, record_count long, "
                                "payload_hash string, inserted_at timestamp")
    got = land.latest_batches(log).collect()
    assert [(r.run_id, r.status) for r in got] == [("r2", "WRITTEN")]


def test_result_criteria(spark):
    actual = spark.createDataFrame([("a", 0.5, 3), ("b", -1.0, 7)], "case_id string, value double, row_count long")
    cases = [("a", "NonZeroNumeric", None, None, None, True), ("b", "NonZeroNumeric", None, None, None, False), ("a", "NonZeroNumeric", None, 0.5, None, False),
             ("a", "PercentageRange", None, None, None, True), ("a", "PercentageRange", None, 0.6, None, False), ("a", "RowCountExact", None, 2.0, 4.0, True),
             ("a", "RowCountExact", None, 4.0, None, False), ("a", "RowCountExact", 3.0, None, None, True), ("b", "RowCountMinimum", None, None, None, True),
             ("zz", "NonNegativeNumeric", None, None, None, False)]
    expected = spark.createDataFrame([(i, c[0], c[1], c[2], None, None, c[3], c[4]) for i, c in enumerate(cases)],
                                     "n int, case_id string, criterion string, target double, abs_tol double, rel_tol double, lo double, hi double")
    got = [quality.check_results(actual, expected.where(F.col("n") == i)).head().ok for i in range(len(cases))]
    assert got == [c[5] for c in cases]


def test_post_cutover_merge_updates_and_adds(spark):
    cols = "source_empresa string, tipo_documento string, cod_suc string, documento string, renglon int, cod_alm string, neto_dcto double, fecha_registro date, _ingested_at timestamp, _row_hash string"
    d, t = dt.date(2000, 5, 1), dt.datetime(2000, 5, 2)
    row = lambda doc, alm, v, k: ("t", "F", "1", doc, 1, alm, v, d, t + dt.timedelta(days=k), str(v))
    old = spark.createDataFrame([row("1", "A", 1.0, 0), row("2", "A", 2.0, 0)], cols)
    new = spark.createDataFrame([row("2", "B", 5.0, 1), row("3", "B", 3.0, 1), row("4", " ", 9.0, 1)], cols)
    fact, dropped = facts.fct_post_cutover(new, "2000-01-01", old)
    assert sorted((r.documento, r.cod_alm, r.neto_dcto) for r in fact.collect()) == [("1", "A", 1.0), ("2", "B", 5.0), ("3", "B", 3.0)]
    assert dropped.head().lineas_sin_almacen == 1


def _files(path, *ends):
    return sorted(os.path.join(r, f) for r, _, fs in os.walk(path) for f in fs if f.endswith(ends or (".json", ".gz")))


def test_a_batch_landed_twice_stays_once(spark):
    """The same batch again replaces its own folder, byte for byte, and no other; quarantine the same."""
    row = {c: "1" for c in E3.names}
    rows = lambda run, n: land.enrich(spark.createDataFrame([(f"p{i}", 0, row | {"documento": str(i)}, dt.datetime(2024, 1, 1), "t", "q", "3", "h", run, "b", "ph", "2024-01-01") for i in range(n)],
        "payload_id string, row_index int, row map<string,string>, _ingested_at timestamp, source_empresa string, query_id string, "
        "query_version string, query_sql_hash string, run_id string, _lote_id string, _payload_hash string, dt string"), E3)
    path, counted = tempfile.mkdtemp(), []
    for run, n in (("r1", 5), ("r2", 3), ("r1", 5)):
        counted.append([(r.run_id, r.record_count) for r in land.write_bronze(rows(run, n).repartition(3), path, E3.name).collect()])
        kept = {f: open(f, "rb").read() for f in _files(path) if "run_id=r1" in f}
        assert counted[-1] == [(run, n)]
        first = kept if len(counted) == 1 else first
    assert list(kept.values()) == list(first.values()) and len(kept) == 1
    got = land.load_staging(spark, f"{path}/{E3.name}", E3)
    assert sorted((r.run_id, r["count"]) for r in got.groupBy("run_id").count().collect()) == [("r1", 5), ("r2", 3)]
    bad = spark.createDataFrame([("t", "2024-01-01", "r1", x, f"p{i}", "<html>", "h") for i, x in enumerate(["parse_error"] * 3 + ["unknown"])],
                                "source_empresa string, dt string, run_id string, reason string, payload_id string, payload string, _payload_hash string")
    for _ in range(2):
        assert sorted(map(tuple, land.write_quarantine(bad, f"{path}/q", "x").collect())) == [("t", "parse_error", 3), ("t", "unknown", 1)]
    assert spark.read.json(f"{path}/q/x").count() == 4


def test_lines_outside_the_calendar_are_rejects(spark):
    from sellake.operators import dims

    cal = dims.calendar(spark, "2020-01-01", "2020-12-31")
    lines = spark.createDataFrame([(1, dt.date(2020, 5, 1)), (2, dt.date(1980, 1, 1)), (3, None)], "n int, fecha_registro date")
    assert [r.n for r in facts.with_calendar(lines, cal).collect()] == [1]
    assert sorted((r.n, r.reason) for r in facts.calendar_rejects(lines, cal).collect()) == [(2, facts.NO_DAY), (3, facts.NO_DAY)]


def test_unreadable_files_do_not_stop_the_others(spark):
    """A damaged file and one with a bad row are faults of their own; the rest loads, entity by entity; copies are byte for byte."""
    import gzip

    from pyspark.sql import types as T

    root, schema = tempfile.mkdtemp(), T.StructType([T.StructField("a", T.LongType())])
    whole = gzip.compress(b"".join(b'{"a": %d}\n' % i for i in range(5000)))
    files = {"x/good.json.gz": gzip.compress(b'{"a": 1}\n{"a": 2, "more": 3}\n'), "x/cut.json.gz": whole[: len(whole) // 2], "x/flipped.json.gz": whole[:200] + b"\0" * 40 + whole[240:],
             "x/html.json": b'{"a": 7}\n<html>\n', "x/plain.json": b'{"a": 9}\n', "y/one.json": b'{"a": 4}\n'}
    for name, data in files.items():
        os.makedirs(os.path.dirname(f"{root}/{name}"), exist_ok=True)
        with open(f"{root}/{name}", "wb") as f:
            f.write(data)
    loaded, faults = land.load_entities(spark, {"x": (f"{root}/x", schema), "gone": (f"{root}/gone", schema), "y": (f"{root}/y", schema)})
    assert {e: sorted(r.a for r in df.collect()) for e, df in loaded.items()} == {"x": [1, 2, 9], "y": [4]}
    got = {(r.entity, os.path.basename(r.path)): (r.reason, r.bad_rows) for r in faults.collect()}
    assert got == {("x", "cut.json.gz"): (land.DAMAGED, None), ("x", "flipped.json.gz"): (land.DAMAGED, None), ("x", "html.json"): (land.BAD_ROWS, 1), ("gone", "gone"): (land.MISSING, None)}
    kept = land.quarantine_files(spark, f"{root}/x", faults.where("entity = 'x'"), tempfile.mkdtemp() + "/q").collect()
    assert {os.path.basename(r.path): bytes(r.content) for r in kept} == {k[2:]: v for k, v in files.items() if k[2:] in ("cut.json.gz", "flipped.json.gz", "html.json")}


def test_versions_do_not_depend_on_the_order_of_batches(spark):
    import random

    from sellake.operators import history

    rnd = random.Random(6)
    cols = "entity_name string, source_empresa string, natural_key string, snapshot_date date, run_id string, ingested_at timestamp, record_hash string, record_json string"
    at = lambda: dt.datetime(2024, 1, 1) + dt.timedelta(hours=rnd.randrange(200))
    rows = [("c", "t", f"k{rnd.randrange(4)}", dt.date(2024, 1, 1), f"r{i}", at(), rnd.choice("AB"), "{}") for i in range(60)]
    want = sorted(map(str, history.scd2(spark.createDataFrame(rows, cols)).collect()))
    rnd.shuffle(rows)
    versions, seen = history.scd2(spark.createDataFrame(rows[:25], cols)), rows[:25]
    for i in (25, 40):
        batch = rows[i : i + (15 if i == 25 else 20)]
        seen = seen + batch
        versions = history.refresh_versions(versions, spark.createDataFrame(seen, cols), spark.createDataFrame(batch, cols))
    assert sorted(map(str, versions.collect())) == want


def test_a_filter_on_any_cluster_column_skips_row_groups(spark):
    import pyarrow.parquet as pq

    df = spark.range(20000).select(F.lit("2024-01-05").cast("date").alias("day"), *[F.format_string("%03d", F.pmod(F.xxhash64("id", F.lit(i)), F.lit(500))).alias(f"c{i}") for i in range(4)])
    path = tempfile.mkdtemp() + "/t"
    spark.conf.set("parquet.block.size", "16384")
    try:
        back = land.write_table(df, path, "day", ["c0", "c1", "c2", "c3"])
    finally:
        spark.conf.unset("parquet.block.size")
    assert back.count() == 20000 and sorted(map(tuple, back.drop("_part").collect())) == sorted(map(tuple, df.collect()))
    for c in range(4):
        groups = [g.column(i).statistics for f in _files(path, ".parquet") for m in [pq.read_metadata(f)] for g in map(m.row_group, range(m.num_row_groups)) for i in range(m.num_columns)
                  if g.column(i).path_in_schema == f"c{c}"]
        assert len(groups) >= 8 and sum(g.min <= "123" <= g.max for g in groups) <= 0.7 * len(groups), c
