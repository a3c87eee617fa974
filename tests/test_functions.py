"""Column functions: trimming, timestamps, numbers, fallbacks, ratios, GPS, pseudonyms, money, hashes."""

import datetime as dt
import hashlib
from decimal import Decimal

import numpy as np
from pyspark.sql import functions as F

from sellake.functions import columns as X
from sellake.functions.hashing import row_hash_expr
from sellake.functions.s2cell import cell_token


def test_clean_str_strips_any_whitespace(spark):
    df = spark.createDataFrame([("  A1 ",), ("\tB\n",), (None,), ("",)], "c string")
    assert [r[0] for r in df.select(X.clean_str("c")).collect()] == ["A1", "B", None, ""]


def test_to_ts_dotnet_decimals_and_garbage(spark):
    vals = ["2021-09-13T14:53:04", "2021-09-13T14:53:04.917", "2021-09-13T14:53:04.917000", "2021-09-13T14:53:04.9170000",
            "garbage", None]
    df = spark.createDataFrame([(v,) for v in vals], "c string")
    out = [r[0] for r in df.select(X.to_ts("c")).collect()]
    assert out[0] == dt.datetime(2021, 9, 13, 14, 53, 4)
    assert out[1] == out[2] == out[3] == dt.datetime(2021, 9, 13, 14, 53, 4, 917000)
    assert out[4] is None and out[5] is None


def test_to_num_bad_text_is_null(spark):
    df = spark.createDataFrame([("12.5",), ("abc",), (None,)], "c string")
    assert [r[0] for r in df.select(X.to_num("c")).collect()] == [Decimal("12.5000000000"), None, None]


def test_first_nonblank_and_safe_ratio(spark):
    df = spark.createDataFrame([("  ", "M", 10.0, 0.0), ("X ", "M", 10.0, 4.0), (None, "M", 1.0, None)], "a string, b string, n double, d double")
    rows = df.select(X.first_nonblank("a", "b").alias("f"), X.safe_ratio("n", "d", 2).alias("r")).collect()
    assert [r.f for r in rows] == ["M", "X", "M"]
    assert [r.r for r in rows] == [None, 2.5, None]


def test_gps_parse_and_classify(spark):
    texts = ["8.5, -64.1", "8.5;-64.1", "8.5/-64.1", "8.5 -64.1", "8.5, - 64.1", "+10.2,-66", "40.4,-3.7", "abc", "", None, "8.5"]
    df = spark.createDataFrame([(t,) for t in texts], "gps string")
    lat, lon = X.gps_lat_lon("gps")
    df = df.select(lat.alias("lat"), lon.alias("lon"))
    valid, state = X.gps_status("lat", "lon")
    rows = df.select("lat", "lon", valid.alias("v"), state.alias("s")).collect()
    assert [(r.lat, r.lon) for r in rows[:6]] == [(8.5, -64.1)] * 5 + [(10.2, -66.0)]
    assert [r.s for r in rows] == ["VALIDO_VENEZUELA"] * 6 + ["FUERA_VENEZUELA"] + ["NO_PARSEABLE"] * 4
    assert [r.v for r in rows] == [True] * 6 + [False] * 5


def test_pseudonymize_matches_python(spark):
    df = spark.createDataFrame([("  Ana@Example.com ",)], "m string")
    got = df.select(X.pseudonymize("m")).first()[0]
    assert got == "usr_" + hashlib.sha256(b"ana@example.com").hexdigest()[:16]


def test_money_rule_decimal(spark):
    df = spark.createDataFrame([(100.0, 16.0, 1.0, 10.0)], "n double, t double, r double, d double")
    m = X.money_columns("n", "t", "r", "d")
    r = df.select(*[c.alias(k) for k, c in m.items()]).first()
    assert r.neto == Decimal("116.00") and r.neto_dcto == Decimal("104.40") and r.tasa == Decimal("1.000000")


def test_row_hash_independent_of_column_order(spark):
    a = spark.createDataFrame([("x", 1.5, None)], "a string, b double, c string")
    b = a.select("c", "b", "a")
    ha = a.select(row_hash_expr(a)).first()[0]
    hb = b.select(row_hash_expr(b)).first()[0]
    assert ha == hb
    expect = hashlib.sha256("\x1f".join(["x", "1.5000000000", "\x00NULL\x00"]).encode()).hexdigest()
    assert ha == expect


def _cells(spark, points, level):
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "n int, lat double, lng double")
    return [r.c for r in df.select("n", cell_token(F.col("lat"), F.col("lng"), level).alias("c")).orderBy("n").collect()]


def test_s2_known_cells(spark):
    poles = [(0.0, 0.0), (90.0, 0.0), (-90.0, 0.0)]
    assert _cells(spark, poles, 30) == ["1000000000000001", "5000000000000001", "b000000000000001"]
    assert _cells(spark, poles + [(None, 1.0)], 0) == ["1", "5", "b", None]
    df = spark.createDataFrame([(1.0, 2.0)], "lat double, lng double").select(cell_token(F.col("lat"), F.col("lng"), 10))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def test_s2_parent_contains_leaf(spark):
    rng = np.random.default_rng(7)
    points = list(zip(rng.uniform(-89, 89, 500).tolist(), rng.uniform(-179, 179, 500).tolist()))
    whole = lambda tokens: [int(t.ljust(16, "0"), 16) for t in tokens]
    leaf = whole(_cells(spark, points, 30))
    assert len(set(leaf)) == 500 and {x >> 61 for x in leaf} == set(range(6))
    for level in (0, 5, 10, 20, 29):
        low = 1 << 2 * (30 - level)
        assert all(p - low + 1 <= x <= p + low - 1 for p, x in zip(whole(_cells(spark, points, level)), leaf))
