"""Layers are written in sessions that set neither the shuffle partitions nor any other of the scope's settings."""

import datetime as dt

import pytest
from test_round3 import sales_tables
from test_round5 import SETTINGS, now

from sellake.plans import materialize
from sellake.plans.registry import QUERIES
from sellake.session import TASK_SHUFFLE_BYTES, bounded_tasks


@pytest.fixture
def unset(spark):
    """The session with Spark's defaults only."""
    before = now(spark)
    for n in SETTINGS:
        spark.conf.unset(n)
    assert now(spark) == [None, None, None]
    yield spark
    for n, v in zip(SETTINGS, before):
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def test_a_session_without_settings_starts_from_the_defaults_and_gets_them_back(unset):
    with bounded_tasks(unset, 40 << 20):
        assert unset.conf.get(SETTINGS[0]) == "200" and int(unset.conf.get(SETTINGS[1])) == TASK_SHUFFLE_BYTES
    with bounded_tasks(unset, 600 << 20, 128 << 20):
        assert unset.conf.get(SETTINGS[0]) == "300" and int(unset.conf.get(SETTINGS[1])) == 64 << 20
    assert now(unset) == [None, None, None]
    name = dt.datetime.now().isoformat().replace(":", "")
    assert materialize.table(unset, "unset", name, lambda: unset.range(100).groupBy("id").count()).count() == 100
    assert now(unset) == [None, None, None]


def test_queries_run_in_a_session_without_settings(unset):
    d = sales_tables(unset)
    rows = {n: QUERIES[n](unset, d).count() for n in ["A1_batch_registry", "D1_latest_by_key", "G20_period_summary", "G22_gps_coverage"]}
    assert rows == {"A1_batch_registry": 2, "D1_latest_by_key": 5, "G20_period_summary": 2, "G22_gps_coverage": 1}
    assert now(unset) == [None, None, None]
