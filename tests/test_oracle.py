"""Every registered query equals its DuckDB oracle (the driver's gate)."""

import pytest

from conftest import SF001, SF01
from oracle import compare, duck

import __spark_entry__ as entry_mod
from eventide.plans import catalog

KEYS = sorted(catalog.QUERIES)


def test_every_query_has_an_oracle():
    assert set(catalog.ORACLE) == set(KEYS)
    assert set(KEYS) <= set(entry_mod.oracle_sql())
    assert len(KEYS) >= 50


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["hour", "pv"]
    assert df.count() > 0


@pytest.fixture(scope="module")
def con01():
    return duck(SF01)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle_sf01(spark, key, con01):
    r = compare(spark, SF01, key, con01)
    assert r["status"] == "match", r


@pytest.mark.parametrize("key", ["start_latest_scan", "uv_members_merge", "merge_running_total",
                                 "sliding_mean", "ledger_update"])
def test_small_scale_edge(spark, key):
    r = compare(spark, SF001, key)
    assert r["status"] == "match", r
