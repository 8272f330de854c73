"""Every registered query against its SQL, and the shape of the plans that matter at scale."""

import re

import pytest

import __spark_entry__ as entry
from checks.compare import compare, connect
from checks.queries import QUERIES
from pulselake.session import configure


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql()) and len(QUERIES) > 80


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_its_sql(spark, duck, sf_dir, name):
    assert compare(spark, duck, name, sf_dir) is None


def plan(spark, sf_dir, name):
    return QUERIES[name](configure(spark), sf_dir)._jdf.queryExecution().executedPlan().toString()


def test_fatigue_needs_one_exchange_beyond_the_deduplications(spark, sf_dir):
    text = plan(spark, sf_dir, "q_gold_fatigue")
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 4  # three sources and one grouping
    assert "SortMergeJoin" not in text and "BroadcastHashJoin" not in text


def test_scan_gets_filter_and_only_needed_columns(spark, sf_dir):
    text = plan(spark, sf_dir, "q_sleep_daily")
    assert "EqualTo(event_type,error)" in text
    assert re.search(r"ReadSchema: struct<([^>]*)>", text).group(1).count("value") == 0


@pytest.mark.parametrize("name", ["q_gold_community", "q_mart_health_score", "q_reconcile", "q_enrich_events",
                                  "q_dq_no_dropped_rows", "q_dq_grain", "q_profile_scd2_ranges"])
def test_no_cartesian_products(spark, sf_dir, name):
    text = plan(spark, sf_dir, name)
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
