"""The shapes of plans that matter at scale."""

import re

import pytest

from envstream.checks import queries as Q
from helpers import physical_text, plan_text

LARGE = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture
def large(spark):
    """Plans as they look when no side is small enough to broadcast."""
    for key, value in LARGE.items():
        spark.conf.set(key, value)
    yield spark
    for key in LARGE:
        spark.conf.unset(key)


def test_json_is_decoded_once_per_side(large, sf_dir):
    assert plan_text(Q.unified(large, sf_dir)).count("from_json") == 2
    assert plan_text(Q.flatten_air(large, sf_dir)).count("from_json") == 1


def test_unified_plan(large, sf_dir):
    df = Q.unified(large, sf_dir)
    plan = physical_text(df)
    # two for the distincts, two for the join; copies are merged before the first two
    assert plan.count("Exchange hashpartitioning") == 4
    assert plan.count("HashAggregate") == 4 and "SortAggregate" not in plan
    assert "SortMergeJoin" in plan and "BroadcastNestedLoop" not in plan and "Cartesian" not in plan
    assert plan.index("HashAggregate") < plan.index("atleastnnonnulls")
    assert "PushedFilters: [IsNotNull(event_type), Not(EqualTo(event_type,error))]" in plan
    assert "props" not in plan


def test_time_is_worked_out_before_entries_are_unnested(large, sf_dir):
    lines = physical_text(Q.flatten_air(large, sf_dir)).splitlines()
    entries = next(i for i, line in enumerate(lines) if "explode(entries" in line)
    assert not any("regexp_extract" in line for line in lines[:entries])
    assert any("regexp_extract" in line for line in lines[entries:])


@pytest.mark.parametrize("name", ["first_per_key", "last_per_name", "fact_air", "insert_if_absent"])
def test_one_row_per_key_is_picked_before_the_shuffle(large, sf_dir, name):
    plan = physical_text(getattr(Q, name)(large, sf_dir))
    assert re.search(r"row_number\(\), 1, Partial", plan) and re.search(r"row_number\(\), 1, Final", plan)


def test_grouping_takes_one_shuffle(large, sf_dir):
    plan = physical_text(Q.regroup_air(large, sf_dir))
    assert plan.count("Exchange") == 1


@pytest.mark.parametrize("query", Q.QUERIES, ids=lambda q: q.__name__)
def test_no_python_and_no_cross_join(large, sf_dir, query):
    if query.__name__.startswith(("stream_", "rf_", "scaled_", "metrics_row")):
        pytest.skip("result is read back from files or fitted first")
    plan = physical_text(query(large, sf_dir))
    assert not re.search(r"Python|Pandas|Arrow|BroadcastNestedLoop|CartesianProduct", plan)


def test_weekly_requests_need_no_join(large, sf_dir):
    plan = physical_text(Q.fetch_plan(large, sf_dir))
    assert "Join" not in plan and "Exchange" not in plan


def test_catalogue_reads_two_columns(large, sf_dir):
    plan = physical_text(Q.catalogue_by_country(large, sf_dir))
    assert "ReadSchema: struct<c_custkey:bigint,c_mktsegment:string>" in plan
    assert "EqualTo(c_mktsegment,FURNITURE)" in plan


def test_first_timestamps_are_a_top_k(large, sf_dir):
    assert "TakeOrderedAndProject" in physical_text(Q.first_n_timestamps(large, sf_dir))
