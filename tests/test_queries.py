"""Registered queries beside their SQL; set WAYFARE_ALL=1 to run them all."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from check_queries import compare, connect

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
USUAL = """io4_daily_extraction io7_write_merged x15_sessions x19_journey_counts x21_date_multiset m3_merge_journeys
m10_drop_one_offs p3_page_event_list p17_reindex_hits p23_event_frequencies n7_edge_weights n11_attach_ends n14_ancestors
n22_titled_edges g9_degrees g14_shortest_path g17_transitivity d9_device_report d13_describe_lengths a7_ratio
a13_difference_interval j9_disruptions_with_exits e13_weighted_sample e17_expand_sessions e26_concentration_curve
e33_top_and_others u2_first_per_client u8_clients_without_journeys""".split()
NAMES = list(QUERIES) if os.environ.get("WAYFARE_ALL") else USUAL


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, name):
    frame = QUERIES[name](spark, SF).toPandas()
    if name in ORACLES:
        assert compare(frame, duck.execute(ORACLES[name]).df()) == "ok"


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).columns == ["src", "dst", "weight"]
