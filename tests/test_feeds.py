"""The feeds of `plans/feeds.py` trigger the rule they are for: without the operator the result would differ."""

import pytest

import __spark_entry__  # noqa: F401  (it registers the queries)
from tests.oracle import connect
from tradewind.plans.registry import REGISTRY, with_ctes

# What a query would count if its operator did nothing, and what it counts.
WITHOUT = {
    "dedup_repeated_lines": ("SELECT COUNT(*) FROM r_order_items", "SELECT COUNT(*) FROM ({})"),
    "duplicate_profile_whole_rows": ("SELECT 0", "SELECT SUM(duplicate_rows) FROM ({})"),
    "monthly_sales_few_cancellations": ("SELECT 0", "SELECT COUNT(*) FROM ({}) WHERE number_of_cancellations = 0"),
    "repeat_rate_with_single_orders": ("SELECT 0", "SELECT COUNT(*) FROM ({}) WHERE repeat_customers = 0"),
    "geo_semi_unknown_zips": ("SELECT COUNT(*) FROM r_geolocation", "SELECT COUNT(*) FROM ({})"),
    "fine_category_month_pivot": ("SELECT 0", "SELECT COUNT(*) FROM ({}) WHERE month_1 IS NULL OR month_7 IS NULL"),
    "daily_sales_by_user": ("SELECT COUNT(*) FROM d_user_days", "SELECT COUNT(*) FROM ({})"),
    "merged_edge_scores": ("SELECT 4", "SELECT MAX(flag_score) FROM ({})"),
    "potential_b2b_top_tenth": ("SELECT COUNT(*) FROM d_rfm_v3", "SELECT COUNT(*) FROM ({})"),
}


@pytest.mark.parametrize("name", sorted(WITHOUT))
def test_feed_triggers_its_rule(name):
    connection = connect("/root/testdata/sf0.01")
    without, counted = WITHOUT[name]
    got = connection.execute(counted.format(REGISTRY[name].sql)).fetchone()
    assert got[0] and got != connection.execute(with_ctes(without)).fetchone()
