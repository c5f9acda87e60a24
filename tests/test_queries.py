"""Registered queries against their SQL on the smallest given tables."""

import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as registered  # noqa: E402
from check_queries import TABLES, compare  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="given tables not present")

CHECKED = """
    stg_orders stg_products int_order_payments latest_review left_join_enrich fct_orders dim_date
    dim_geography order_children_anti flagged_by_segment asof_backward_by_key asof_backward_global
    worst_seller_rate product_order_agg seller_distance_max features_orders average_precision
    ap_by_month threshold_table threshold_top10pct cutoff_comparison kpi_overview priority_orders
    worst_best_groups review_insights rule_independent_vs_priority tfidf_features describe_numeric
    population_funnel src_csv_parse_dates
""".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for table in TABLES:
        c.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    return c


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, con, name):
    _, problems = compare(registered.queries()[name](spark, FOLDER), con, registered.oracle_sql()[name])
    assert not problems


def test_entry_has_rows(spark):
    df = registered.entry(spark)
    assert df.columns == ["customer_state", "product_category_name", "mois", "n_a_risque"]
    assert df.limit(1).count() == 1


def test_every_query_has_a_name_once():
    assert set(registered.oracle_sql()) <= set(registered.queries())
