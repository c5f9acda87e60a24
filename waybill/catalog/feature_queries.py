"""Point-in-time features and data tests."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from waybill.catalog.registry import query, rounded
from waybill.functions.geo import haversine_km
from waybill.operators import quality
from waybill.operators.suite_states import SuiteStates
from waybill.plans import features, model
from waybill.session import materialised, shared_folder
from waybill.sources.driver_tables import DEMO_CUTOFF


@query("seller_cumulative_history", "select * from seller_history")
def seller_cumulative_history(w):
    return features.seller_history(w.stg_orders, w.stg_order_items)


@query("global_cumulative_history", "select * from global_history")
def global_cumulative_history(w):
    return features.global_history(w.stg_orders)


@query("asof_backward_by_key", "select * from seller_before")
def asof_backward_by_key(w):
    return features.seller_known_before(w.stg_orders, w.stg_order_items)


@query("asof_backward_global", "select * from global_before")
def asof_backward_global(w):
    return features.global_known_before(w.stg_orders)


@query(
    "seller_late_rate_smoothed",
    """select order_id, seller_id, round(prior, 9) as prior,
        round(seller_late_rate_smoothed, 9) as seller_late_rate_smoothed
    from smoothed""",
)
def seller_late_rate_smoothed(w):
    rates = features.smoothed_rates(w.stg_orders, w.stg_order_items)
    return rounded(
        rates.select("order_id", "seller_id", "prior", "seller_late_rate_smoothed"),
        9,
        "prior",
        "seller_late_rate_smoothed",
    )


@query(
    "worst_seller_rate",
    "select order_id, round(seller_late_rate_max, 9) as seller_late_rate_max from worst_rates",
)
def worst_seller_rate(w):
    rates = features.smoothed_rates(w.stg_orders, w.stg_order_items)
    return rounded(features.worst_seller_rate(rates), 9, "seller_late_rate_max")


@query(
    "leakage_assert_asof",
    """select count(seller_last_known) as seller_matched,
        count(*) filter (where seller_last_known >= purchased_at) as seller_violations,
        count(global_last_known) as global_matched,
        count(*) filter (where global_last_known >= purchased_at) as global_violations
    from smoothed""",
)
def leakage_assert_asof(w):
    return features.history_leaks(features.smoothed_rates(w.stg_orders, w.stg_order_items))


@query(
    "no_history_orders",
    "select count(*) as n_orders from global_before where global_last_known is null",
)
def no_history_orders(w):
    known = features.global_known_before(w.stg_orders)
    return known.agg(F.count_if(F.col("global_last_known").isNull()).alias("n_orders"))


@query("temporal_features", "select * from temporal")
def temporal_features(w):
    return features.temporal_features(w.stg_orders)


@query(
    "measure_blocks",
    """select i.order_id, i.nb_items, round(i.total_price, 4) as total_price,
        round(i.total_freight, 4) as total_freight, i.nb_distinct_sellers,
        round(i.freight_ratio, 9) as freight_ratio, round(p.total_payment, 4) as total_payment,
        p.nb_payment_installments, p.dominant_payment_type
    from int_order_items i join int_order_payments p on i.order_id = p.order_id""",
)
def measure_blocks(w):
    blocks = features.item_measures(w.int_order_items).join(
        features.payment_measures(w.int_order_payments), "order_id"
    )
    return rounded(rounded(blocks, 4, "total_price", "total_freight", "total_payment"), 9, "freight_ratio")


@query("product_order_agg", "select * from product_sums")
def product_order_agg(w):
    return features.product_features(w.stg_order_items, w.stg_products)


def _pairs(w):
    return features.seller_customer_pairs(
        w.stg_orders, w.stg_order_items, w.stg_customers, w.stg_sellers, w.int_geolocation
    )


@query(
    "geo_double_lookup",
    """select order_id, seller_id, round(customer_lat, 6) as customer_lat,
        round(customer_lng, 6) as customer_lng, round(seller_lat, 6) as seller_lat,
        round(seller_lng, 6) as seller_lng
    from located_pairs""",
)
def geo_double_lookup(w):
    return rounded(_pairs(w), 6, "customer_lat", "customer_lng", "seller_lat", "seller_lng")


@query("haversine_km", "select order_id, seller_id, round(km, 4) as km from pair_km")
def haversine(w):
    km = haversine_km(
        F.col("customer_lat"), F.col("customer_lng"), F.col("seller_lat"), F.col("seller_lng")
    )
    return _pairs(w).select("order_id", "seller_id", F.round(km, 4).alias("km"))


@query(
    "seller_distance_max",
    """select order_id, round(seller_distance_km_max, 4) as seller_distance_km_max, geo_is_unknown
    from distances""",
)
def seller_distance_max(w):
    return rounded(features.seller_distance_max(_pairs(w)), 4, "seller_distance_km_max")


_ROUNDED_FEATURES = """* replace (
    round(seller_late_rate_max, 9) as seller_late_rate_max, round(total_price, 4) as total_price,
    round(total_freight, 4) as total_freight, round(freight_ratio, 9) as freight_ratio,
    round(total_payment, 4) as total_payment,
    round(seller_distance_km_max, 4) as seller_distance_km_max)"""


def _rounded_features(df):
    df = rounded(df, 4, "total_price", "total_freight", "total_payment", "seller_distance_km_max")
    return rounded(df, 9, "seller_late_rate_max", "freight_ratio")


@query("features_orders", f"select {_ROUNDED_FEATURES} from features_orders")
def features_orders(w):
    return _rounded_features(features.features_orders(w))


@query("label_feature_join", f"select {_ROUNDED_FEATURES} from labelled")
def label_feature_join(w):
    return _rounded_features(features.labelled_features(features.features_orders(w), w.fct_orders))


@query(
    "temporal_split",
    f"""select count(*) filter (where date_key < date '{DEMO_CUTOFF}') as n_train,
        count(*) filter (where date_key >= date '{DEMO_CUTOFF}') as n_test,
        max(date_key) filter (where date_key < date '{DEMO_CUTOFF}') as last_train,
        min(date_key) filter (where date_key >= date '{DEMO_CUTOFF}') as first_test
    from fct_orders""",
)
def temporal_split(w):
    return model.split_report(w.order_targets, DEMO_CUTOFF)


_BLOCKS = {
    "base": "stg_orders",
    "seller_late_rate": "worst_rates",
    "temporal": "temporal",
    "items": "int_order_items",
    "payments": "int_order_payments",
    "products": "product_sums",
    "distance": "distances",
}


@query(
    "join_grain_guard",
    " union all ".join(
        f"""select '{b}' as block, coalesce(sum(n), 0)::bigint as n_rows, count(order_id) as n_keys,
            coalesce(max(n), 0)::bigint as max_rows_per_key
        from (select order_id, count(*) as n from {t} group by order_id)"""
        for b, t in _BLOCKS.items()
    ),
)
def join_grain_guard(w):
    return features.feature_grain(w)


# --- data tests ------------------------------------------------------------


@query(
    "dq_unique",
    """select order_item_id, count(*) as n_rows from stg_order_items
    where order_item_id is not null group by 1 having count(*) > 1""",
)
def dq_unique(w):
    return quality.duplicate_keys(w.stg_order_items, "order_item_id")


@query("dq_not_null", "select order_id, date_key from fct_orders where product_key is null")
def dq_not_null(w):
    return quality.null_rows(w.fact("order_id", "date_key", "product_key"), "product_key").drop("product_key")


@query(
    "dq_relationships",
    """select order_id, payment_sequential from stg_order_payments
    where order_id is not null and order_id not in (select order_id from stg_orders)""",
)
def dq_relationships(w):
    found = quality.orphans(w.stg_order_payments, "order_id", w.stg_orders, "order_id")
    return found.select("order_id", "payment_sequential")


# --- fixed values: the declared data tests ---------------------------------
KEY_TESTS = [
    ("raw_orders", "order_id", ("unique", "not_null")),
    ("raw_customers", "customer_id", ("unique", "not_null")),
    ("raw_products", "product_id", ("unique", "not_null")),
    ("raw_sellers", "seller_id", ("unique", "not_null")),
    ("stg_orders", "order_id", ("unique", "not_null")),
    ("stg_customers", "customer_id", ("unique", "not_null")),
    ("stg_sellers", "seller_id", ("unique", "not_null")),
    ("stg_products", "product_id", ("unique", "not_null")),
    ("int_order_items", "order_id", ("unique", "not_null")),
    ("int_order_payments", "order_id", ("unique", "not_null")),
    ("int_order_reviews", "order_id", ("unique", "not_null")),
    ("int_geolocation", "zip_code_prefix", ("unique", "not_null")),
    ("int_orders_enriched", "order_id", ("unique", "not_null")),
    ("dim_date", "date_key", ("unique", "not_null")),
    ("dim_customer", "customer_id", ("unique", "not_null")),
    ("dim_product", "product_key", ("unique", "not_null")),
    ("dim_geography", "geo_key", ("unique", "not_null")),
    ("fct_orders", "order_id", ("unique", "not_null")),
    ("fct_orders", "customer_id", ("not_null",)),
    ("fct_orders", "product_key", ("not_null",)),
    ("fct_orders", "date_key", ("not_null",)),
    ("fct_orders", "geo_key", ("not_null",)),
]
RELATIONSHIP_TESTS = [
    ("stg_orders", "order_id", "int_order_items", "order_id"),
    ("stg_orders", "customer_id", "stg_customers", "customer_id"),
    ("fct_orders", "customer_id", "dim_customer", "customer_id"),
    ("fct_orders", "product_key", "dim_product", "product_key"),
    ("fct_orders", "date_key", "dim_date", "date_key"),
    ("fct_orders", "geo_key", "dim_geography", "geo_key"),
]


def _suite_sql() -> str:
    parts = []
    for table, column, tests in KEY_TESTS:
        head = f"select '{table}' as table_name, '{column}' as column_name"
        if "unique" in tests:
            parts.append(
                f"{head}, 'unique' as test, count(*) as n_failures from (select {column} from {table}"
                f" where {column} is not null group by 1 having count(*) > 1)"
            )
        parts.append(f"{head}, 'not_null' as test, count(*) as n_failures from {table} where {column} is null")
    for child, column, parent, parent_column in RELATIONSHIP_TESTS:
        parts.append(
            f"select '{child}' as table_name, '{column}' as column_name, 'relationships' as test,"
            f" count(*) as n_failures from {child} c where c.{column} is not null and not exists"
            f" (select 1 from {parent} p where p.{parent_column} = c.{column})"
        )
    return " union all ".join(parts)


def suite_tables(w) -> dict:
    names = {t for t, _, _ in KEY_TESTS} | {t for r in RELATIONSHIP_TESTS for t in (r[0], r[2])}
    return {
        n: getattr(w.raw, n.removeprefix("raw_")) if n.startswith("raw_") else getattr(w, n)
        for n in names
    }


@query("dq_suite", _suite_sql())
def dq_suite(w):
    return quality.test_suite(suite_tables(w), KEY_TESTS, RELATIONSHIP_TESTS)


@query("dq_suite_states", f"select * from ({_suite_sql()}) where table_name = 'fct_orders'")
def dq_suite_states(w):
    """The fact's tests from states that three parts of its months were added to one after the other."""
    columns = ["order_id", "customer_id", "product_key", "date_key", "geo_key"]
    fact = materialised(w.fact(*columns).withColumn("ym", F.year("date_key") * 100 + F.month("date_key")))
    parents = {
        "dim_customer": w.dim_customer.select("customer_id"),
        "dim_product": w.dim_product.select("product_key"),
        "dim_date": w.dim_date.select("date_key"),
        "dim_geography": w.dim_geography.select("geo_key"),
    }
    related = {"customer_id": "dim_customer", "product_key": "dim_product", "date_key": "dim_date", "geo_key": "dim_geography"}
    folder = f"{shared_folder(w.raw.spark)}/states-{uuid.uuid4().hex}"
    states = SuiteStates(w.raw.spark, folder, "fct_orders", columns, ["order_id"], related)
    for part in range(3):
        states.add(part, fact.where(F.col("ym") % 3 == part), parents)
    return states.suite(parents)
