"""Sources, staging, order grain, star schema and their joins."""

from __future__ import annotations

import uuid
from types import SimpleNamespace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.catalog.demo import demo_drivers, demo_scores, rule_insights
from waybill.catalog.registry import query, rounded
from waybill.operators.picking import first_child
from waybill.operators.quality import orphans
from waybill.plans import exports, features, order_grain, profile, star
from waybill.plans import reports as bi
from waybill.plans.warehouse import Warehouse
from waybill.session import shared_folder
from waybill.sources import csv_tables, storage

MONEY = ("total_price", "total_freight", "freight_ratio")


def _fresh_folder(w, purpose: str) -> str:
    return f"{shared_folder(w.raw.spark)}/{purpose}-{uuid.uuid4().hex}"


# --- sources and sinks -----------------------------------------------------


def _csv_copies(w, names: list[str], compression: str = "none") -> dict[str, DataFrame]:
    """The raw tables written as CSV files and read back through the manifest."""
    folder = _fresh_folder(w, "csv")
    for name in names:
        raw = getattr(w.raw, name).select(*csv_tables.RAW_COLUMNS[name])
        csv_tables.write_csv(raw, f"{folder}/{name}.csv", compression)
    return csv_tables.read_raw(w.raw.spark, folder, {n: f"{n}.csv" for n in names})


@query(
    "src_csv_bulk",
    " union all ".join(
        f"select '{t}' as table_name, count(*) as n_rows from raw_{t}" for t in csv_tables.RAW_COLUMNS
    ),
)
def src_csv_bulk(w):
    return csv_tables.row_counts(_csv_copies(w, list(csv_tables.RAW_COLUMNS)))


@query(
    "src_csv_review_texts",
    "select review_id, review_comment_title, review_comment_message from raw_order_reviews",
)
def src_csv_review_texts(w):
    """Review texts with line breaks and quotes survive the CSV round trip."""
    reviews = _csv_copies(w, ["order_reviews"])["order_reviews"]
    return reviews.select(F.col("review_id").cast("bigint").alias("review_id"), "review_comment_title", "review_comment_message")


@query(
    "src_csv_split",
    "select review_id, order_id, review_score, review_comment_title, review_comment_message from raw_order_reviews",
)
def src_csv_split(w):
    """The reviews as a few large files whose texts hold line breaks, their columns in another order, read in blocks by many tasks.

    A file holds what four blocks of the texts do, so one task writes no more, however many texts there are.
    """
    spark, path = w.raw.spark, f"{_fresh_folder(w, 'csv')}/reviews.csv"
    columns = csv_tables.RAW_COLUMNS["order_reviews"]
    blocks = w.raw.given("documents").rdd.getNumPartitions()
    rows = w.raw.order_reviews.select(*reversed(columns)).withColumn("further", F.lit("a\nb"))
    csv_tables.write_csv(rows.coalesce(max(1, -(-blocks // 4))), path)
    reviews = csv_tables.read_csv(spark, path, columns, multi_line=True)
    ids = {c: F.col(c).cast("int" if c == "review_score" else "bigint") for c in ("review_id", "order_id", "review_score")}
    return reviews.withColumns(ids).select(*ids, "review_comment_title", "review_comment_message")


def _csv_warehouse(w, compression: str = "none") -> Warehouse:
    return Warehouse(SimpleNamespace(**_csv_copies(w, list(csv_tables.RAW_COLUMNS), compression)))


@query(
    "csv_fct_orders",
    "select order_id, customer_id, product_key, date_key, geo_key, is_late, nb_items, round(total_price, 4) as total_price,"
    " nb_distinct_sellers, delay_est_days from fct_orders",
)
def csv_fct_orders(w):
    """The fact built from CSV copies of the raw tables, keys being text until the end."""
    fact = rounded(_csv_warehouse(w).fct_orders, 4, "total_price").drop("total_freight", "freight_ratio")
    return fact.withColumns({c: F.col(c).cast("bigint") for c in ("order_id", "customer_id", "product_key")})


@query(
    "csv_features_orders",
    "select order_id, round(seller_late_rate_max, 9) as seller_late_rate_max, purchase_weekday, delay_est_days, nb_items,"
    " dominant_payment_type, product_weight_g_sum, nb_distinct_categories,"
    " round(seller_distance_km_max, 4) as seller_distance_km_max, geo_is_unknown from features_orders",
)
def csv_features_orders(w):
    """Features from CSV copies of the raw tables, compressed: they stay on disk beside all that the features write.

    Items are read once, so they aren't written a second time.
    """
    table = features.features_orders(_csv_warehouse(w, "gzip"))
    table = rounded(rounded(table, 9, "seller_late_rate_max"), 4, "seller_distance_km_max")
    return table.select(
        F.col("order_id").cast("bigint").alias("order_id"), "seller_late_rate_max", "purchase_weekday", "delay_est_days",
        "nb_items", "dominant_payment_type", "product_weight_g_sum", "nb_distinct_categories", "seller_distance_km_max",
        "geo_is_unknown",
    )


@query(
    "src_csv_parse_dates",
    """select order_id, order_status, order_purchase_timestamp, order_approved_at,
        order_delivered_carrier_date, order_delivered_customer_date, order_estimated_delivery_date
    from raw_orders""",
)
def src_csv_parse_dates(w):
    dates = [c for c in csv_tables.RAW_COLUMNS["orders"] if c.endswith(("_timestamp", "_at", "_date"))]
    parsed = csv_tables.parse_timestamps(_csv_copies(w, ["orders"])["orders"], dates)
    return parsed.select(F.col("order_id").cast("bigint").alias("order_id"), "order_status", *dates)


@query("src_seed", "select * from raw_category_translation")
def src_seed(w):
    return _csv_copies(w, ["category_translation"])["category_translation"]


def _exported(w) -> tuple[str, list[str]]:
    folder = _fresh_folder(w, "export")
    sizes = exports.export_dashboard(w, demo_scores(w), demo_drivers(w), rule_insights(w), folder, 1 << 40)
    return folder, list(sizes)


@query(
    "src_parquet_views",
    """select d.feature_name, s.risk_tier, count(*) as n
    from scores s join drivers d on s.order_id = d.order_id
    where d.driver_rank = 1 and not s.is_in_sample group by all""",
)
def src_parquet_views(w):
    spark = w.raw.spark
    folder, names = _exported(w)
    storage.register_snapshots(spark, folder, names)
    return spark.sql("""
        SELECT d.feature_name, s.risk_tier, count(*) AS n
        FROM order_risk_scores s JOIN order_risk_drivers d ON s.order_id = d.order_id
        WHERE d.driver_rank = 1 AND NOT s.is_in_sample
        GROUP BY d.feature_name, s.risk_tier""")


@query("sink_replace_table", "select order_id, date_key, is_late, geo_key from fct_orders")
def sink_replace_table(w):
    path = f"{_fresh_folder(w, 'replace')}/fct_orders.parquet"
    narrow = w.fact("order_id", "date_key", "is_late", "geo_key")
    storage.replace_table(narrow, path)
    return storage.replace_table(narrow, path)


@query("sink_replace_self", "select order_id, 2 - is_late::integer as is_late, geo_key from fct_orders where is_late = 1")
def sink_replace_self(w):
    """A table is replaced by what is read from itself, twice."""
    path = f"{_fresh_folder(w, 'replace')}/fct_orders.parquet"
    stored = storage.replace_table(w.fact("order_id", "is_late", "geo_key"), path)
    stored = storage.replace_table(stored.where("is_late = 1").withColumn("is_late", F.col("is_late") + 1), path)
    return storage.replace_table(stored.withColumn("is_late", (3 - F.col("is_late")).cast("int")), path)


_EXPORT_COUNTS = """
    select 'fct_orders' as table_name, count(*) as n_rows from fct_orders
    union all select 'dim_customer', count(distinct customer_id) from fct_orders
        where customer_id in (select customer_id from dim_customer)
    union all select 'dim_product', count(distinct product_key) from fct_orders
        where product_key in (select product_key from dim_product)
    union all select 'dim_date', count(distinct date_key) from fct_orders
    union all select 'int_orders_enriched', count(*) from int_orders_enriched
    union all select 'order_risk_scores', count(*) from scores
    union all select 'order_risk_drivers', count(*) from drivers where driver_rank = 1
    union all select 'review_insights', count(*) from insights"""


@query("sink_parquet_export", _EXPORT_COUNTS)
def sink_parquet_export(w):
    folder, names = _exported(w)
    spark = w.raw.spark
    return csv_tables.row_counts({n: storage.read_snapshot(spark, folder, n) for n in names})


@query(
    "export_manifest",
    f"select *, true as has_size, '2020-01-01 00:00' as exported_at from ({_EXPORT_COUNTS})",
)
def export_manifest(w):
    """Sizes depend on the writer, so only that there are any is compared."""
    folder, names = _exported(w)
    listed = storage.manifest(w.raw.spark, folder, names, "2020-01-01 00:00:00")
    at = F.date_format("exported_at", "yyyy-MM-dd HH:mm").alias("exported_at")
    return listed.select("table_name", "n_rows", (F.col("size_bytes") > 0).alias("has_size"), at)


@query(
    "export_dim_semi",
    """select distinct p.product_key, p.product_category_name
    from dim_product p join fct_orders o on o.product_key = p.product_key""",
)
def export_dim_semi(w):
    return exports.referenced_members(
        w.dim_product, w.fact("product_key"), "product_key", ["product_key", "product_category_name"]
    )


# --- staging ---------------------------------------------------------------


@query("stg_orders", "select * from stg_orders")
def stg_orders(w):
    return w.stg_orders


@query("stg_order_items", "select * from stg_order_items")
def stg_order_items(w):
    return w.stg_order_items


@query("stg_payments", "select * from stg_order_payments")
def stg_payments(w):
    return w.stg_order_payments


@query("stg_reviews", "select * from stg_order_reviews")
def stg_reviews(w):
    return w.stg_order_reviews


@query("stg_customers", "select * from stg_customers")
def stg_customers(w):
    return w.stg_customers


@query("stg_sellers", "select * from stg_sellers")
def stg_sellers(w):
    return w.stg_sellers


@query("stg_products", "select * from stg_products")
def stg_products(w):
    return w.stg_products


@query("stg_geolocation", "select * from stg_geolocation")
def stg_geolocation(w):
    return w.stg_geolocation


# --- order grain -----------------------------------------------------------


@query(
    "agg_order_items",
    """select order_id, nb_items, round(total_price, 4) as total_price,
        round(total_freight, 4) as total_freight, nb_distinct_sellers,
        round(freight_ratio, 9) as freight_ratio
    from int_order_items""",
)
def agg_order_items(w):
    return rounded(rounded(w.int_order_items, 4, "total_price", "total_freight"), 9, "freight_ratio")


@query(
    "agg_payments",
    """select order_id, round(sum(payment_value), 4) as total_payment,
        max(payment_installments) as nb_payment_installments
    from stg_order_payments group by order_id""",
)
def agg_payments(w):
    return rounded(order_grain.payment_totals(w.stg_order_payments), 4, "total_payment")


@query(
    "dominant_category",
    "select order_id, arg_min(payment_type, (-paid, payment_type)) as dominant_payment_type from paid_by_type group by 1",
)
def dominant_category(w):
    return order_grain.dominant_payment(w.stg_order_payments)


@query(
    "int_order_payments",
    """select order_id, round(total_payment, 4) as total_payment, nb_payment_installments,
        dominant_payment_type from int_order_payments""",
)
def int_order_payments(w):
    return rounded(w.int_order_payments, 4, "total_payment")


@query("latest_review", "select * from int_order_reviews")
def latest_review(w):
    return w.int_order_reviews


@query(
    "geo_centroid",
    """select zip_code_prefix, round(centroid_lat, 6) as centroid_lat,
        round(centroid_lng, 6) as centroid_lng, state from int_geolocation""",
)
def geo_centroid(w):
    return rounded(w.int_geolocation, 6, "centroid_lat", "centroid_lng")


_ENRICHED = """select * replace (round(total_price, 4) as total_price, round(total_freight, 4) as total_freight,
        round(freight_ratio, 9) as freight_ratio, round(total_payment, 4) as total_payment)
    from int_orders_enriched"""


def _rounded_enriched(enriched):
    return rounded(rounded(enriched, 4, "total_price", "total_freight", "total_payment"), 9, "freight_ratio")


@query("left_join_enrich", _ENRICHED)
def left_join_enrich(w):
    return _rounded_enriched(w.int_orders_enriched)


@query("stored_left_join_enrich", _ENRICHED)
def stored_left_join_enrich(w):
    """The same join over tables stored in buckets of the order: nothing is shuffled for it."""
    return _rounded_enriched(w.enriched(w.build_intermediate(_fresh_folder(w, "warehouse"), 8)))


# --- star schema -----------------------------------------------------------


@query("dim_date", "select * from dim_date")
def dim_date(w):
    return w.dim_date


@query("dim_customer", "select * from dim_customer")
def dim_customer(w):
    return w.dim_customer


@query("dim_product", "select * from dim_product")
def dim_product(w):
    return w.dim_product


@query(
    "dim_geography",
    """select * replace (round(centroid_lat, 6) as centroid_lat, round(centroid_lng, 6) as centroid_lng)
    from dim_geography""",
)
def dim_geography(w):
    return rounded(w.dim_geography, 6, "centroid_lat", "centroid_lng")


@query("union_sentinel", "select geo_key, state from dim_geography")
def union_sentinel(w):
    return w.dim_geography.select("geo_key", "state")


@query(
    "fct_orders",
    """select * replace (round(total_price, 4) as total_price, round(total_freight, 4) as total_freight,
        round(freight_ratio, 9) as freight_ratio) from fct_orders""",
)
def fct_orders(w):
    return rounded(rounded(w.fct_orders, 4, "total_price", "total_freight"), 9, "freight_ratio")


@query("unknown_member_fk", "select * from customer_geo")
def unknown_member_fk(w):
    return star.customer_geo_keys(w.stg_customers, w.int_geolocation)


@query(
    "first_child_lookup",
    """select o.order_id, f.product_key from stg_orders o
    left join first_items f on o.order_id = f.order_id""",
)
def first_child_lookup(w):
    first = first_child(w.stg_order_items, "order_id", "order_item_id", "product_id", "product_key")
    return w.stg_orders.select("order_id").join(first, "order_id", "left")


@query(
    "first_row_per_key",
    """select order_id, seller_id from raw_order_items
    qualify row_number() over (partition by order_id order by order_item_id, seller_id) = 1""",
)
def first_row_per_key(w):
    return profile.first_sellers(w.raw.order_items)


@query("distinct_pairs_join", "select * from pairs")
def distinct_pairs_join(w):
    return features.order_seller_outcomes(w.stg_orders, w.stg_order_items)


@query(
    "order_children_anti",
    """select 'items_without_order' as kind, count(*) as n, count(distinct order_id) as n_orders
    from stg_order_items where order_id not in (select order_id from stg_orders)
    union all
    select 'orders_without_items', count(*), count(distinct order_id)
    from raw_orders where order_id not in (select order_id from stg_order_items)""",
)
def order_children_anti(w):
    def summary(kind, df):
        per_order = df.groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))
        return per_order.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("order_id").alias("n_orders")
        ).withColumn("kind", F.lit(kind))

    lost_items = orphans(w.stg_order_items, "order_id", w.stg_orders, "order_id")
    childless = orphans(w.raw.orders, "order_id", w.stg_order_items, "order_id")
    return summary("items_without_order", lost_items).unionByName(
        summary("orders_without_items", childless)
    )


@query(
    "star_join_bi",
    """select * replace (round(total_price, 4) as total_price) from bi_base
    where annee * 100 + mois between 199601 and 200012""",
)
def star_join_bi(w):
    return rounded(bi.bi_base(w, bi.Filters(199601, 200012)), 4, "total_price")


@query("star_join_pred", "select * replace (round(total_price, 4) as total_price) from pred_base")
def star_join_pred(w):
    return rounded(bi.prediction_base(w, demo_scores(w)), 4, "total_price")


@query(
    "flagged_by_segment",
    """select customer_state, product_category_name, annee || '-' || lpad(mois::varchar, 2, '0') as mois,
        coalesce(sum(is_flagged_risk::integer), 0)::bigint as n_a_risque
    from described join (from scores where not is_in_sample) using (order_id)
    group by all order by n_a_risque desc, 1, 2, 3""",
)
def flagged_by_segment(w):
    return bi.flagged_by_segment(w, demo_scores(w))


def _stored(w):
    return w.build(_fresh_folder(w, "warehouse"))


@query("stored_fct_orders", "select order_id, product_key, date_key, geo_key, is_late, nb_items, delay_est_days from fct_orders")
def stored_fct_orders(w):
    """The fact read back from a written warehouse."""
    return _stored(w).fact("order_id", "product_key", "date_key", "geo_key", "is_late", "nb_items", "delay_est_days")
