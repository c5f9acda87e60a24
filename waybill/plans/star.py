"""Marts: one fact at order grain and its dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.fixed_values import CALENDAR_END, CALENDAR_START, UNKNOWN_GEO_KEY
from waybill.functions.dates import boundary_days, sunday_weekday
from waybill.operators.picking import first_child


def _calendar_columns(days: DataFrame) -> DataFrame:
    day = F.col("date_key")
    return days.select(
        "date_key",
        F.dayofmonth(day).alias("jour"),
        F.month(day).alias("mois"),
        F.year(day).alias("annee"),
        sunday_weekday(day).alias("jour_semaine"),
        F.quarter(day).alias("trimestre"),
        sunday_weekday(day).isin(0, 6).alias("is_weekend"),
    )


def dim_date(spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END) -> DataFrame:
    """Every day between two dates, whether or not anything happened on it."""
    span = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return _calendar_columns(spark.range(1).select(F.explode(span).alias("date_key")))


def dim_date_covering(df: DataFrame, time: str) -> DataFrame:
    """Calendar of the full years touched by ``time``; days without rows included."""
    first = F.trunc(F.to_date(F.min(time)), "year")
    last = F.date_sub(F.add_months(F.trunc(F.to_date(F.max(time)), "year"), 12), 1)
    span = df.agg(first.alias("first"), last.alias("last")).filter(F.col("first").isNotNull())
    return _calendar_columns(
        span.select(F.explode(F.sequence("first", "last")).alias("date_key"))
    )


def dim_customer(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id", "customer_state", "customer_city", "customer_zip_code_prefix"
    )


def dim_product(products: DataFrame) -> DataFrame:
    return products.select(
        F.col("product_id").alias("product_key"),
        "product_category_name",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    )


def unknown_geography(geo: DataFrame) -> DataFrame:
    """The one dimension row facts without a known postal code point to."""
    spark = geo.sparkSession
    return spark.range(1).select(
        F.lit(UNKNOWN_GEO_KEY).alias("geo_key"),
        F.lit(UNKNOWN_GEO_KEY).alias("zip_code_prefix"),
        F.lit(None).cast("double").alias("centroid_lat"),
        F.lit(None).cast("double").alias("centroid_lng"),
        F.lit(None).cast("string").alias("state"),
    )


def dim_geography(geo: DataFrame) -> DataFrame:
    known = geo.select(
        F.col("zip_code_prefix").alias("geo_key"),
        "zip_code_prefix",
        "centroid_lat",
        "centroid_lng",
        "state",
    )
    return known.unionByName(unknown_geography(geo))


def customer_geo_keys(customers: DataFrame, geo: DataFrame) -> DataFrame:
    """Customer -> dimension key, with the unknown member for uncovered codes."""
    known = geo.select(F.col("zip_code_prefix").alias("__known"))
    return customers.join(known, F.col("customer_zip_code_prefix") == F.col("__known"), "left").select(
        "customer_id", F.coalesce("__known", F.lit(UNKNOWN_GEO_KEY)).alias("geo_key")
    )


def is_late() -> Column:
    late = F.col("order_delivered_customer_date") > F.col("order_estimated_delivery_date")
    return F.when(late, 1).otherwise(0)


# --- fixed values: columns of the fact, in order ---------------------------
FACT_COLUMNS = [
    "order_id",
    "customer_id",
    "product_key",
    "date_key",
    "geo_key",
    "is_late",
    "nb_items",
    "total_price",
    "total_freight",
    "nb_distinct_sellers",
    "freight_ratio",
    "delay_est_days",
]
ITEM_MEASURES = {"nb_items", "total_price", "total_freight", "nb_distinct_sellers", "freight_ratio"}


ENRICHED_ONLY = [
    "order_purchase_timestamp",
    "order_estimated_delivery_date",
    "order_delivered_customer_date",
    "review_score",
]


def order_rows(
    orders: DataFrame,
    order_items: DataFrame,
    items: DataFrame,
    reviews: DataFrame,
    customers: DataFrame,
    geo: DataFrame,
    columns: Sequence[str],
) -> DataFrame:
    """The asked fact and order columns, one row per delivered order.

    Every join is a left join to at most one row, so a join whose columns are
    not asked for can be left out. Spark cannot know that, so it is done here.
    Joins on the order come first and share one partitioning.
    """
    asked = set(columns)
    rows = orders
    if asked & ITEM_MEASURES:
        rows = rows.join(order_items, "order_id", "left")
    if "product_key" in asked:
        principal = first_child(items, "order_id", "order_item_id", "product_id", "product_key")
        rows = rows.join(principal, "order_id", "left")
    if "review_score" in asked:
        rows = rows.join(reviews.select("order_id", "review_score"), "order_id", "left")
    if "geo_key" in asked:
        rows = rows.join(customer_geo_keys(customers, geo), "customer_id", "left")
    bought, promised = F.col("order_purchase_timestamp"), F.col("order_estimated_delivery_date")
    derived = {
        "date_key": F.to_date(bought),
        "is_late": is_late(),
        "delay_est_days": boundary_days(bought, promised),
    }
    return rows.select(*[derived[c].alias(c) if c in derived else F.col(c) for c in columns])
