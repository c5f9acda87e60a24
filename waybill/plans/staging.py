"""Staging: same grain as the source, cleaned and typed. Nothing is aggregated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.fixed_values import LATITUDE_RANGE, LONGITUDE_RANGE, UNKNOWN_CATEGORY


def _timestamp(name: str) -> Column:
    return F.col(name).cast("timestamp_ntz").alias(name)


def postal_code(code: Column) -> Column:
    return F.lpad(code.cast("string"), 5, "0")


def stg_orders(raw: DataFrame) -> DataFrame:
    """Delivered orders with a delivery date; flags impossible date orders, drops none."""
    delivered = F.col("order_delivered_customer_date").cast("timestamp_ntz")
    estimated = F.col("order_estimated_delivery_date").cast("timestamp_ntz")
    purchase = F.col("order_purchase_timestamp").cast("timestamp_ntz")
    return raw.filter(
        (F.col("order_status") == "delivered") & F.col("order_delivered_customer_date").isNotNull()
    ).select(
        "order_id",
        "customer_id",
        _timestamp("order_purchase_timestamp"),
        _timestamp("order_approved_at"),
        _timestamp("order_estimated_delivery_date"),
        _timestamp("order_delivered_carrier_date"),
        _timestamp("order_delivered_customer_date"),
        ((delivered < purchase) | (estimated < purchase)).alias("has_temporal_inconsistency"),
    )


def stg_order_items(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_id",
        F.col("order_item_id").cast("int").alias("order_item_id"),
        "product_id",
        "seller_id",
        _timestamp("shipping_limit_date"),
        F.col("price").cast("double").alias("price"),
        F.col("freight_value").cast("double").alias("freight_value"),
    ).filter((F.col("price") > 0) & (F.col("freight_value") >= 0))


def stg_order_payments(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_id",
        F.col("payment_sequential").cast("int").alias("payment_sequential"),
        "payment_type",
        F.col("payment_installments").cast("int").alias("payment_installments"),
        F.col("payment_value").cast("double").alias("payment_value"),
    ).filter(F.col("payment_value") >= 0)


def stg_order_reviews(raw: DataFrame) -> DataFrame:
    return raw.select(
        "review_id",
        "order_id",
        F.col("review_score").cast("int").alias("review_score"),
        "review_comment_title",
        "review_comment_message",
        _timestamp("review_creation_date"),
        _timestamp("review_answer_timestamp"),
    )


def stg_customers(raw: DataFrame) -> DataFrame:
    return raw.select(
        "customer_id",
        "customer_unique_id",
        postal_code(F.col("customer_zip_code_prefix")).alias("customer_zip_code_prefix"),
        F.upper(F.trim("customer_state")).alias("customer_state"),
        F.lower(F.trim("customer_city")).alias("customer_city"),
    )


def stg_sellers(raw: DataFrame) -> DataFrame:
    return raw.select(
        "seller_id",
        postal_code(F.col("seller_zip_code_prefix")).alias("seller_zip_code_prefix"),
        F.upper(F.trim("seller_state")).alias("seller_state"),
        F.lower(F.trim("seller_city")).alias("seller_city"),
    )


def stg_products(raw: DataFrame, translation: DataFrame) -> DataFrame:
    names = translation.select(
        F.col("product_category_name").alias("__source_name"), "product_category_name_english"
    )
    joined = raw.join(names, F.col("product_category_name") == F.col("__source_name"), "left")
    return joined.select(
        "product_id",
        F.coalesce("product_category_name_english", F.lit(UNKNOWN_CATEGORY)).alias("product_category_name"),
        *[
            F.col(c).cast("double").alias(c)
            for c in ("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")
        ],
        F.col("product_name_lenght").cast("int").alias("product_name_length"),
        F.col("product_description_lenght").cast("int").alias("product_description_length"),
        F.col("product_photos_qty").cast("int").alias("product_photos_qty"),
    )


def stg_geolocation(raw: DataFrame) -> DataFrame:
    """Points inside the country's bounding box."""
    return raw.select(
        postal_code(F.col("geolocation_zip_code_prefix")).alias("zip_code_prefix"),
        F.col("geolocation_lat").cast("double").alias("lat"),
        F.col("geolocation_lng").cast("double").alias("lng"),
        F.lower(F.trim("geolocation_city")).alias("city"),
        F.upper(F.trim("geolocation_state")).alias("state"),
    ).filter(F.col("lat").between(*LATITUDE_RANGE) & F.col("lng").between(*LONGITUDE_RANGE))
