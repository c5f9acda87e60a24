"""Intermediate layer: children are reduced to one row per order before any join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.functions.numbers import safe_ratio
from waybill.operators.picking import best_per_key, dominant_category, newest_first


def int_order_items(items: DataFrame) -> DataFrame:
    """Counts, sums and the number of sellers, pre-reduced per (order, seller).

    The first step combines on the map side, so neither a hot order nor the
    distinct count ever gathers item rows in one task.
    """
    return order_totals(
        items.groupBy("order_id", "seller_id").agg(
            F.count(F.lit(1)).alias("n"), F.sum("price").alias("price"), F.sum("freight_value").alias("freight")
        )
    )


def order_totals(per_seller: DataFrame) -> DataFrame:
    return per_seller.groupBy("order_id").agg(
        F.sum("n").alias("nb_items"),
        F.sum("price").alias("total_price"),
        F.sum("freight").alias("total_freight"),
        F.count("seller_id").alias("nb_distinct_sellers"),
        safe_ratio(F.sum("freight"), F.sum("price")).alias("freight_ratio"),
    )


def payment_totals(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(
        F.sum("payment_value").alias("total_payment"),
        F.max("payment_installments").alias("nb_payment_installments"),
    )


def int_order_payments(payments: DataFrame) -> DataFrame:
    """Totals and the type that paid most, from one reduction per (order, type)."""
    per_type = payments.groupBy("order_id", "payment_type").agg(
        F.sum("payment_value").alias("paid"),
        F.max("payment_installments").alias("installments"),
    )
    rounded = -F.round("paid", 6)
    strongest = F.min(F.struct(rounded.alias("less"), F.col("payment_type").alias("pick")))
    return per_type.groupBy("order_id").agg(
        F.sum("paid").alias("total_payment"),
        F.max("installments").alias("nb_payment_installments"),
        strongest["pick"].alias("dominant_payment_type"),
    )


def dominant_payment(payments: DataFrame) -> DataFrame:
    return dominant_category(
        payments, "order_id", "payment_type", "payment_value", "dominant_payment_type"
    )


def latest_reviews(reviews: DataFrame) -> DataFrame:
    """The most recent review per order with all its columns, ties by review id."""
    order = newest_first(F.col("review_creation_date")) + [F.col("review_id")]
    return best_per_key(reviews, ["order_id"], order)


def int_order_reviews(reviews: DataFrame) -> DataFrame:
    narrow = reviews.select("order_id", "review_id", "review_score", "review_creation_date")
    return latest_reviews(narrow).select(
        "order_id",
        "review_id",
        "review_score",
        "review_creation_date",
        (F.col("review_score") <= 2).alias("is_negative"),
        (F.col("review_score") >= 4).alias("is_positive"),
    )


def int_geolocation(points: DataFrame) -> DataFrame:
    return points.groupBy("zip_code_prefix").agg(
        F.avg("lat").alias("centroid_lat"),
        F.avg("lng").alias("centroid_lng"),
        F.max("state").alias("state"),
    )


def int_orders_enriched(
    orders: DataFrame, items: DataFrame, payments: DataFrame, reviews: DataFrame
) -> DataFrame:
    """Orders with their item, payment and review summaries. All inputs at order grain."""
    return (
        orders.join(items, "order_id", "left")
        .join(payments, "order_id", "left")
        .join(reviews.drop("review_id", "review_creation_date"), "order_id", "left")
    )
