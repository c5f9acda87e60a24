"""Stand-in scores, drivers and insights derived from the given orders and texts,
so reports can be checked exactly without a fitted model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.plans import model, themes
from waybill.sources.driver_tables import (
    DEMO_CUTOFF,
    DEMO_Q90,
    DEMO_THEMES,
    demo_probability,
)

# --- fixed values: feature names of the stand-in drivers -------------------
DEMO_DRIVER_NAMES = [
    "num__delay_est_days",
    "num__seller_distance_km_max",
    "num__seller_late_rate_max",
    "num__total_freight",
    "num__other",
]


def labelled_orders(w) -> DataFrame:
    return w.order_targets


def demo_probabilities(w) -> DataFrame:
    return labelled_orders(w).select(
        "*",
        model.in_train(DEMO_CUTOFF).alias("is_in_sample"),
        demo_probability(F.col("order_id")).alias("probability"),
    )


def demo_scores(w) -> DataFrame:
    """Scores need no fact measures, only the order and its date."""
    orders = w.stg_orders.select(
        "order_id",
        F.to_date("order_purchase_timestamp").alias("date_key"),
        demo_probability(F.col("order_id")).alias("probability"),
    )
    return model.risk_scores(orders, DEMO_Q90, DEMO_CUTOFF, "2020-01-01").drop("scored_at")


def two_models(w) -> DataFrame:
    base = demo_probabilities(w)
    second = (((F.col("order_id") % 1000) * 617) % 1000).cast("double") / F.lit(1000.0).cast("double")
    return base.withColumn("model", F.lit("first")).unionByName(
        base.withColumns({"model": F.lit("second"), "probability": second})
    )


def demo_drivers(w) -> DataFrame:
    names = F.array(*[F.lit(n) for n in DEMO_DRIVER_NAMES])
    rank, key = F.col("driver_rank"), F.col("order_id")
    ranked = w.stg_orders.select("order_id", F.explode(F.array(*[F.lit(i) for i in (1, 2, 3)])).alias("driver_rank"))
    return ranked.select(
        "order_id",
        "driver_rank",
        F.get(names, ((key * 7 + rank * 3) % 5).cast("int")).alias("feature_name"),
        (
            (((key % 2001) * 31 * rank) % 2001 - 1000).cast("double") / F.lit(1000.0).cast("double")
        ).alias("contribution"),
    )


def reviewed(w) -> DataFrame:
    return themes.reviewed_orders(w.stg_orders, w.stg_order_reviews)


def rule_insights(w) -> DataFrame:
    return themes.review_insights(reviewed(w), DEMO_THEMES)
