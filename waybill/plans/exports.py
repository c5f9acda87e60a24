"""The tables a deployed dashboard needs, narrowed to the columns it reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.sources import storage


def referenced_members(dim: DataFrame, fact: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Distinct dimension rows some fact row points to.

    Fact keys are made distinct first, on the map side, before they are shuffled.
    """
    used = fact.select(key).distinct()
    return dim.select(*columns).join(used, key, "left_semi").distinct()


def dashboard_tables(
    w, scores: DataFrame, drivers: DataFrame, insights: DataFrame | None
) -> dict[str, DataFrame]:
    tables = {
        "fct_orders": w.fact(
            "order_id", "customer_id", "product_key", "date_key", "is_late", "total_price"
        ),
        "dim_customer": referenced_members(
            w.dim_customer, w.fact("customer_id"), "customer_id", ["customer_id", "customer_state"]
        ),
        "dim_product": referenced_members(
            w.dim_product, w.fact("product_key"), "product_key", ["product_key", "product_category_name"]
        ),
        "dim_date": referenced_members(
            w.dim_date, w.fact("date_key"), "date_key", ["date_key", "annee", "mois"]
        ),
        "int_orders_enriched": w.int_orders_enriched.select(
            "order_id",
            "review_score",
            "order_purchase_timestamp",
            "order_estimated_delivery_date",
            "order_delivered_customer_date",
        ),
        "order_risk_scores": scores.select("order_id", "risk_probability", "risk_tier", "is_in_sample"),
        "order_risk_drivers": drivers.filter(F.col("driver_rank") == 1).select("order_id", "feature_name"),
    }
    if insights is not None:
        tables["review_insights"] = insights.select("order_id", "motif", "sentiment")
    return tables


def export_dashboard(
    w, scores: DataFrame, drivers: DataFrame, insights: DataFrame | None, folder: str, limit_bytes: int
) -> dict[str, int]:
    """Write all dashboard tables and give their sizes; more than ``limit_bytes`` in all is an error."""
    tables = dashboard_tables(w, scores, drivers, insights)
    storage.export_tables(tables, folder)
    sizes = storage.export_sizes(w.dim_geography.sparkSession, folder, tables)
    storage.assert_export_size(sizes, limit_bytes)
    return sizes
