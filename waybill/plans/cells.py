"""Additive cells of the dashboard: sums and counts by month, state and category.

Every filter of the dashboard is a choice of cells, and its rates and means are ratios of
their sums, so a report reads a table of the size of the business's vocabulary instead of
all its orders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.functions.dates import boundary_days
from waybill.plans import reports

KEYS = ["annee", "mois", "customer_state", "product_category_name"]
_BOUGHT = "order_purchase_timestamp"


def _measures() -> dict[str, Column]:
    """What is averaged anywhere, by the name that its sum and its count get."""
    bought = F.col(_BOUGHT)
    score = lambda late: F.when(F.col("is_late") == late, F.col("review_score"))
    return {
        "late": F.col("is_late"),
        "price": F.col("total_price"),
        "real_days": boundary_days(bought, F.col("order_delivered_customer_date")),
        "promised_days": boundary_days(bought, F.col("order_estimated_delivery_date")),
        "score": F.col("review_score"),
        "score_on_time": score(0),
        "score_late": score(1),
    }


def order_cells(base: DataFrame) -> DataFrame:
    """``reports.bi_base`` as (year, month, state, category): orders, and sum and count of each measure."""
    parts = [f for n, c in _measures().items() for f in (F.sum(c).alias(f"sum_{n}"), F.count(c).alias(f"n_{n}"))]
    return base.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"), *parts)


def cells(w, filters: reports.Filters | None = None) -> DataFrame:
    """The cells of a filter: from the stored table of a written warehouse, else from its orders."""
    stored = getattr(w, "order_cells", None)
    if stored is None:
        return order_cells(reports.bi_base(w, filters))
    if filters is None:
        return stored
    # ym is how the table is partitioned, so other months are not read.
    return stored.where(F.col("ym").between(filters.ym_min, filters.ym_max) & filters.condition())


def _mean(measure: str) -> Column:
    return F.sum(f"sum_{measure}") / F.nullif(F.sum(f"n_{measure}"), F.lit(0))


def kpi_overview(cells: DataFrame) -> DataFrame:
    return cells.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_commandes"),
        F.sum("sum_price").alias("ca_total"),
        _mean("price").alias("panier_moyen"),
        _mean("late").alias("taux_retard"),
        _mean("real_days").alias("delai_reel_jours"),
        _mean("promised_days").alias("delai_promis_jours"),
        _mean("score").alias("note_moyenne"),
    )


def late_rate_by(cells: DataFrame, *groups: str) -> DataFrame:
    return cells.groupBy(*groups).agg(F.sum("n").alias("n"), _mean("late").alias("taux_retard"))


def monthly_late_rate(cells: DataFrame) -> DataFrame:
    return late_rate_by(cells, "annee", "mois").orderBy("annee", "mois")


def satisfaction_gap(cells: DataFrame) -> DataFrame:
    count = lambda m: F.coalesce(F.sum(f"n_{m}"), F.lit(0))
    return cells.agg(
        _mean("score_on_time").alias("note_a_temps"),
        count("score_on_time").alias("n_avis_a_temps"),
        _mean("score_late").alias("note_retard"),
        count("score_late").alias("n_avis_retard"),
        (_mean("score_on_time") - _mean("score_late")).alias("ecart"),
    )
