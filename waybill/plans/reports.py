"""Dashboard reports: a filtered base frame and small aggregations of it."""

from __future__ import annotations

from calendar import monthrange
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill import fixed_values as fixed
from waybill.functions import labels
from waybill.functions.dates import boundary_days, year_month, year_month_number
from waybill.functions.numbers import percent
from waybill.plans.star import ENRICHED_ONLY


@dataclass(frozen=True)
class Filters:
    """Period as yyyymm bounds, both included; empty lists mean no restriction."""

    ym_min: int
    ym_max: int
    states: Sequence[str] = field(default_factory=tuple)
    categories: Sequence[str] = field(default_factory=tuple)

    def days(self) -> tuple[date, date]:
        """First and last day of the period, so that it can prune by day before months are known."""
        year, month = divmod(self.ym_min, 100)
        year, month = (year + 1, 1) if month > 12 else (year, max(month, 1))
        begin = date(year, month, 1) if 1 <= year <= 9999 else (date.min if year < 1 else date.max)
        year, month = divmod(self.ym_max, 100)
        year, month = (year - 1, 12) if month < 1 else (year, min(month, 12))
        end = date(year, month, monthrange(year, month)[1]) if 1 <= year <= 9999 else (date.min if year < 1 else date.max)
        return begin, end

    def condition(self) -> Column:
        kept = year_month_number(F.col("annee"), F.col("mois")).between(self.ym_min, self.ym_max)
        if self.states:
            kept = kept & F.col("customer_state").isin(*self.states)
        if self.categories:
            kept = kept & F.col("product_category_name").isin(*self.categories)
        return kept


def _dimensions(fact: DataFrame, w, filters: Filters | None) -> DataFrame:
    """Fact with state, category and calendar month.

    The calendar may be broadcast: its size depends on the years spanned, never
    on the number of orders. The other dimensions grow with the business, so
    Spark decides from their sizes.
    """
    joined = (
        fact.join(F.broadcast(w.dim_date.select("date_key", "annee", "mois")), "date_key")
        .join(w.dim_product.select("product_key", "product_category_name"), "product_key")
        .join(w.dim_customer.select("customer_id", "customer_state"), "customer_id")
    )
    return joined.filter(filters.condition()) if filters else joined


def bi_base(w, filters: Filters | None = None) -> DataFrame:
    """All delivered orders with dimensions, dates and review score."""
    rows = w.order_rows(
        "order_id", "customer_id", "product_key", "date_key", "is_late", "total_price", *ENRICHED_ONLY,
        days=filters.days() if filters else None,
    )
    return _dimensions(rows, w, filters).select(
        "order_id",
        "is_late",
        "total_price",
        "customer_state",
        "product_category_name",
        "annee",
        "mois",
        "review_score",
        "order_purchase_timestamp",
        "order_estimated_delivery_date",
        "order_delivered_customer_date",
    )


def prediction_base(w, scores: DataFrame, filters: Filters | None = None) -> DataFrame:
    """Out-of-sample scores with the fact's dimensions."""
    honest = scores.filter(~F.col("is_in_sample")).select("order_id", "risk_probability", "risk_tier")
    days = filters.days() if filters else None
    fact = w.fact("order_id", "customer_id", "product_key", "date_key", "total_price", days=days)
    return _dimensions(honest.join(fact, "order_id"), w, filters).select(
        "order_id",
        "risk_probability",
        "risk_tier",
        "total_price",
        "customer_state",
        "product_category_name",
        "annee",
        "mois",
    )


def flagged_by_segment(w, scores: DataFrame) -> DataFrame:
    """Flagged out-of-sample orders by state, category and month, most first."""
    honest = scores.filter(~F.col("is_in_sample")).select("order_id", "is_flagged_risk")
    fact = w.fact("order_id", "customer_id", "product_key", "date_key")
    segments = (
        honest.join(fact, "order_id")
        .join(F.broadcast(w.dim_date.select("date_key")), "date_key")
        .join(w.dim_product.select("product_key", "product_category_name"), "product_key")
        .join(w.dim_customer.select("customer_id", "customer_state"), "customer_id")
    )
    return (
        segments.groupBy(
            "customer_state", "product_category_name", year_month(F.col("date_key")).alias("mois")
        )
        .agg(F.count_if("is_flagged_risk").alias("n_a_risque"))
        .orderBy(F.desc("n_a_risque"), "customer_state", "product_category_name", "mois")
    )


def filter_options(w) -> DataFrame:
    """All values the dashboard offers: (kind, value), each kind sorted."""
    fact = w.stg_orders.select(F.to_date("order_purchase_timestamp").alias("date_key")).distinct()
    months = (
        fact.join(F.broadcast(w.dim_date.select("date_key", "annee", "mois")), "date_key")
        .select(labels.month_label(F.col("annee"), F.col("mois")).alias("value"))
        .distinct()
    )
    states = w.dim_customer.select(F.col("customer_state").alias("value")).distinct()
    categories = (
        w.dim_product.select(F.col("product_category_name").alias("value"))
        .filter(F.col("value").isNotNull())
        .distinct()
    )
    kinds = [("state", states), ("category", categories), ("month", months)]
    tagged = [df.select(F.lit(kind).alias("kind"), "value") for kind, df in kinds]
    return tagged[0].unionByName(tagged[1]).unionByName(tagged[2]).orderBy("kind", "value")


def kpi_overview(base: DataFrame) -> DataFrame:
    bought = F.col("order_purchase_timestamp")
    return base.agg(
        F.count(F.lit(1)).alias("n_commandes"),
        F.sum("total_price").alias("ca_total"),
        F.avg("total_price").alias("panier_moyen"),
        F.avg("is_late").alias("taux_retard"),
        F.avg(boundary_days(bought, F.col("order_delivered_customer_date"))).alias("delai_reel_jours"),
        F.avg(boundary_days(bought, F.col("order_estimated_delivery_date"))).alias("delai_promis_jours"),
        F.avg("review_score").alias("note_moyenne"),
    )


def late_rate_by(base: DataFrame, *groups: str) -> DataFrame:
    return base.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n"), F.avg("is_late").alias("taux_retard")
    )


def monthly_late_rate(base: DataFrame) -> DataFrame:
    return late_rate_by(base, "annee", "mois").orderBy("annee", "mois")


def split_by_volume(rates: DataFrame, minimum: int = fixed.MIN_VOLUME) -> tuple[DataFrame, DataFrame]:
    """Groups large enough for a meaningful rate, and the others."""
    enough = F.col("n") >= minimum
    return rates.filter(enough), rates.filter(~enough)


def mark_volume(rates: DataFrame, minimum: int = fixed.MIN_VOLUME) -> DataFrame:
    return rates.withColumn("is_included", F.col("n") >= minimum)


def highest_rates(rates: DataFrame, group: str, n: int) -> DataFrame:
    return rates.orderBy(F.desc("taux_retard"), group).limit(n)


def lowest_rates(rates: DataFrame, group: str, n: int) -> DataFrame:
    return rates.orderBy("taux_retard", F.desc(group)).limit(n)


def worst_and_best(rates: DataFrame, group: str, n: int = 10) -> DataFrame:
    """Top and bottom of the ranking among groups with enough volume."""
    included, _ = split_by_volume(rates)
    worst = highest_rates(included, group, n).withColumn("side", F.lit("worst"))
    best = lowest_rates(included, group, n).withColumn("side", F.lit("best"))
    return worst.unionByName(best)


def satisfaction_gap(base: DataFrame) -> DataFrame:
    def score(late: int) -> Column:
        return F.when(F.col("is_late") == late, F.col("review_score"))

    return base.agg(
        F.avg(score(0)).alias("note_a_temps"),
        F.count(score(0)).alias("n_avis_a_temps"),
        F.avg(score(1)).alias("note_retard"),
        F.count(score(1)).alias("n_avis_retard"),
        (F.avg(score(0)) - F.avg(score(1))).alias("ecart"),
    )


def review_theme_counts(base: DataFrame, insights: DataFrame | None) -> DataFrame:
    """Negative reviews per real theme; no rows when the insights do not exist yet."""
    if insights is None:
        return base.sparkSession.createDataFrame([], "motif string, n bigint, label string")
    themed = insights.filter(
        (F.col("sentiment") == fixed.SENTIMENT_NEGATIVE)
        & ~F.col("motif").isin(fixed.THEME_NOT_APPLICABLE, fixed.THEME_OTHER)
    ).select("order_id", "motif")
    return (
        base.select("order_id")
        .join(themed, "order_id")
        .groupBy("motif")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("label", labels.theme_label(F.col("motif")))
        .orderBy(F.desc("n"), "motif")
    )


def risk_exposure(base: DataFrame) -> DataFrame:
    tier = F.col("risk_tier")
    return base.agg(
        F.sum(F.when(tier != fixed.RISK_TIER_LOW, F.col("total_price"))).alias("ca_a_risque"),
        F.count_if(tier == fixed.RISK_TIER_ALERT).alias("n_modere"),
        F.count_if(tier.like("Risque extr%")).alias("n_eleve"),
    )


def first_drivers(drivers: DataFrame) -> DataFrame:
    return drivers.filter(F.col("driver_rank") == 1).select("order_id", "feature_name")


def driver_frequency(base: DataFrame, drivers: DataFrame) -> DataFrame:
    return (
        base.select("order_id")
        .join(first_drivers(drivers), "order_id")
        .groupBy("feature_name")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("label", labels.feature_label(F.col("feature_name")))
        .orderBy(F.desc("n"), "feature_name")
    )


def top_driver_counts(drivers: DataFrame, n: int = 10) -> DataFrame:
    return (
        first_drivers(drivers)
        .groupBy("feature_name")
        .agg(F.count(F.lit(1)).alias("n_fois_driver_1"))
        .orderBy(F.desc("n_fois_driver_1"), "feature_name")
        .limit(n)
    )


def with_top_driver(base: DataFrame, drivers: DataFrame) -> DataFrame:
    top = first_drivers(drivers).withColumnRenamed("feature_name", "top_driver")
    return base.join(top, "order_id", "left")


def priority_orders(base: DataFrame, drivers: DataFrame, n: int = fixed.N_PRIORITY_ORDERS) -> DataFrame:
    """The ``n`` riskiest flagged orders, ready to show.

    The limit is taken before the driver lookup: the drivers meet ``n`` broadcast orders
    where they lie, and what is left of them joins the ``n``.
    """
    worst = (
        base.filter(F.col("risk_tier") != fixed.RISK_TIER_LOW)
        .orderBy(F.desc("risk_probability"), "order_id")
        .limit(n)
    )
    theirs = drivers.join(F.broadcast(worst.select("order_id")), "order_id", "left_semi")
    return (
        with_top_driver(worst, theirs)
        .select(
            "order_id",
            labels.state_label(F.col("customer_state")).alias("etat"),
            labels.category_label(F.col("product_category_name")).alias("categorie"),
            "total_price",
            labels.tier_label(F.col("risk_tier")).alias("niveau"),
            "risk_probability",
            labels.feature_label(F.col("top_driver")).alias("facteur"),
        )
        .orderBy(F.desc("risk_probability"), "order_id")
    )


def tier_by_sample(scores: DataFrame) -> DataFrame:
    return (
        scores.groupBy("is_in_sample", "risk_tier")
        .agg(F.count(F.lit(1)).alias("n_commandes"))
        .orderBy("is_in_sample", "risk_tier")
    )


def high_share_by_sample(scores: DataFrame, fact: DataFrame) -> DataFrame:
    """Share above the lowest tier, late rate and on-time-to-late ratio per sample."""
    joined = scores.join(fact.select("order_id", "is_late"), "order_id")
    rate = F.avg("is_late")
    return joined.groupBy("is_in_sample").agg(
        (100 * F.avg((F.col("risk_tier") != fixed.RISK_TIER_LOW).cast("int"))).alias("pct_high"),
        rate.alias("late_rate"),
        ((1 - rate) / F.nullif(rate, F.lit(0.0))).alias("class_ratio"),
    )


def monthly_late_history(fact: DataFrame) -> DataFrame:
    late = F.sum("is_late")
    return (
        fact.groupBy(year_month(F.col("date_key")).alias("mois"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            late.alias("n_retards"),
            percent(late, F.count(F.lit(1)), 2).alias("pct_retard"),
        )
        .orderBy("mois")
    )


def cutoff_comparison(fact: DataFrame, cutoffs: Sequence[str]) -> DataFrame:
    """Size and late rate before and after each candidate cutoff.

    The fact is reduced to daily counts once; cutoffs only meet those.
    """
    daily = fact.groupBy("date_key").agg(
        F.count(F.lit(1)).alias("n"), F.sum("is_late").alias("late")
    )
    candidates = F.array(*[F.lit(c) for c in cutoffs])
    test = F.col("date_key") >= F.col("cutoff").cast("date")
    sums = (
        daily.withColumn("cutoff", F.explode(candidates))
        .groupBy("cutoff")
        .agg(
            F.sum("n").alias("n"),
            F.sum("late").alias("late"),
            F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0)).alias("n_test"),
            F.coalesce(F.sum(F.when(test, F.col("late"))), F.lit(0)).alias("late_test"),
        )
    )
    n_train, late_train = F.col("n") - F.col("n_test"), F.col("late") - F.col("late_test")
    return sums.select(
        "cutoff",
        "n_test",
        percent(F.col("n_test"), F.col("n"), 1).alias("pct_test"),
        F.col("late_test").alias("n_retards_test"),
        percent(F.col("late_test"), F.col("n_test"), 2).alias("pct_retard_test"),
        percent(late_train, n_train, 2).alias("pct_retard_train"),
    ).orderBy("cutoff")


def late_by_seller_count(features: DataFrame) -> DataFrame:
    """Late rate per number of sellers, with its overall correlation to the seller rate."""
    correlation = features.agg(
        F.corr(F.col("nb_distinct_sellers").cast("double"), F.col("seller_late_rate_max"))
    )
    return features.groupBy("nb_distinct_sellers").agg(
        F.avg("is_late").alias("taux_retard"), F.count(F.lit(1)).alias("n")
    ).withColumn("correlation", correlation.scalar())
