"""Exploration profiles of the raw tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waybill.functions.dates import floored_days
from waybill.functions.geo import euclid_degrees
from waybill.operators.picking import best_per_key
from waybill.operators.quantiles import exact_quantiles
from waybill.plans.model import long_form


def delivered_population(orders: DataFrame) -> DataFrame:
    """Delivered orders with both dates, with the target and both delays in days."""
    bought = F.col("order_purchase_timestamp")
    real, promised = F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date")
    return orders.filter(
        (F.col("order_status") == "delivered") & real.isNotNull() & promised.isNotNull()
    ).withColumns(
        {
            "is_late": (real > promised).cast("int"),
            "delay_estimated_days": floored_days(bought, promised),
            "delay_real_days": floored_days(bought, real),
        }
    )


def late_rate_overall(population: DataFrame) -> DataFrame:
    return population.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("is_late").alias("n_late"),
        F.count_if(F.col("is_late") == 0).alias("n_on_time"),
        F.avg("is_late").alias("late_rate"),
    )


def late_rate_by_state_ranked(population: DataFrame, customers: DataFrame) -> DataFrame:
    states = customers.select("customer_id", "customer_state")
    return (
        population.select("customer_id", "is_late")
        .join(states, "customer_id", "left")
        .groupBy("customer_state")
        .agg(F.avg("is_late").alias("taux"), F.count("is_late").alias("n"))
        .orderBy(F.desc("taux"), "customer_state")
    )


def items_sum_by_order(population: DataFrame, items: DataFrame) -> DataFrame:
    sums = items.groupBy("order_id").agg(
        F.sum("freight_value").alias("freight_total"), F.sum("price").alias("price_total")
    )
    return population.join(sums, "order_id", "left")


def order_status_profile(orders: DataFrame) -> DataFrame:
    counts = orders.groupBy("order_status").agg(
        F.count(F.lit(1)).alias("n"), F.count("order_delivered_customer_date").alias("n_with_date")
    )
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share", F.col("n") / total)


def grain_profile(children: Mapping[str, DataFrame], key: str = "order_id") -> DataFrame:
    parts = [
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.sum("n").alias("n_rows"),
            F.count(key).alias("n_orders"),
            (F.sum("n") / F.nullif(F.count(key), F.lit(0))).alias("mean_rows"),
            F.max("n").alias("max_rows"),
        )
        .withColumn("table_name", F.lit(name))
        for name, df in children.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def null_profile(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """(table_name, column_name, n_null, pct) from a single pass."""
    rows = F.count(F.lit(1))
    cells = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(c).alias("column_name"),
            F.count_if(F.col(c).isNull()).alias("n_null"),
            F.round(100.0 * F.count_if(F.col(c).isNull()) / F.nullif(rows, F.lit(0)), 2).alias("pct"),
        )
        for c in columns
    ]
    return df.agg(F.array(*cells).alias("__cells")).select(F.inline("__cells"))


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles per column."""
    values = long_form(df, columns, "column_name")
    simple = values.groupBy("column_name").agg(
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        F.stddev("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = exact_quantiles(
        values, ["column_name"], "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75}, few_groups=True
    )
    return simple.join(quartiles, "column_name", "left")


def _class_group(label: str) -> Column:
    """A key that is never NULL, so rows without a class are a group like any other."""
    return F.struct(
        F.col(label).isNull().alias("none"), F.coalesce(F.col(label).cast("string"), F.lit("")).alias("text")
    )


def median_by_class(df: DataFrame, columns: Sequence[str], label: str = "is_late") -> DataFrame:
    """(measure, label, median) for several measures at once; rows without a class are one class."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value")) for c in columns]
    )
    values = df.select(_class_group(label).alias("__group"), F.inline(pairs))
    medians = exact_quantiles(values, ["measure", "__group"], "value", {"median": 0.5}, few_groups=True)
    back = F.when(~F.col("__group.none"), F.col("__group.text").cast(df.schema[label].dataType))
    return medians.select("measure", back.alias(label), "median")


def boxplot_stats(df: DataFrame, measure: str, label: str = "is_late") -> DataFrame:
    """Quartiles per class, the outermost values within 1.5 box heights, and outlier counts.

    Rows without a class are one class.
    """
    values = df.select(label, _class_group(label).alias("__group"), F.col(measure).cast("double").alias("value"))
    values = values.filter("value is not null")
    boxes = exact_quantiles(
        values, ["__group"], "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75}, few_groups=True
    )
    low = F.col("q25") - 1.5 * (F.col("q75") - F.col("q25"))
    high = F.col("q75") + 1.5 * (F.col("q75") - F.col("q25"))
    inside = F.col("value").between(low, high)
    return (
        values.join(F.broadcast(boxes), "__group")
        .groupBy(label, "q25", "q50", "q75")
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.count_if(~inside).alias("n_outliers"),
        )
    )


def histogram(
    df: DataFrame,
    measure: str,
    bins: int,
    low: Column | float | None = None,
    high: Column | float | None = None,
) -> DataFrame:
    """(bin, bin_start, n) with values outside [low, high] counted in the end bins.

    A missing bound is the smallest or largest value after clipping, as for a
    plain histogram; the last bin includes its upper edge.
    """
    value = F.col(measure).cast("double")
    lower = F.lit(float(low)) if isinstance(low, (int, float)) else low
    upper = F.lit(float(high)) if isinstance(high, (int, float)) else high
    clipped = value
    if lower is not None:
        clipped = F.greatest(clipped, lower)
    if upper is not None:
        clipped = F.least(clipped, upper)
    values = df.filter(value.isNotNull()).select(clipped.alias("value"))
    edges = values.agg(F.struct(F.min("value").alias("lo"), F.max("value").alias("hi")))
    lo, width = F.col("edge.lo"), (F.col("edge.hi") - F.col("edge.lo")) / bins
    position = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.lit(bins - 1), F.floor((F.col("value") - lo) / F.nullif(width, F.lit(0.0))))
    )
    return (
        values.withColumn("edge", edges.scalar())
        .groupBy(position.cast("int").alias("bin"), "edge")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("bin", (lo + F.col("bin") * width).alias("bin_start"), "n")
    )


def upper_quantile(df: DataFrame, measure: str, p: float) -> Column:
    return exact_quantiles(df, [], measure, {"q": p}, few_groups=True).scalar()


def inconsistent_dates() -> Column:
    bought = F.col("order_purchase_timestamp")
    return (F.col("order_delivered_customer_date") < bought) | (
        F.col("order_estimated_delivery_date") < bought
    )


def temporal_inconsistency_counts(population: DataFrame) -> DataFrame:
    bought = F.col("order_purchase_timestamp")
    checks = {
        "delivered_before_purchase": F.col("order_delivered_customer_date") < bought,
        "estimated_before_purchase": F.col("order_estimated_delivery_date") < bought,
        "approved_before_purchase": F.col("order_approved_at") < bought,
        "delivered_or_estimated": inconsistent_dates(),
    }
    rows = F.count(F.lit(1))
    cells = [
        F.struct(
            F.lit(name).alias("check_name"),
            F.count_if(found).alias("n"),
            (F.count_if(found) / F.nullif(rows, F.lit(0))).alias("share"),
        )
        for name, found in checks.items()
    ]
    return population.agg(F.array(*cells).alias("__cells")).select(F.inline("__cells"))


def population_funnel(orders: DataFrame) -> DataFrame:
    """Orders left after each step, share of all, and orders lost by the step."""
    delivered = F.col("order_status") == "delivered"
    usable = (
        delivered
        & F.col("order_delivered_customer_date").isNotNull()
        & F.col("order_estimated_delivery_date").isNotNull()
    )
    clean = usable & ~F.coalesce(inconsistent_dates(), F.lit(False))
    steps = {
        "all_orders": F.lit(True),
        "delivered": delivered,
        "with_delivery_date": usable,
        "consistent_dates": clean,
    }
    cells = [
        F.struct(F.lit(i + 1).alias("step"), F.lit(n).alias("step_name"), F.count_if(c).alias("n"))
        for i, (n, c) in enumerate(steps.items())
    ]
    rows = orders.agg(F.array(*cells).alias("__cells")).select(F.inline("__cells"))
    in_order = Window.orderBy("step")
    first = F.first("n").over(in_order)
    return rows.select(
        "step",
        "step_name",
        "n",
        F.round(100.0 * F.col("n") / F.nullif(first, F.lit(0)), 1).alias("pct_total"),
        F.coalesce(F.lag("n").over(in_order) - F.col("n"), F.lit(0)).alias("n_lost"),
    )


def first_sellers(items: DataFrame) -> DataFrame:
    """One seller per order: that of the lowest item number."""
    return best_per_key(
        items.select("order_id", "order_item_id", "seller_id"),
        ["order_id"],
        [F.col("order_item_id"), F.col("seller_id")],
    ).select("order_id", "seller_id")


def customer_seller_degrees(
    population: DataFrame, items: DataFrame, customers: DataFrame, sellers: DataFrame, geo: DataFrame
) -> DataFrame:
    """Rough straight-line distance in degrees to the first seller, NULL if unknown."""
    spots = geo.groupBy("geolocation_zip_code_prefix").agg(
        F.avg("geolocation_lat").alias("lat"), F.avg("geolocation_lng").alias("lng")
    )

    def located(df: DataFrame, key: str, code: str, side: str) -> DataFrame:
        points = spots.select(
            F.col("geolocation_zip_code_prefix").alias("__zip"),
            F.col("lat").alias(f"{side}_lat"),
            F.col("lng").alias(f"{side}_lng"),
        )
        return df.select(key, code).join(points, F.col(code) == F.col("__zip"), "left").drop(code, "__zip")

    return (
        population.select("order_id", "customer_id", "is_late")
        .join(located(customers, "customer_id", "customer_zip_code_prefix", "cust"), "customer_id", "left")
        .join(first_sellers(items), "order_id", "left")
        .join(located(sellers, "seller_id", "seller_zip_code_prefix", "sell"), "seller_id", "left")
        .select(
            "order_id",
            "is_late",
            euclid_degrees(
                F.col("cust_lat"), F.col("cust_lng"), F.col("sell_lat"), F.col("sell_lng")
            ).alias("dist_deg"),
        )
    )


def geo_coverage(distances: DataFrame) -> DataFrame:
    return distances.agg(
        F.count(F.lit(1)).alias("n"),
        F.count("dist_deg").alias("n_with_distance"),
        F.avg(F.col("dist_deg").isNotNull().cast("int")).alias("coverage"),
    )
