"""Point-in-time features: only what was known when the order was placed."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from waybill.fixed_values import (
    FORBIDDEN_FEATURE_COLUMNS,
    NEUTRAL_PRIOR,
    SELLER_SMOOTHING_K,
)
from waybill.functions.dates import floored_days, monday_weekday
from waybill.functions.geo import haversine_km
from waybill.functions.numbers import safe_ratio
from waybill.operators.asof import (
    cumulative_history,
    leakage_violations,
    with_known,
)
from waybill.operators.quality import assert_no_forbidden, grain_report
from waybill.session import key_sums, materialised, observed


def history_measures(prefix: str = "") -> dict[str, Column]:
    return {f"{prefix}n": F.lit(1), f"{prefix}late": F.col("is_late")}


def order_outcomes(orders: DataFrame) -> DataFrame:
    """Purchase time, the time the outcome became known, and the outcome."""
    late = F.col("order_delivered_customer_date") > F.col("order_estimated_delivery_date")
    return orders.select(
        "order_id",
        F.col("order_purchase_timestamp").alias("purchased_at"),
        F.col("order_delivered_customer_date").alias("known_at"),
        F.when(late.isNotNull(), late.cast("int")).otherwise(0).alias("is_late"),
    )


def order_sellers(items: DataFrame) -> DataFrame:
    """Distinct (order, seller) pairs; an item without a seller makes no pair.

    Dealt out by order before they are made distinct, so joining orders to them takes no further shuffle.
    """
    pairs = items.filter(F.col("seller_id").isNotNull()).select("order_id", "seller_id")
    return pairs.repartition("order_id").distinct()


def order_baskets(items: DataFrame, products: DataFrame) -> DataFrame:
    """One row per order: what its items and their products sum up to, and its distinct sellers.

    Items are dealt out by order once for all of it. A product that is listed several times
    counts with each of its rows, as in a join, but an item's own price counts once.
    ``n_products`` says how many rows of products were found.
    """
    copy = F.row_number().over(Window.partitionBy("product_id").orderBy("product_id"))
    attributes = products.filter(F.col("product_id").isNotNull()).select(
        "product_id", "product_weight_g", product_volume().alias("volume"), "product_category_name", (copy == 1).alias("__first")
    )
    lines = items.select("order_id", "seller_id", "product_id", "price", "freight_value").join(attributes, "product_id", "left")
    once = F.coalesce("__first", F.lit(True))
    price, freight = F.sum(F.when(once, F.col("price"))), F.sum(F.when(once, F.col("freight_value")))
    return lines.drop("product_id").repartition("order_id").groupBy("order_id").agg(
        F.count_if(once).alias("nb_items"),
        price.alias("total_price"),
        freight.alias("total_freight"),
        safe_ratio(freight, price).alias("freight_ratio"),
        F.collect_set("seller_id").alias("sellers"),
        F.count("__first").alias("n_products"),
        F.sum("product_weight_g").alias("product_weight_g_sum"),
        F.sum("volume").alias("product_volume_cm3_sum"),
        F.size(F.collect_set("product_category_name")).cast("long").alias("nb_categories"),
    )


PRODUCT_FEATURES = ["product_weight_g_sum", "product_volume_cm3_sum", "nb_distinct_categories"]


def basket_measures(baskets: DataFrame) -> DataFrame:
    """``item_measures`` and ``product_features`` of ``order_baskets``, the latter NULL where no product was found."""
    return baskets.select(
        "order_id",
        "nb_items",
        "total_price",
        "total_freight",
        F.size("sellers").cast("long").alias("nb_distinct_sellers"),
        "freight_ratio",
        "product_weight_g_sum",
        "product_volume_cm3_sum",
        F.when(F.col("n_products") > 0, F.col("nb_categories")).alias("nb_distinct_categories"),
    )


def with_sellers(rows: DataFrame, baskets: DataFrame) -> DataFrame:
    """``rows`` of orders once for each distinct seller of ``order_baskets``."""
    joined = baskets.select("order_id", "sellers").join(rows, "order_id")
    return joined.select(*rows.columns, F.explode("sellers").alias("seller_id"))


def order_seller_outcomes(orders: DataFrame, items: DataFrame) -> DataFrame:
    """One row per (order, seller) of the delivered population."""
    return order_sellers(items).join(order_outcomes(orders), "order_id")


def seller_history(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Running order and late counts per seller at each outcome time."""
    return cumulative_history(
        order_seller_outcomes(orders, items), ["seller_id"], "known_at", history_measures()
    )


def global_history(orders: DataFrame) -> DataFrame:
    return cumulative_history(order_outcomes(orders), [], "known_at", history_measures())


def seller_known_before(orders: DataFrame, items: DataFrame) -> DataFrame:
    """(order, seller) rows with the seller's history strictly before the purchase."""
    return _with_seller_history(order_seller_outcomes(orders, items)).drop("known_at", "is_late")


def _with_seller_history(pairs: DataFrame) -> DataFrame:
    return with_known(
        pairs,
        ["seller_id"],
        "known_at",
        "purchased_at",
        history_measures("seller_"),
        last_seen="seller_last_known",
    )


def _with_global_history(outcomes: DataFrame) -> DataFrame:
    return with_known(
        outcomes,
        [],
        "known_at",
        "purchased_at",
        history_measures("global_"),
        last_seen="global_last_known",
    )


def global_known_before(orders: DataFrame) -> DataFrame:
    """Orders with the whole shop's history strictly before the purchase."""
    return _with_global_history(order_outcomes(orders)).drop("known_at", "is_late")


def prior_rate() -> Column:
    """Late rate of everything known; neutral when nothing is."""
    rate = F.col("global_late") / F.nullif(F.col("global_n"), F.lit(0))
    return F.coalesce(rate, F.lit(NEUTRAL_PRIOR))


def smoothed_rates(orders: DataFrame, items: DataFrame, k: int = SELLER_SMOOTHING_K, baskets: DataFrame | None = None) -> DataFrame:
    """Seller late rate pulled towards the prior with the weight of ``k`` orders.

    The prior belongs to the order, so it is attached before orders meet sellers. Their
    pairs are written once, as running totals read them twice. Sellers come from ``baskets``
    where they are given, else from ``items``.
    """
    placed = _with_global_history(order_outcomes(orders)).select(
        "order_id", "purchased_at", "known_at", "is_late", "global_n", "global_last_known", prior_rate().alias("prior")
    )
    pairs = materialised(order_sellers(items).join(placed, "order_id") if baskets is None else with_sellers(placed, baskets))
    known = _with_seller_history(pairs).drop("known_at", "is_late")
    rate = (F.col("seller_late") + k * F.col("prior")) / (F.col("seller_n") + k)
    return known.withColumn("seller_late_rate_smoothed", rate)


def worst_seller_rate(smoothed: DataFrame) -> DataFrame:
    return smoothed.groupBy("order_id").agg(
        F.max("seller_late_rate_smoothed").alias("seller_late_rate_max")
    )


def guarded_seller_rate(smoothed: DataFrame) -> DataFrame:
    """``worst_seller_rate`` and, per order, rows whose history is not strictly before the purchase."""
    bought = F.col("purchased_at")
    leaked = (F.col("seller_last_known") >= bought) | (F.col("global_last_known") >= bought)
    return smoothed.groupBy("order_id").agg(
        F.max("seller_late_rate_smoothed").alias("seller_late_rate_max"), F.count_if(leaked).alias(LEAKS)
    )


def history_leaks(smoothed: DataFrame) -> DataFrame:
    """Both violation counts must be 0: no history at or after the purchase is used."""
    return leakage_violations(
        smoothed,
        {
            "seller": ("seller_last_known", "purchased_at"),
            "global": ("global_last_known", "purchased_at"),
        },
    )


def assert_no_leaks(leaks: DataFrame) -> None:
    row = leaks.first()
    if row["seller_violations"] or row["global_violations"]:
        raise AssertionError(f"history from the future was used: {row.asDict()}")


def temporal_features(orders: DataFrame) -> DataFrame:
    bought = F.col("order_purchase_timestamp")
    weekday = monday_weekday(bought)
    return orders.select(
        "order_id",
        weekday.alias("purchase_weekday"),
        F.month(bought).alias("purchase_month"),
        F.hour(bought).alias("purchase_hour"),
        weekday.isin(5, 6).cast("int").alias("is_weekend"),
        floored_days(bought, F.col("order_estimated_delivery_date")).alias("delay_est_days"),
    )


def item_measures(order_items: DataFrame) -> DataFrame:
    return order_items.select(
        "order_id", "nb_items", "total_price", "total_freight", "nb_distinct_sellers", "freight_ratio"
    )


def payment_measures(order_payments: DataFrame) -> DataFrame:
    return order_payments.select(
        "order_id", "total_payment", "nb_payment_installments", "dominant_payment_type"
    )


def product_features(items: DataFrame, products: DataFrame) -> DataFrame:
    """Summed weight, summed per-item volume and number of categories per order.

    Items are first reduced to (order, product) counts, which shrinks the join
    and takes the heat out of best-selling products.
    """
    counts = items.groupBy("order_id", "product_id").agg(F.count(F.lit(1)).alias("n"))
    return basket_product_features(counts, products)


def product_volume() -> Column:
    return F.col("product_length_cm") * F.col("product_height_cm") * F.col("product_width_cm")


def basket_product_features(counts: DataFrame, products: DataFrame) -> DataFrame:
    """``product_features`` from rows that stand for ``n`` items each."""
    attributes = products.select(
        "product_id", "product_weight_g", product_volume().alias("volume"), "product_category_name"
    )
    # Dealt out by order once; categories and orders are both summed there.
    per_category = (
        counts.join(attributes, "product_id")
        .select("order_id", "product_category_name", "n", "product_weight_g", "volume")
        .repartition("order_id")
        .groupBy("order_id", "product_category_name")
        .agg(
            F.sum(F.col("n") * F.col("product_weight_g")).alias("weight"),
            F.sum(F.col("n") * F.col("volume")).alias("volume"),
        )
    )
    return per_category.groupBy("order_id").agg(
        F.sum("weight").alias("product_weight_g_sum"),
        F.sum("volume").alias("product_volume_cm3_sum"),
        F.count("product_category_name").alias("nb_distinct_categories"),
    )


def seller_customer_pairs(
    orders: DataFrame, items: DataFrame, customers: DataFrame, sellers: DataFrame, geo: DataFrame, baskets: DataFrame | None = None
) -> DataFrame:
    """Distinct (order, seller) pairs with both centroids, NULL where unknown.

    Coordinates are attached to the customer and seller dimensions first, so
    the postal-code join runs once per member, not once per item. Sellers come from
    ``baskets`` where they are given, else from ``items``.
    """
    def located(df: DataFrame, key: str, code: str, side: str) -> DataFrame:
        spots = geo.select(
            F.col("zip_code_prefix").alias("__zip"),
            F.col("centroid_lat").alias(f"{side}_lat"),
            F.col("centroid_lng").alias(f"{side}_lng"),
        )
        return df.select(key, code).join(spots, F.col(code) == F.col("__zip"), "left").drop(code, "__zip")

    buyers = located(customers, "customer_id", "customer_zip_code_prefix", "customer")
    shops = located(sellers, "seller_id", "seller_zip_code_prefix", "seller")
    placed = orders.select("order_id", "customer_id").join(buyers, "customer_id")
    pairs = order_sellers(items).join(placed, "order_id") if baskets is None else with_sellers(placed, baskets)
    return (
        pairs.join(shops, "seller_id")
        .select("order_id", "seller_id", "customer_lat", "customer_lng", "seller_lat", "seller_lng")
    )


def seller_distance_max(pairs: DataFrame) -> DataFrame:
    """Distance to the farthest seller; unknown only when no pair has one."""
    km = haversine_km(
        F.col("customer_lat"), F.col("customer_lng"), F.col("seller_lat"), F.col("seller_lng")
    )
    farthest = F.max(km)
    return pairs.groupBy("order_id").agg(
        farthest.alias("seller_distance_km_max"), farthest.isNull().cast("int").alias("geo_is_unknown")
    )


def feature_blocks(w, seller_rate=worst_seller_rate) -> dict[str, DataFrame]:
    """The six blocks of a ``Warehouse``, each at order grain.

    Items are dealt out by order once, for ``order_baskets``, which are written: measures of
    items and products, pairs with sellers and their distances all come from them.
    """
    return _blocks_of(w, materialised(order_baskets(w.stg_order_items, w.stg_products)), seller_rate)


def _blocks_of(w, baskets: DataFrame, seller_rate) -> dict[str, DataFrame]:
    orders, items = w.stg_orders, w.stg_order_items
    measures = basket_measures(baskets.where("n_products > 0"))
    return {
        "seller_late_rate": seller_rate(smoothed_rates(orders, items, baskets=baskets)),
        "temporal": temporal_features(orders),
        "items": item_measures(basket_measures(baskets)),
        "payments": payment_measures(w.int_order_payments),
        "products": measures.select("order_id", *PRODUCT_FEATURES),
        "distance": seller_distance_max(
            seller_customer_pairs(orders, items, w.stg_customers, w.stg_sellers, w.int_geolocation, baskets)
        ),
    }


def assembled(w, seller_rate=worst_seller_rate) -> DataFrame:
    """All blocks joined to the orders; measures of items and products come with one join."""
    baskets = materialised(order_baskets(w.stg_order_items, w.stg_products))
    blocks = _blocks_of(w, baskets, seller_rate)
    columns = ["order_id", *[c for b in blocks.values() for c in b.columns if c != "order_id"]]
    del blocks["products"]
    return assemble(w.stg_orders, blocks | {"items": basket_measures(baskets)}).select(*columns)


def assemble(orders: DataFrame, blocks: dict[str, DataFrame]) -> DataFrame:
    features = orders.select("order_id")
    for block in blocks.values():
        features = features.join(block, "order_id", "left")
    assert_no_forbidden(features.columns, FORBIDDEN_FEATURE_COLUMNS)
    return features


def features_orders(w) -> DataFrame:
    """order_id + 19 features, one row per delivered order."""
    w = w.written("stg_orders")
    return assembled(w)


LEAKS = "history_leaks"


def checked(features: DataFrame, orders: DataFrame) -> DataFrame:
    """``features`` without the leak counts, written once, after the run-time guards have passed.

    Figures that the write itself takes are held against those of the orders: the same
    keys, each as often, and no history from the future. A failure stops the run.
    """
    return checked_with_rows(features, orders)[0]


def checked_with_rows(features: DataFrame, orders: DataFrame) -> tuple[DataFrame, int]:
    """``checked``, and how many rows it has."""
    table, found = observed(features, **_figures())
    assert_checked(found, orders)
    return table.drop(LEAKS), found["rows"]


def _figures() -> dict[str, Column]:
    return {"leaks": F.coalesce(F.sum(LEAKS), F.lit(0)), **key_sums("order_id")}


def assert_checked(found: Mapping, orders: DataFrame) -> None:
    """The figures of a written feature table say that it has the keys of the orders, each as often, and no leak."""
    figures = {**key_sums("order_id"), "distinct": F.count_distinct("order_id")}
    expected = orders.agg(*[c.alias(n) for n, c in figures.items()]).first().asDict()
    if expected["distinct"] != expected["rows"] or any(found.get(n, 0) != expected[n] for n in key_sums("order_id")):
        raise AssertionError(f"features fan out or lose orders: {found}, orders have {expected}")
    if found.get("leaks"):
        raise AssertionError(f"history from the future was used: {found}")


def checked_features(w) -> DataFrame:
    """The feature table as a run uses it: written, the keys of the orders, no leak."""
    return checked_features_with_rows(w)[0]


def checked_features_with_rows(w) -> tuple[DataFrame, int]:
    w = w.written("stg_orders")
    return checked_with_rows(assembled(w, guarded_seller_rate), w.stg_orders)


def checked_labelled(w) -> DataFrame:
    """``checked_features`` with target and date, both guards and the label join in one write."""
    w, seen = w.written("stg_orders"), Observation()
    table = assembled(w, guarded_seller_rate).observe(seen, *[c.alias(n) for n, c in _figures().items()])
    joined, found = observed(labelled_features(table.drop(LEAKS), w.order_targets), rows=F.count(F.lit(1)))
    # Without any order Spark leaves the join out, and its figures with it.
    checked = seen.get
    assert_checked(checked, w.stg_orders)
    if found["rows"] != (expected := checked.get("rows", 0)):
        raise AssertionError(f"the label join changed the number of rows: {expected} before, {found['rows']} after")
    return joined


def feature_grain(w) -> DataFrame:
    w = w.written("stg_orders")
    return grain_report(w.stg_orders, "order_id", feature_blocks(w))


def labelled_features(features: DataFrame, fact: DataFrame) -> DataFrame:
    """Features with the target and the date used to split, the only place they meet."""
    return features.join(fact.select("order_id", "is_late", "date_key"), "order_id")
