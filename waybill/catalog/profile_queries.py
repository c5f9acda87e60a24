"""Exploration profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from waybill.catalog.registry import query, rounded
from waybill.operators import sketches
from waybill.plans import cells, profile, reports
from waybill.plans.model import long_form
from waybill.session import materialised


def _population(w):
    return profile.delivered_population(w.raw.orders)


def _with_sums(w):
    return profile.items_sum_by_order(_population(w), w.raw.order_items)


def _degrees(w):
    return profile.customer_seller_degrees(
        _population(w), w.raw.order_items, w.raw.customers, w.raw.sellers, w.raw.geolocation
    )


@query(
    "late_rate_overall",
    """select count(*) as n, sum(is_late)::bigint as n_late,
        count(*) filter (where is_late = 0) as n_on_time, round(avg(is_late), 6) as late_rate
    from population""",
)
def late_rate_overall(w):
    return rounded(profile.late_rate_overall(_population(w)), 6, "late_rate")


@query(
    "late_rate_by_state_ranked",
    """select c.customer_state, round(avg(p.is_late), 6) as taux, count(p.is_late) as n
    from population p left join raw_customers c on p.customer_id = c.customer_id
    group by 1 order by avg(p.is_late) desc, 1""",
)
def late_rate_by_state_ranked(w):
    return rounded(profile.late_rate_by_state_ranked(_population(w), w.raw.customers), 6, "taux")


@query(
    "items_sum_by_order",
    """select order_id, is_late, delay_estimated_days, delay_real_days,
        round(freight_total, 4) as freight_total, round(price_total, 4) as price_total
    from population_sums""",
)
def items_sum_by_order(w):
    sums = _with_sums(w).select(
        "order_id", "is_late", "delay_estimated_days", "delay_real_days", "freight_total", "price_total"
    )
    return rounded(sums, 4, "freight_total", "price_total")


@query(
    "order_status_profile",
    """select order_status, count(*) as n, count(order_delivered_customer_date) as n_with_date,
        round(count(*) / (select count(*) from raw_orders), 6) as share
    from raw_orders group by 1""",
)
def order_status_profile(w):
    return rounded(profile.order_status_profile(w.raw.orders), 6, "share")


_CHILDREN = {
    "order_items": "raw_order_items",
    "order_payments": "raw_order_payments",
    "order_reviews": "raw_order_reviews",
}


@query(
    "grain_profile",
    " union all ".join(
        f"""select '{n}' as table_name, sum(n)::bigint as n_rows, count(*) as n_orders,
            round(sum(n) / count(*), 6) as mean_rows, max(n) as max_rows
        from (select order_id, count(*) as n from {t} group by 1)"""
        for n, t in _CHILDREN.items()
    ),
)
def grain_profile(w):
    children = {
        "order_items": w.raw.order_items,
        "order_payments": w.raw.order_payments,
        "order_reviews": w.raw.order_reviews,
    }
    return rounded(profile.grain_profile(children), 6, "mean_rows")


_NULL_COLUMNS = {
    "orders": [
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ],
    "products": [
        "product_category_name",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    ],
    "order_items": ["price", "freight_value"],
}


@query(
    "null_profile",
    " union all ".join(
        f"""select '{t}' as table_name, '{c}' as column_name, count(*) - count({c}) as n_null,
            round(100.0 * (count(*) - count({c})) / count(*), 2) as pct from raw_{t}"""
        for t, columns in _NULL_COLUMNS.items()
        for c in columns
    ),
)
def null_profile(w):
    frames = {"orders": w.raw.orders, "products": w.raw.products, "order_items": w.raw.order_items}
    parts = [profile.null_profile(df, t, _NULL_COLUMNS[t]) for t, df in frames.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_MEASURES = ["delay_estimated_days", "delay_real_days", "freight_total", "price_total"]


@query(
    "describe_numeric",
    " union all ".join(
        f"""select '{c}' as column_name, count({c}) as n, round(avg({c}), 4) as mean,
            round(stddev({c}), 4) as std, round(min({c})::double, 4) as min,
            round(max({c})::double, 4) as max, round(quantile_cont({c}::double, 0.25), 4) as q25,
            round(quantile_cont({c}::double, 0.5), 4) as q50,
            round(quantile_cont({c}::double, 0.75), 4) as q75
        from population_sums"""
        for c in _MEASURES
    ),
)
def describe_numeric(w):
    table = profile.describe_numeric(_with_sums(w), _MEASURES)
    return rounded(table, 4, "mean", "std", "min", "max", "q25", "q50", "q75")


@query(
    "median_by_class",
    " union all ".join(
        f"""select '{c}' as measure, is_late, round(quantile_cont({c}::double, 0.5), 4) as median
        from {t} group by is_late"""
        for c, t in (
            ("freight_total", "population_sums"),
            ("delay_estimated_days", "population_sums"),
            ("dist_deg", "degrees where dist_deg is not null"),
        )
    ),
)
def median_by_class(w):
    sums = profile.median_by_class(_with_sums(w), ["freight_total", "delay_estimated_days"])
    distances = profile.median_by_class(_degrees(w), ["dist_deg"])
    return rounded(sums.unionByName(distances), 4, "median")


@query(
    "boxplot_stats",
    """with measured as (
        select is_late, round(freight_total, 6) as v from population_sums where freight_total is not null),
    boxes as (
        select is_late, quantile_cont(v, 0.25) as q25, quantile_cont(v, 0.5) as q50,
            quantile_cont(v, 0.75) as q75
        from measured group by is_late)
    select m.is_late, round(q25, 4) as q25, round(q50, 4) as q50, round(q75, 4) as q75,
        round(min(v) filter (where v between q25 - 1.5 * (q75 - q25) and q75 + 1.5 * (q75 - q25)), 4)
            as whisker_low,
        round(max(v) filter (where v between q25 - 1.5 * (q75 - q25) and q75 + 1.5 * (q75 - q25)), 4)
            as whisker_high,
        count(*) filter (where v not between q25 - 1.5 * (q75 - q25) and q75 + 1.5 * (q75 - q25))
            as n_outliers
    from measured m join boxes b on m.is_late = b.is_late
    group by m.is_late, q25, q50, q75""",
)
def boxplot_stats(w):
    # Sums are rounded first: their last bits decide on which side of a whisker a value is.
    boxes = profile.boxplot_stats(rounded(_with_sums(w), 6, "freight_total"), "freight_total")
    return rounded(boxes, 4, "q25", "q50", "q75", "whisker_low", "whisker_high")


@query(
    "histogram_clip",
    """with clipped as (
        select least(price_total, (select quantile_cont(price_total, 0.99) from population_sums)) as v
        from population_sums where price_total is not null),
    edges as (select min(v) as lo, max(v) as hi from clipped)
    select 'price_total' as measure, least(59, floor((v - lo) / ((hi - lo) / 60)))::integer as bin,
        round(lo + least(59, floor((v - lo) / ((hi - lo) / 60))) * ((hi - lo) / 60), 4) as bin_start,
        count(*) as n
    from clipped cross join edges group by lo, hi, 2, 3
    union all
    select 'delay_real_days', least(49, floor((v - lo) / ((hi - lo) / 50)))::integer,
        round(lo + least(49, floor((v - lo) / ((hi - lo) / 50))) * ((hi - lo) / 50), 4), count(*)
    from (select greatest(0.0::double, least(80.0::double, delay_real_days::double)) as v from population_sums)
    cross join (select min(greatest(0, least(80, delay_real_days)))::double as lo,
        max(greatest(0, least(80, delay_real_days)))::double as hi from population_sums)
    group by lo, hi, 2, 3""",
)
def histogram_clip(w):
    sums = _with_sums(w)
    p99 = profile.upper_quantile(sums, "price_total", 0.99)
    prices = profile.histogram(sums, "price_total", 60, high=p99)
    delays = profile.histogram(sums, "delay_real_days", 50, low=0, high=80)
    both = prices.withColumn("measure", F.lit("price_total")).unionByName(
        delays.withColumn("measure", F.lit("delay_real_days"))
    )
    return rounded(both, 4, "bin_start")


@query(
    "temporal_inconsistency_counts",
    " union all ".join(
        f"""select '{n}' as check_name, count(*) filter (where {c}) as n,
            round(count(*) filter (where {c}) / count(*), 6) as share from population"""
        for n, c in {
            "delivered_before_purchase": "order_delivered_customer_date < order_purchase_timestamp",
            "estimated_before_purchase": "order_estimated_delivery_date < order_purchase_timestamp",
            "approved_before_purchase": "order_approved_at < order_purchase_timestamp",
            "delivered_or_estimated": "order_delivered_customer_date < order_purchase_timestamp"
            " or order_estimated_delivery_date < order_purchase_timestamp",
        }.items()
    ),
)
def temporal_inconsistency_counts(w):
    return rounded(profile.temporal_inconsistency_counts(_population(w)), 6, "share")


@query(
    "population_funnel",
    """with steps as (
        select 1 as step, 'all_orders' as step_name, count(*) as n from raw_orders
        union all select 2, 'delivered', count(*) from raw_orders where order_status = 'delivered'
        union all select 3, 'with_delivery_date', count(*) from population
        union all select 4, 'consistent_dates', count(*) from population
            where not (order_delivered_customer_date < order_purchase_timestamp
                or order_estimated_delivery_date < order_purchase_timestamp))
    select step, step_name, n, round(100.0 * n / first(n) over (order by step), 1) as pct_total,
        coalesce(lag(n) over (order by step) - n, 0) as n_lost
    from steps""",
)
def population_funnel(w):
    return profile.population_funnel(w.raw.orders)


@query(
    "seller_customer_distance_deg",
    "select order_id, is_late, round(dist_deg, 6) as dist_deg from degrees",
)
def seller_customer_distance_deg(w):
    return rounded(_degrees(w), 6, "dist_deg")


@query(
    "geo_coverage",
    """select count(*) as n, count(dist_deg) as n_with_distance,
        round(count(dist_deg) / count(*), 6) as coverage from degrees""",
)
def geo_coverage(w):
    return rounded(profile.geo_coverage(_degrees(w)), 6, "coverage")


# --- sketches: stored once by month, state and class, merged for any question --------------

_SKETCHED = ["late", "price", "promised_days", "real_days"]
_FEATURES = ", ".join(f"('{c}')" for c in _SKETCHED)


def _sketched(w):
    """(rows, sketches by month, state and class) of the dashboard's measures."""
    rows = reports.bi_base(w)
    measures = {n: c for n, c in cells._measures().items() if n in _SKETCHED}
    rows = materialised(rows.select("annee", "mois", "customer_state", "is_late", *[c.cast("double").alias(n) for n, c in measures.items()]))
    keys = ["annee", "mois", "customer_state", "is_late"]
    return rows, materialised(sketches.sketch_table(rows, keys, {n: F.col(n) for n in _SKETCHED}))


def _within(rows, found, by):
    """(by, feature, p, within): whether as many values lie below a found quantile as its probability says."""
    long = long_form(rows, _SKETCHED) if not by else rows.select(
        *by, F.inline(F.array(*[F.struct(F.lit(n).alias("feature"), F.col(n).alias("value")) for n in _SKETCHED]))
    )
    v, q = F.col("value"), F.col("found")
    ranks = long.where(v.isNotNull()).join(F.broadcast(found), [*by, "feature"]).groupBy(*by, "feature", "p").agg(
        F.avg((v < q).cast("double")).alias("below"), F.avg((v <= q).cast("double")).alias("up_to")
    )
    p, error = F.col("p"), F.lit(sketches.RANK_ERROR)
    # A small group has no value at the very rank: one row more or less is right as well.
    return ranks.select(*by, "feature", "p", ((F.col("below") <= p + error) & (F.col("up_to") >= p - error)).alias("within"))


def _quantiles(table, by, names):
    pairs = F.array(*[F.struct(F.lit(p).alias("p"), F.col(f"`{c}`").alias("found")) for p, c in names.items()])
    return table.select(*by, "feature", F.inline(pairs))


@query(
    "describe_numeric_sketch",
    f"select feature, p, true as within from (values {_FEATURES}) f(feature), (values (0.25::double), (0.5), (0.75)) q(p)",
)
def describe_numeric_sketch(w):
    """Quartiles from merged sketches are within the stated rank error of all rows."""
    rows, table = _sketched(w)
    return _within(rows, _quantiles(sketches.describe(table), [], {0.25: "25%", 0.5: "50%", 0.75: "75%"}), [])


@query(
    "describe_numeric_sketch_moments",
    " union all ".join(
        f"""select '{n}' as feature, count({c}) as count, round(avg({c}), 6) as mean, round(stddev_samp({c}), 6) as std,
        round(min({c}), 6)::double as min, round(max({c}), 6)::double as max from bi_base"""
        for n, c in {
            "late": "is_late",
            "price": "total_price",
            "promised_days": "date_diff('day', order_purchase_timestamp, order_estimated_delivery_date)",
            "real_days": "date_diff('day', order_purchase_timestamp, order_delivered_customer_date)",
        }.items()
    ),
)
def describe_numeric_sketch_moments(w):
    """What sketch tables carry besides sketches is exact."""
    table = sketches.describe(_sketched(w)[1]).select("feature", "count", "mean", "std", "min", "max")
    return rounded(table, 6, "mean", "std", "min", "max")


@query(
    "median_by_class_sketch",
    f"select is_late, feature, 0.5::double as p, true as within from (select distinct is_late from bi_base), (values {_FEATURES}) f(feature)",
)
def median_by_class_sketch(w):
    rows, table = _sketched(w)
    return _within(rows, _quantiles(sketches.describe(table, ["is_late"]), ["is_late"], {0.5: "50%"}), ["is_late"])


@query(
    "boxplot_stats_sketch",
    f"""select feature, p, true as within, true as fences_follow
    from (values {_FEATURES}) f(feature), (values (0.25::double), (0.5), (0.75)) q(p)""",
)
def boxplot_stats_sketch(w):
    rows, table = _sketched(w)
    boxes = materialised(sketches.boxes(table).join(sketches.describe(table).select("feature", "min", "max"), "feature"))
    span = 1.5 * (F.col("q3") - F.col("q1"))
    follow = (F.col("fence_low") == F.greatest("min", F.col("q1") - span)) & (F.col("fence_high") == F.least("max", F.col("q3") + span))
    within = _within(rows, _quantiles(boxes, [], {0.25: "q1", 0.5: "median", 0.75: "q3"}), [])
    return within.join(boxes.select("feature", follow.alias("fences_follow")), "feature")


@query("cardinality_share_sketch", f"select feature, (select count(*) from bi_base) as n_rows, true as within from (values {_FEATURES}) f(feature)")
def cardinality_share_sketch(w):
    rows, table = _sketched(w)
    exact = long_form(rows, _SKETCHED).where("value is not null").groupBy("feature").agg(F.count_distinct("value").alias("exact"))
    gap = F.abs(F.col("n_distinct") - F.col("exact")) / F.col("exact")
    joined = sketches.distinct_share(table).join(exact, "feature")
    return joined.select("feature", "n_rows", (gap <= sketches.DISTINCT_ERROR).alias("within"))
