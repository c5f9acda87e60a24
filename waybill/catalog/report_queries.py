"""Dashboard reports."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from waybill.catalog.demo import demo_drivers, demo_scores, rule_insights
from waybill.catalog.registry import query, rounded
from waybill.functions import labels
from waybill.plans import cells
from waybill.plans import reports as bi
from waybill.session import materialised, shared_folder
from waybill.sources.driver_tables import DEMO_CUTOFFS

FILTERS = bi.Filters(199601, 200012, states=("SP", "RJ", "BA"), categories=("toys", "health_beauty"))


@query(
    "parametric_filter",
    """select order_id, customer_state, product_category_name, annee, mois from bi_base
    where annee * 100 + mois between 199601 and 200012 and customer_state in ('SP', 'RJ', 'BA')
        and product_category_name in ('toys', 'health_beauty')""",
)
def parametric_filter(w):
    return bi.bi_base(w, FILTERS).select(
        "order_id", "customer_state", "product_category_name", "annee", "mois"
    )


@query(
    "filter_options",
    """select * from (
        select distinct 'state' as kind, customer_state as value from dim_customer
        union all select distinct 'category', product_category_name from dim_product
            where product_category_name is not null
        union all select distinct 'month', d.annee::varchar || '-' || lpad(d.mois::varchar, 2, '0')
            from fct_orders o join dim_date d on d.date_key = o.date_key)
    order by kind, value""",
)
def filter_options(w):
    return bi.filter_options(w)


_LABELS = """coalesce(map {'SP': 'São Paulo', 'RJ': 'Rio de Janeiro', 'MG': 'Minas Gerais',
            'RS': 'Rio Grande do Sul', 'PR': 'Paraná', 'SC': 'Santa Catarina', 'BA': 'Bahia',
            'DF': 'Distrito Federal', 'GO': 'Goiás', 'ES': 'Espírito Santo', 'PE': 'Pernambuco',
            'CE': 'Ceará', 'PA': 'Pará', 'MT': 'Mato Grosso', 'MA': 'Maranhão',
            'MS': 'Mato Grosso do Sul', 'PB': 'Paraíba', 'PI': 'Piauí',
            'RN': 'Rio Grande do Norte', 'AL': 'Alagoas'}[customer_state], customer_state) as etat,
        case product_category_name when 'health_beauty' then 'Santé et beauté'
            when 'bed_bath_table' then 'Linge de maison' when 'sports_leisure' then 'Sport et loisirs'
            when 'toys' then 'Jouets' when 'unknown' then 'Catégorie inconnue'
            else upper(left(replace(product_category_name, '_', ' '), 1))
                || lower(substr(replace(product_category_name, '_', ' '), 2)) end as categorie,
        case when risk_tier = 'Sous seuil' then 'Faible' when risk_tier = 'Alerte' then 'Modéré'
            when starts_with(risk_tier, 'Risque extrême') then 'Élevé' else risk_tier end as niveau"""


@query(
    "label_lookup",
    f"""select order_id, {_LABELS}
    from pred_base""",
)
def label_lookup(w):
    return bi.prediction_base(w, demo_scores(w)).select(
        "order_id",
        labels.state_label(F.col("customer_state")).alias("etat"),
        labels.category_label(F.col("product_category_name")).alias("categorie"),
        labels.tier_label(F.col("risk_tier")).alias("niveau"),
    )


_KPI = """select count(*) as n_commandes, round(sum(total_price), 2) as ca_total,
        round(avg(total_price), 4) as panier_moyen, round(avg(is_late), 6) as taux_retard,
        round(avg(datediff('day', order_purchase_timestamp, order_delivered_customer_date)), 6)
            as delai_reel_jours,
        round(avg(datediff('day', order_purchase_timestamp, order_estimated_delivery_date)), 6)
            as delai_promis_jours,
        round(avg(review_score), 6) as note_moyenne
    from bi_base"""


def _kpi(w):
    return _kpi_rounded(bi.kpi_overview(bi.bi_base(w)))


def _kpi_rounded(kpi):
    kpi = rounded(rounded(kpi, 2, "ca_total"), 4, "panier_moyen")
    return rounded(kpi, 6, "taux_retard", "delai_reel_jours", "delai_promis_jours", "note_moyenne")


@query("kpi_overview", _KPI)
def kpi_overview(w):
    return _kpi(w)


@query("stored_kpi_overview", _KPI)
def stored_kpi_overview(w):
    """The same report over a written warehouse."""
    return _kpi(w.build(f"{shared_folder(w.raw.spark)}/warehouse-{uuid.uuid4().hex}"))


@query(
    "monthly_late_rate",
    """select annee, mois, count(*) as n, round(avg(is_late), 6) as taux_retard
    from bi_base group by annee, mois order by annee, mois""",
)
def monthly_late_rate(w):
    return rounded(bi.monthly_late_rate(bi.bi_base(w)), 6, "taux_retard")


# The same reports from additive cells, held against the same statements.


def _cells(w):
    return materialised(cells.cells(w))


@query("cells_kpi_overview", _KPI)
def cells_kpi_overview(w):
    return _kpi_rounded(cells.kpi_overview(_cells(w)))


@query(
    "cells_kpi_filtered",
    _KPI + " where annee * 100 + mois between 199605 and 199711 and customer_state in (select customer_state from bi_base group by 1 order by 1 limit 3)",
)
def cells_kpi_filtered(w):
    table = _cells(w)
    states = [r[0] for r in table.select("customer_state").distinct().orderBy("customer_state").limit(3).collect()]
    return _kpi_rounded(cells.kpi_overview(table.where(bi.Filters(199605, 199711, states).condition())))


@query("cells_monthly_late_rate", """select annee, mois, count(*) as n, round(avg(is_late), 6) as taux_retard from bi_base group by annee, mois""")
def cells_monthly_late_rate(w):
    return rounded(cells.monthly_late_rate(_cells(w)), 6, "taux_retard")


@query("cells_rate_by_state", "select customer_state, count(*) as n, round(avg(is_late), 6) as taux_retard from bi_base group by 1")
def cells_rate_by_state(w):
    return rounded(cells.late_rate_by(_cells(w), "customer_state"), 6, "taux_retard")


@query("cells_rate_by_category", "select product_category_name, count(*) as n, round(avg(is_late), 6) as taux_retard from bi_base group by 1")
def cells_rate_by_category(w):
    return rounded(cells.late_rate_by(_cells(w), "product_category_name"), 6, "taux_retard")


@query(
    "cells_satisfaction_gap",
    """with m as (select avg(review_score) filter (where is_late = 0) as a, count(review_score) filter (where is_late = 0) as na,
        avg(review_score) filter (where is_late = 1) as b, count(review_score) filter (where is_late = 1) as nb from bi_base)
    select round(a, 6) as note_a_temps, na as n_avis_a_temps, round(b, 6) as note_retard, nb as n_avis_retard, round(a - b, 6) as ecart from m""",
)
def cells_satisfaction_gap(w):
    return rounded(cells.satisfaction_gap(_cells(w)), 6, "note_a_temps", "note_retard", "ecart")


@query(
    "monthly_late_history",
    """select strftime(date_key, '%Y-%m') as mois, count(*) as n, sum(is_late)::bigint as n_retards,
        round(100.0 * sum(is_late) / count(*), 2) as pct_retard
    from fct_orders group by 1 order by 1""",
)
def monthly_late_history(w):
    return bi.monthly_late_history(w.order_targets)


@query(
    "rate_by_state",
    """select customer_state, count(*) as n, round(avg(is_late), 6) as taux_retard
    from bi_base group by 1""",
)
def rate_by_state(w):
    return rounded(bi.late_rate_by(bi.bi_base(w), "customer_state"), 6, "taux_retard")


@query(
    "rate_by_category",
    """select product_category_name, count(*) as n, round(avg(is_late), 6) as taux_retard
    from bi_base group by 1""",
)
def rate_by_category(w):
    return rounded(bi.late_rate_by(bi.bi_base(w), "product_category_name"), 6, "taux_retard")


@query(
    "min_volume_split",
    """select annee, mois, customer_state, count(*) as n, round(avg(is_late), 6) as taux_retard,
        count(*) >= 30 as is_included
    from bi_base group by 1, 2, 3""",
)
def min_volume_split(w):
    rates = bi.late_rate_by(bi.bi_base(w), "annee", "mois", "customer_state")
    return rounded(bi.mark_volume(rates), 6, "taux_retard")


@query(
    "worst_best_groups",
    """with rates as (
        select customer_state, count(*) as n, avg(is_late) as taux_retard from bi_base
        group by 1 having count(*) >= 30)
    select customer_state, n, round(taux_retard, 6) as taux_retard, side from (
        (select *, 'worst' as side from rates order by taux_retard desc, customer_state limit 10)
        union all
        (select *, 'best' as side from rates order by taux_retard, customer_state desc limit 10))""",
)
def worst_best_groups(w):
    rates = bi.late_rate_by(bi.bi_base(w), "customer_state")
    return rounded(bi.worst_and_best(rates, "customer_state"), 6, "taux_retard")


@query(
    "satisfaction_gap",
    """select round(avg(review_score) filter (where is_late = 0), 6) as note_a_temps,
        count(review_score) filter (where is_late = 0) as n_avis_a_temps,
        round(avg(review_score) filter (where is_late = 1), 6) as note_retard,
        count(review_score) filter (where is_late = 1) as n_avis_retard,
        round(avg(review_score) filter (where is_late = 0)
            - avg(review_score) filter (where is_late = 1), 6) as ecart
    from bi_base""",
)
def satisfaction_gap(w):
    gap = bi.satisfaction_gap(bi.bi_base(w))
    return rounded(gap, 6, "note_a_temps", "note_retard", "ecart")


@query(
    "review_theme_counts",
    """select i.motif, count(*) as n, i.motif as label
    from bi_base b join insights i on b.order_id = i.order_id
    where i.sentiment = 'negatif' and i.motif not in ('non_applicable', 'autre')
    group by 1 order by n desc, 1""",
)
def review_theme_counts(w):
    return bi.review_theme_counts(bi.bi_base(w), rule_insights(w))


@query(
    "insight_inner_join",
    """select b.order_id, b.customer_state, i.motif, i.sentiment
    from bi_base b join insights i on b.order_id = i.order_id""",
)
def insight_inner_join(w):
    base = bi.bi_base(w).select("order_id", "customer_state")
    return base.join(rule_insights(w).select("order_id", "motif", "sentiment"), "order_id")


@query(
    "risk_exposure",
    """select round(sum(total_price) filter (where risk_tier != 'Sous seuil'), 2) as ca_a_risque,
        count(*) filter (where risk_tier = 'Alerte') as n_modere,
        count(*) filter (where risk_tier like 'Risque extr%') as n_eleve
    from pred_base""",
)
def risk_exposure(w):
    return rounded(bi.risk_exposure(bi.prediction_base(w, demo_scores(w))), 2, "ca_a_risque")


@query(
    "driver_frequency",
    """select d.feature_name, count(*) as n,
        case feature_name when 'num__delay_est_days' then 'Délai de livraison promis'
            when 'num__seller_distance_km_max' then 'Distance vendeur-client'
            when 'num__seller_late_rate_max' then 'Fiabilité du vendeur'
            when 'num__total_freight' then 'Frais de port' else d.feature_name end as label
    from pred_base b join drivers d on d.order_id = b.order_id
    where d.driver_rank = 1 group by 1 order by n desc, 1""",
)
def driver_frequency(w):
    return bi.driver_frequency(bi.prediction_base(w, demo_scores(w)), demo_drivers(w))


@query(
    "top_driver_counts",
    """select feature_name, count(*) as n_fois_driver_1 from drivers where driver_rank = 1
    group by 1 order by 2 desc, 1 limit 10""",
)
def top_driver_counts(w):
    return bi.top_driver_counts(demo_drivers(w))


@query(
    "driver_left_join",
    """select b.order_id, b.risk_probability, b.risk_tier, d.feature_name as top_driver
    from pred_base b left join drivers d on d.order_id = b.order_id and d.driver_rank = 1""",
)
def driver_left_join(w):
    base = bi.prediction_base(w, demo_scores(w)).select("order_id", "risk_probability", "risk_tier")
    return bi.with_top_driver(base, demo_drivers(w))


@query(
    "priority_orders",
    f"""select order_id, risk_probability, round(total_price, 4) as total_price, {_LABELS},
        case feature_name when 'num__delay_est_days' then 'Délai de livraison promis'
            when 'num__seller_distance_km_max' then 'Distance vendeur-client'
            when 'num__seller_late_rate_max' then 'Fiabilité du vendeur'
            when 'num__total_freight' then 'Frais de port' else feature_name end as facteur
    from pred_base left join (select order_id, feature_name from drivers where driver_rank = 1) using (order_id)
    where risk_tier != 'Sous seuil'
    order by risk_probability desc, order_id limit 50""",
)
def priority_orders(w):
    orders = bi.priority_orders(bi.prediction_base(w, demo_scores(w)), demo_drivers(w))
    return rounded(orders, 4, "total_price")


@query(
    "tier_by_sample",
    """select is_in_sample, risk_tier, count(*) as n_commandes from scores
    group by 1, 2 order by 1, 2""",
)
def tier_by_sample(w):
    return bi.tier_by_sample(demo_scores(w))


@query(
    "high_share_by_sample",
    """select is_in_sample, round(100.0 * avg((risk_tier != 'Sous seuil')::integer), 6) as pct_high,
        round(avg(is_late), 6) as late_rate,
        round((1 - avg(is_late)) / nullif(avg(is_late), 0), 6) as class_ratio
    from scores group by 1""",
)
def high_share_by_sample(w):
    shares = bi.high_share_by_sample(demo_scores(w), w.order_targets)
    return rounded(shares, 6, "pct_high", "late_rate", "class_ratio")


@query(
    "cutoff_comparison",
    f"""select cutoff, sum((date_key >= cutoff::date)::integer)::bigint as n_test,
        round(100.0 * sum((date_key >= cutoff::date)::integer) / count(*), 1) as pct_test,
        sum(case when date_key >= cutoff::date then is_late else 0 end)::bigint as n_retards_test,
        round(100.0 * sum(case when date_key >= cutoff::date then is_late end)
            / sum((date_key >= cutoff::date)::integer), 2) as pct_retard_test,
        round(100.0 * sum(case when date_key < cutoff::date then is_late end)
            / sum((date_key < cutoff::date)::integer), 2) as pct_retard_train
    from fct_orders cross join (select unnest({DEMO_CUTOFFS}) as cutoff)
    group by cutoff order by cutoff""",
)
def cutoff_comparison(w):
    return bi.cutoff_comparison(w.order_targets, DEMO_CUTOFFS)
