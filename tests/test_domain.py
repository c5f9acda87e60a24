"""Hand-made edge cases of the domain layers."""

import datetime as dt
import math
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from waybill import fixed_values as fixed
from waybill.functions import dates, geo, labels
from waybill.operators import quality
from waybill.operators.picking import best_per_key, newest_first, top_entries
from waybill.plans import features, order_grain, reports, star
from waybill.plans.warehouse import Warehouse


def one(spark, column, **values):
    names = ", ".join(f"{'timestamp_ntz' if isinstance(v, str) else 'double'}'{v}' as {k}" if isinstance(v, str) else f"cast({v} as double) as {k}" for k, v in values.items())
    return spark.sql(f"select {names}").select(column.alias("v")).first().v


def test_two_day_counts(spark):
    a, b = F.col("a"), F.col("b")
    across = {"a": "2018-01-01 23:00:00", "b": "2018-01-03 22:00:00"}
    assert one(spark, dates.boundary_days(a, b), **across) == 2
    assert one(spark, dates.floored_days(a, b), **across) == 1
    back = {"a": "2018-01-03 01:00:00", "b": "2018-01-03 00:00:00"}
    assert one(spark, dates.boundary_days(a, b), **back) == 0
    assert one(spark, dates.floored_days(a, b), **back) == -1


def test_two_weekday_conventions(spark):
    sunday = {"a": "2018-07-01 10:00:00"}
    assert one(spark, dates.sunday_weekday(F.col("a")), **sunday) == 0
    assert one(spark, dates.monday_weekday(F.col("a")), **sunday) == 6


def test_haversine(spark):
    km = geo.haversine_km(*[F.col(c) for c in "abcd"])
    assert one(spark, km, a=0, b=0, c=0, d=180) == pytest.approx(math.pi * 6371.0)
    assert one(spark, km, a=-23.5, b=-46.6, c=-22.9, d=-43.2) == pytest.approx(354.07, abs=0.5)
    row = spark.sql("select 1.0D a, cast(null as double) b, 2.0D c, 3.0D d").select(km.alias("v")).first()
    assert row.v is None


def test_calendar_has_every_day(spark):
    days = star.dim_date(spark)
    assert days.count() == 1461
    row = days.filter("date_key = date'2018-07-01'").first()
    assert (row.jour, row.mois, row.annee, row.jour_semaine, row.trimestre, row.is_weekend) == (1, 7, 2018, 0, 3, True)


def test_equal_payment_sums_take_the_alphabetical_type(spark):
    df = spark.createDataFrame(
        [(1, "voucher", 1, 5.0), (1, "boleto", 3, 2.0), (1, "boleto", 1, 3.0), (2, "card", 2, 1.0)],
        "order_id int, payment_type string, payment_installments int, payment_value double",
    )
    got = {r.order_id: r for r in order_grain.int_order_payments(df).collect()}
    assert got[1].dominant_payment_type == "boleto" and got[1].nb_payment_installments == 3
    assert got[1].total_payment == 10.0
    pick = {r.order_id: r[1] for r in order_grain.dominant_payment(df).collect()}
    assert pick == {1: "boleto", 2: "card"}


def test_latest_row_ties_and_unknown_dates(spark):
    day = dt.datetime(2018, 1, 1)
    df = spark.createDataFrame(
        [(1, "b", day), (1, "a", day), (1, "c", None), (2, "z", None), (3, "y", day + dt.timedelta(1)), (3, "a", day)],
        "k int, id string, ts timestamp_ntz",
    )
    got = best_per_key(df, ["k"], newest_first(F.col("ts")) + [F.col("id")])
    assert {r.k: r.id for r in got.collect()} == {1: "a", 2: "z", 3: "y"}


def test_farthest_seller_skips_unknown_places(spark):
    df = spark.createDataFrame(
        [(1, 0.0, 0.0, 0.0, 1.0), (1, 0.0, 0.0, None, None), (2, None, None, 0.0, 1.0)],
        "order_id int, customer_lat double, customer_lng double, seller_lat double, seller_lng double",
    )
    got = {r.order_id: r for r in features.seller_distance_max(df).collect()}
    assert got[1].seller_distance_km_max == pytest.approx(111.19, abs=0.01) and got[1].geo_is_unknown == 0
    assert got[2].seller_distance_km_max is None and got[2].geo_is_unknown == 1


def test_top_entries_ties_keep_position(spark):
    row = spark.sql("select 1.0D a, -3.0D b, 3.0D c, 0.5D d").select(
        top_entries(list("abcd"), [F.col(c) for c in "abcd"], 3).alias("t")
    ).first()
    assert [(e.name, e.value) for e in row.t] == [("b", -3.0), ("c", 3.0), ("a", 1.0)]


def test_labels(spark):
    row = spark.sql(
        "select 'SP' s, 'XX' t, 'toys' c, 'new_STUFF_here' d, 'Risque extrême (x)' e, 'Alerte' f, 'odd' g"
    ).select(
        labels.state_label(F.col("s")), labels.state_label(F.col("t")),
        labels.category_label(F.col("c")), labels.category_label(F.col("d")),
        labels.tier_label(F.col("e")), labels.tier_label(F.col("f")), labels.tier_label(F.col("g")),
    ).first()
    assert list(row) == ["São Paulo", "XX", "Jouets", "New stuff here", "Élevé", "Modéré", "odd"]


def test_volume_split_and_filters(spark):
    rates = spark.createDataFrame([("a", 30, 0.1), ("b", 29, 0.9)], "g string, n int, taux_retard double")
    included, excluded = reports.split_by_volume(rates)
    assert [r.g for r in included.collect()] == ["a"] and [r.g for r in excluded.collect()] == ["b"]
    base = spark.createDataFrame(
        [(2018, 1, "SP", "toys"), (2018, 2, "RJ", "toys"), (2019, 1, "SP", "art")],
        "annee int, mois int, customer_state string, product_category_name string",
    )
    count = lambda f: base.filter(f.condition()).count()
    assert count(reports.Filters(201801, 201812)) == 2
    assert count(reports.Filters(201801, 201912, states=["SP"])) == 2
    assert count(reports.Filters(201801, 201912, states=["SP"], categories=["art"])) == 1


def test_guards(spark):
    quality.assert_no_forbidden(["a"], fixed.FORBIDDEN_FEATURE_COLUMNS)
    with pytest.raises(AssertionError):
        quality.assert_no_forbidden(["review_score"], fixed.FORBIDDEN_FEATURE_COLUMNS)
    with pytest.raises(AssertionError):
        quality.assert_no_forbidden(["num__review_score"], fixed.FORBIDDEN_FEATURE_COLUMNS, anywhere_in_name=True)
    base = spark.createDataFrame([(1,), (2,)], "k int")
    double = spark.createDataFrame([(1,), (1,)], "k int")
    quality.assert_single_grain(quality.grain_report(base, "k", {"same": base}))
    with pytest.raises(AssertionError, match="twice"):
        quality.assert_single_grain(quality.grain_report(base, "k", {"twice": double}))


def test_data_tests_count_failures(spark):
    child = spark.createDataFrame([(1,), (1,), (3,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (2,)], "k int")
    suite = quality.test_suite(
        {"c": child, "p": parent}, [("c", "k", ("unique", "not_null")), ("p", "k", ("unique",))], [("c", "k", "p", "k")]
    )
    got = {(r.table_name, r.test): r.n_failures for r in suite.collect()}
    assert got == {("c", "unique"): 1, ("c", "not_null"): 1, ("p", "unique"): 0, ("c", "relationships"): 1}


@pytest.fixture(scope="module")
def tiny(spark):
    """Five orders: two sellers, a canceled one, one without postal code, one without items."""
    day = lambda d, h=0: dt.datetime(2018, 1, 1, h) + dt.timedelta(days=d)
    ts = "timestamp_ntz"
    orders = spark.createDataFrame(
        [
            ("o1", "c1", "delivered", day(0, 9), day(0), day(2), day(5), day(4)),
            ("o2", "c2", "delivered", day(5), day(5), day(6), day(8), day(20)),
            ("o3", "c1", "canceled", day(6), None, None, None, day(9)),
            ("o4", "c1", "delivered", day(30), day(30), day(31), day(33), day(40)),
            ("o5", "c2", "delivered", day(31), day(31), None, None, day(40)),
        ],
        "order_id string, customer_id string, order_status string,"
        f"order_purchase_timestamp {ts}, order_approved_at {ts}, order_delivered_carrier_date {ts},"
        f"order_delivered_customer_date {ts}, order_estimated_delivery_date {ts}",
    )
    items = spark.createDataFrame(
        [
            ("o1", 1, "p1", "s1", day(1), 10.0, 1.0),
            ("o1", 2, "p2", "s2", day(1), 20.0, 0.0),
            ("o2", 1, "p1", "s1", day(1), 5.0, 2.0),
            ("o2", 2, "p1", "s1", day(1), 0.0, 2.0),
            ("o4", 1, "p2", "s1", day(1), 7.0, 1.0),
        ],
        f"order_id string, order_item_id int, product_id string, seller_id string, shipping_limit_date {ts},"
        "price double, freight_value double",
    )
    payments = spark.createDataFrame(
        [("o1", 1, "boleto", 1, 31.0), ("o2", 1, "voucher", 2, 7.0)],
        "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value double",
    )
    reviews = spark.createDataFrame(
        [
            ("r1", "o1", 1, None, "  Atraso\nenorme ", day(9), day(9)),
            ("r2", "o1", 5, None, "bom", day(8), day(9)),
            ("r3", "o2", 2, None, "   ", day(9), day(9)),
        ],
        "review_id string, order_id string, review_score int, review_comment_title string,"
        f"review_comment_message string, review_creation_date {ts}, review_answer_timestamp {ts}",
    )
    return SimpleNamespace(
        orders=orders,
        order_items=items,
        order_payments=payments,
        order_reviews=reviews,
        customers=spark.createDataFrame(
            [("c1", "u1", "1001", " São ", " sp"), ("c2", "u2", "99999", "Rio", "rj")],
            "customer_id string, customer_unique_id string, customer_zip_code_prefix string, customer_city string, customer_state string",
        ),
        products=spark.createDataFrame(
            [("p1", "brinquedos", 1, 1, 1, 100.0, 1.0, 2.0, 3.0), ("p2", None, 1, 1, 1, 50.0, None, 1.0, 1.0)],
            "product_id string, product_category_name string, product_name_lenght int, product_description_lenght int,"
            "product_photos_qty int, product_weight_g double, product_length_cm double, product_height_cm double, product_width_cm double",
        ),
        sellers=spark.createDataFrame(
            [("s1", "1001", "x", "SP"), ("s2", "88888", "y", "RJ")],
            "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string",
        ),
        geolocation=spark.createDataFrame(
            [("1001", -20.0, -40.0, "a", "sp"), ("1001", -22.0, -44.0, "a", "sp"), ("88888", 50.0, 0.0, "b", "rj")],
            "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double, geolocation_city string, geolocation_state string",
        ),
        category_translation=spark.createDataFrame(
            [("brinquedos", "toys")], "product_category_name string, product_category_name_english string"
        ),
    )


def test_fact_table(spark, tiny):
    got = {r.order_id: r for r in Warehouse(tiny).fct_orders.collect()}
    assert set(got) == {"o1", "o2", "o4"}
    assert (got["o1"].is_late, got["o2"].is_late) == (1, 0)
    assert got["o1"].product_key == "p1" and got["o1"].geo_key == "01001"
    assert got["o2"].geo_key == "UNKNOWN" and got["o2"].nb_items == 1
    assert got["o1"].nb_distinct_sellers == 2 and got["o1"].freight_ratio == pytest.approx(1 / 30)
    assert "order_delivered_customer_date" not in got["o1"].asDict()


def test_feature_table(spark, tiny):
    w = Warehouse(tiny)
    got = {r.order_id: r for r in features.features_orders(w).collect()}
    assert set(got) == {"o1", "o2", "o4"}
    assert len(got["o1"].asDict()) == 20
    # Nothing known at first; o1 ends exactly when o2 is bought, so it is still unknown then.
    assert got["o1"].seller_late_rate_max == 0.5
    assert got["o2"].seller_late_rate_max == 0.5
    # By o4 both are known: prior 1/2, seller s1 has 1 late of 2.
    assert got["o4"].seller_late_rate_max == pytest.approx((1 + 10 * 0.5) / 12)
    assert got["o1"].product_weight_g_sum == 150.0 and got["o1"].product_volume_cm3_sum == 6.0
    assert got["o1"].nb_distinct_categories == 2
    assert got["o1"].seller_distance_km_max == 0.0 and got["o1"].geo_is_unknown == 0
    assert got["o2"].seller_distance_km_max is None and got["o2"].geo_is_unknown == 1
    assert got["o1"].delay_est_days == 3 and got["o4"].dominant_payment_type is None
    features.assert_no_leaks(features.history_leaks(features.smoothed_rates(w.stg_orders, w.stg_order_items)))


def test_missing_insights_give_an_empty_report(spark, tiny):
    base = Warehouse(tiny).stg_orders.select("order_id")
    assert reports.review_theme_counts(base, None).count() == 0


def test_baskets_are_items_products_and_sellers_of_an_order(spark):
    """One dealing of items gives what the separate blocks give: repeated and unknown products, no seller, no product, no order."""
    items = spark.createDataFrame(
        [(1, 10, 5, 2.0, 1.0), (1, 10, 6, 4.0, 0.0), (1, 11, 5, 8.0, 3.0), (2, None, 7, 1.0, 1.0), (3, 12, 99, 5.0, 2.0), (4, 12, None, 1.0, 0.5), (None, 12, 5, 1.0, 1.0), (None, 10, 5, 1.0, 1.0)],
        "order_id long, seller_id long, product_id long, price double, freight_value double",
    )
    products = spark.createDataFrame(
        [(5, "a", 10.0, 1.0, 2.0, 3.0), (5, "b", 20.0, 1.0, 1.0, 1.0), (6, "a", None, None, 1.0, 1.0), (7, None, 3.0, 1.0, 1.0, 1.0), (None, "c", 9.0, 9.0, 9.0, 9.0), (None, "c", 9.0, 9.0, 9.0, 9.0)],
        "product_id long, product_category_name string, product_weight_g double, product_length_cm double, product_height_cm double, product_width_cm double",
    )
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    baskets = features.order_baskets(items, products)
    found = features.basket_measures(baskets)
    assert rows(features.item_measures(found)) == rows(features.item_measures(order_grain.int_order_items(items)))
    known = features.basket_measures(baskets.where("n_products > 0")).select("order_id", *features.PRODUCT_FEATURES)
    assert rows(known) == rows(features.product_features(items, products).select("order_id", *features.PRODUCT_FEATURES))
    assert {r.order_id: r.nb_distinct_categories for r in found.collect()} == {1: 2, 2: 0, 3: None, 4: None, None: 2}
    orders = spark.createDataFrame([(1, "x"), (1, "y"), (2, "x"), (3, "x"), (5, "x"), (None, "x")], "order_id long, tag string")
    pairs = features.order_sellers(items).join(orders, "order_id").select("order_id", "tag", "seller_id")
    assert rows(features.with_sellers(orders, baskets)) == rows(pairs)


def test_features_deal_items_out_once(tiny, monkeypatch):
    """Items by order are shuffled for the baskets alone; blocks read what was written."""
    dealt, kept = [], features.order_baskets
    monkeypatch.setattr(features, "order_baskets", lambda *given: dealt.append(1) or kept(*given))
    monkeypatch.setattr(features, "order_sellers", lambda items: pytest.fail("items were dealt out again"))
    w = Warehouse(tiny)
    blocks = features.feature_blocks(w)
    assert dealt == [1] and list(blocks) == ["seller_late_rate", "temporal", "items", "payments", "products", "distance"]
    assert features.features_orders(w).columns == ["order_id", *[c for b in blocks.values() for c in b.columns if c != "order_id"]]
