"""Run-time guards, the stored warehouse, owners of written tables and closed class lists."""

import os

import pytest
from pyspark.sql import functions as F

from waybill import fixed_values as fixed
from waybill.catalog.registry import open_warehouse
from waybill.functions import labels
from waybill.operators import metrics, picking
from waybill.plans import exports, features, profile, reports
from waybill.session import materialised, shared_folder, written_tables
from waybill.sources import csv_tables

FOLDER = "/root/testdata/sf0.001"
given = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="given tables not present")


def test_a_leak_or_a_fan_out_stops_the_run(spark):
    orders = spark.createDataFrame([(1,), (2,)], "order_id int")
    good = spark.createDataFrame([(1, 0.5, 0), (2, None, None)], f"order_id int, x double, {features.LEAKS} int")
    assert features.checked(good, orders).columns == ["order_id", "x"]
    with pytest.raises(AssertionError, match="future"):
        features.checked(good.withColumn(features.LEAKS, F.lit(1)), orders)
    with pytest.raises(AssertionError, match="fan out"):
        features.checked(good.union(good.limit(1)), orders)
    with pytest.raises(AssertionError, match="fan out"):
        features.checked(good.limit(1), orders)


def test_history_at_the_purchase_counts_as_a_leak(spark):
    rows = [(1, 0.1, 5, 4, 3), (1, 0.3, 5, None, 5), (2, 0.2, 5, None, None)]
    df = spark.createDataFrame(
        rows, "order_id int, seller_late_rate_smoothed double, purchased_at int, seller_last_known int, global_last_known int"
    )
    got = {r.order_id: (r.seller_late_rate_max, r[features.LEAKS]) for r in features.guarded_seller_rate(df).collect()}
    assert got == {1: (0.3, 1), 2: (0.2, 0)}


@given
def test_stored_warehouse_equals_the_lazy_one_and_prunes_months(spark, tmp_path):
    lazy = open_warehouse(spark, FOLDER)
    stored = lazy.build(f"{tmp_path}/wh")
    columns = ["order_id", "customer_id", "product_key", "date_key", "geo_key", "is_late", "nb_items"]
    assert stored.fact(*columns).exceptAll(lazy.fact(*columns)).count() == 0
    assert stored.fact("order_id").count() == lazy.fact("order_id").count()
    again = lazy.build(f"{tmp_path}/wh")
    period = reports.Filters(199703, 199704)
    few, same = reports.bi_base(again, period), reports.bi_base(lazy, period)
    assert few.count() == same.count() > 0 and few.exceptAll(same).count() == 0
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ym" in plan


@pytest.mark.parametrize(
    ("low", "high", "days"),
    [
        (201701, 201712, ("2017-01-01", "2017-12-31")),
        (201602, 201602, ("2016-02-01", "2016-02-29")),
        (201513, 201700, ("2016-01-01", "2016-12-31")),
        (0, 999999, ("0001-01-01", "9999-12-31")),
    ],
)
def test_period_in_days(low, high, days):
    assert tuple(map(str, reports.Filters(low, high).days())) == days


def test_a_cluster_needs_a_folder_that_it_shares(spark):
    from types import SimpleNamespace

    def session(master, **conf):
        return SimpleNamespace(sparkContext=SimpleNamespace(master=master), conf=SimpleNamespace(get=lambda k, d=None: conf.get(k.split(".")[-2], d)))

    assert shared_folder(session("local[4]", warehouse="file:/here")) == "file:/here"
    assert shared_folder(session("spark://host:7077", warehouse="file:/here", checkpoint="hdfs://all")) == "hdfs://all"
    assert shared_folder(session("yarn", warehouse="s3a://all/w")) == "s3a://all/w"
    with pytest.raises(RuntimeError, match="share"):
        shared_folder(session("yarn", warehouse="file:/here"))


def test_written_tables_go_with_their_owner(spark):
    before = set(os.listdir(shared_folder(spark).removeprefix("file:")))
    with written_tables(spark):
        assert materialised(spark.range(3)).count() == 3
        assert set(os.listdir(shared_folder(spark).removeprefix("file:"))) > before
    assert set(os.listdir(shared_folder(spark).removeprefix("file:"))) == before


@given
def test_an_export_over_its_limit_is_an_error(spark, tmp_path):
    w = open_warehouse(spark, FOLDER)
    scores = w.stg_orders.select(
        "order_id", F.lit(0.5).alias("risk_probability"), F.lit("Alerte").alias("risk_tier"), F.lit(False).alias("is_in_sample")
    )
    drivers = w.stg_orders.select("order_id", F.lit(1).alias("driver_rank"), F.lit("x").alias("feature_name"))
    sizes = exports.export_dashboard(w, scores, drivers, None, f"{tmp_path}/a", 1 << 30)
    assert len(sizes) == 7 and all(sizes.values())
    with pytest.raises(AssertionError):
        exports.export_dashboard(w, scores, drivers, None, f"{tmp_path}/b", 10)


@pytest.mark.parametrize("bad", [None, "c"])
def test_a_class_that_is_not_listed_stops_the_report(spark, bad):
    df = spark.createDataFrame([("a", "b"), ("b", bad)], "y string, p string")
    for report in (metrics.confusion_matrix, metrics.class_report):
        with pytest.raises(Exception, match="no given class"):
            report(df, "y", "p", ["a", "b"]).collect()
    one = spark.createDataFrame([("a", "b")], "y string, p string")
    known = {(r.actual, r.predicted): r.n for r in metrics.confusion_matrix(one, "y", "p", ["a", "b", "c"]).collect()}
    assert len(known) == 9 and known["a", "b"] == 1


def test_first_child_does_not_depend_on_the_key_s_type(spark):
    rows = [("o", 1, 9), ("o", 1, 10), ("o", 2, 1)]
    df = spark.createDataFrame(rows, "o string, n int, v int")
    as_text = df.withColumn("v", F.col("v").cast("string"))
    assert picking.first_child(df, "o", "n", "v", "x").first().x == 10
    assert picking.first_child(as_text, "o", "n", "v", "x").first().x == "10"


def test_dominant_category_ignores_the_last_bits_of_a_sum(spark):
    rows = [("o", "b", 0.1), ("o", "b", 0.2), ("o", "a", 0.3)]
    df = spark.createDataFrame(rows, "o string, k string, v double")
    assert picking.dominant_category(df, "o", "k", "v", "x").first().x == "a"


def test_rows_without_a_class_are_a_class(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 4.0), (None, 7.0), (None, 9.0)], "is_late int, v double")
    assert {(r.is_late, r.median) for r in profile.median_by_class(df, ["v"]).collect()} == {(1, 3.0), (None, 8.0)}
    assert {(r.is_late, r.q50) for r in profile.boxplot_stats(df, "v").collect()} == {(1, 3.0), (None, 8.0)}


def test_a_csv_table_may_be_a_folder_of_files(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"part{i}.csv").write_text(f'a,b\n{i},"line\nbreak ""{i}"""\n', encoding="utf-8")
    got = sorted(tuple(r) for r in csv_tables.read_csv(spark, str(tmp_path), ["a", "b"], multi_line=True).collect())
    assert got == [(str(i), f'line\nbreak "{i}"') for i in range(3)]


def test_labels_of_known_and_unknown_names(spark):
    theme, direction = next(iter(fixed.THEME_LABELS.items())), next(iter(fixed.DIRECTION_LABELS.items()))
    df = spark.createDataFrame([(theme[0], direction[0]), ("other", "other"), (None, None)], "t string, d string")
    got = [tuple(r) for r in df.select(labels.theme_label(F.col("t")), labels.direction_label(F.col("d"))).collect()]
    assert got == [(theme[1], direction[1]), ("other", "other"), (None, None)]
