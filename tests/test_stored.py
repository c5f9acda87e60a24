"""Stored forms: buckets, cells, sketches, figures taken by writes."""

import os
import re

import pytest
from pyspark.sql import functions as F

from waybill.catalog.registry import open_warehouse
from waybill.operators import quality, sketches
from waybill.operators.suite_states import SuiteStates
from waybill.plans import cells, features, model, reports, scoring
from waybill.session import key_sums, observed
from waybill.sources import storage

FOLDER = "/root/testdata/sf0.001"
given = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="given tables not present")


def final_plan(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


@given
def test_joins_of_bucketed_tables_shuffle_nothing(spark, tmp_path):
    w = open_warehouse(spark, FOLDER)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        written = w.build_intermediate(str(tmp_path / "w"), 4)
        joined = w.enriched(written)
        assert not re.search(r"\bExchange\b", final_plan(joined)) and "SortMergeJoin" in final_plan(joined)
        again = {n: storage.read_table(spark, f"{tmp_path}/w/intermediate/{n}") for n in written}
        assert not re.search(r"\bExchange\b", final_plan(w.enriched(again)))
        want = sorted(map(str, w.int_orders_enriched.collect()))
        assert sorted(map(str, joined.select(*w.int_orders_enriched.columns).collect())) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@given
def test_reports_of_a_written_warehouse_read_its_cells_only(spark, tmp_path):
    w = open_warehouse(spark, FOLDER)
    stored = w.build(str(tmp_path / "w"))
    some = reports.Filters(199401, 199606)
    found = cells.cells(stored, some)
    assert all("/marts/order_cells/" in f for f in found.inputFiles())
    assert "PartitionFilters: [isnotnull(ym" in found._jdf.queryExecution().executedPlan().toString()
    for make, plain in ((cells.kpi_overview, reports.kpi_overview), (cells.monthly_late_rate, reports.monthly_late_rate), (cells.satisfaction_gap, reports.satisfaction_gap)):
        for filters in (None, some, reports.Filters(190001, 190012)):
            got, want = make(cells.cells(stored, filters)).collect(), plain(reports.bi_base(w, filters)).collect()
            assert len(got) == len(want)
            for a, b in zip(got, want, strict=True):
                assert a.asDict() == pytest.approx(b.asDict())
    lazy = cells.late_rate_by(cells.cells(w, some), "customer_state").collect()
    assert sorted(map(str, lazy)) == sorted(map(str, cells.late_rate_by(found, "customer_state").collect()))


def test_merged_sketches_keep_their_errors(spark):
    n = 20_000
    rows = spark.range(n).select(
        (F.col("id") % 7).alias("month"),
        F.when(F.col("id") % 11 > 0, (F.col("id") * 7919) % n).alias("x"),
        F.when(F.col("id") < 0, F.col("id")).alias("none"),
    )
    table = sketches.sketch_table(rows, ["month"], {"x": F.col("x"), "none": F.col("none")}).cache()
    assert table.count() == 14 and table.where("feature = 'none'").selectExpr("sum(n)").first()[0] == 0
    exact = sorted(r.x for r in rows.where("x is not null and month < 3").collect())
    row = sketches.describe(table.where("month < 3")).collect()
    assert [r.feature for r in row] == ["x"] and row[0]["count"] == len(exact)
    for p, c in ((0.25, "25%"), (0.5, "50%"), (0.75, "75%")):
        rank = sum(v <= row[0][c] for v in exact) / len(exact)
        assert abs(rank - p) <= sketches.RANK_ERROR + 1 / len(exact)
    share = sketches.distinct_share(table.where("month < 3")).first()
    assert abs(share.n_distinct / len(set(exact)) - 1) <= sketches.DISTINCT_ERROR
    box = sketches.boxes(table).first()
    assert box.fence_low == min(r.x for r in rows.where('x is not null').collect()) and box.q1 < box.median < box.q3 <= box.fence_high


def test_figures_are_taken_while_a_table_is_written(spark):
    rows = spark.createDataFrame([(1, True), (2, False), (None, None), (2, True)], "k long, t boolean")
    table, seen = observed(rows, **key_sums("k"), some=F.sum("k"))
    assert table.count() == seen["rows"] == 4 and seen["some"] == 5
    same = observed(rows.orderBy(F.desc("k")), **key_sums("k"))[1]
    other = observed(spark.createDataFrame([(1,), (1,), (None,), (2,)], "k long"), **key_sums("k"))[1]
    assert same["keys_1"] == seen["keys_1"] and other["rows"] == 4 and other["keys_1"] != seen["keys_1"]
    part = observed(rows, **key_sums("k", F.col("t")))[1]
    assert part["rows"] == 2 and part["keys_2"] == observed(rows.where("t"), **key_sums("k"))[1]["keys_2"]
    empty = observed(rows.limit(0), **key_sums("k"))[1]
    assert (empty["rows"], empty["keys_1"]) == (0, 0)


def test_coverage_is_read_off_the_figures():
    whole = {"rows": 4, "keys_1": 10, "keys_2": 20, "train_rows": 2, "train_keys_1": 3, "train_keys_2": 4}
    model.assert_covered(whole, whole, {**whole, "all": 12})
    for scores, drivers in (({**whole, "keys_1": 11}, {**whole, "all": 12}), (whole, {**whole, "all": 11}), ({**whole, "train_rows": 1}, {**whole, "all": 12})):
        with pytest.raises(AssertionError):
            model.assert_covered(whole, scores, drivers)


def test_suite_from_states_reads_a_month_once(spark, tmp_path):
    schema = "id long, owner string"
    months = {
        1: [(1, "a"), (2, "b"), (2, "b"), (None, "a")],
        2: [(3, "a"), (1, None), (4, "z"), (5, "z")],
        3: [(6, "b")],
    }
    owners = spark.createDataFrame([("a",), ("b",)], "o string")
    states = SuiteStates(spark, str(tmp_path / "s"), "t", ["id", "owner"], ["id"], {"owner": "owners"})

    def plain(months, owners):
        rows = spark.createDataFrame([r for m in months.values() for r in m], schema)
        keys = [("t", "id", ("unique", "not_null")), ("t", "owner", ("not_null",))]
        return sorted(map(tuple, quality.test_suite({"t": rows, "o": owners}, keys, [("t", "owner", "o", "o")]).collect()))

    def kept():
        return sorted(map(tuple, states.suite({"owners": owners}).collect()))

    seen = {}
    for m in (2, 1, 3):
        source = str(tmp_path / f"month{m}")
        spark.createDataFrame(months[m], schema).write.parquet(source)
        states.add(m, spark.read.parquet(source), {"owners": owners})
        # Whatever the month's rows were read from may go.
        for f in (tmp_path / f"month{m}").iterdir():
            f.unlink()
        seen[m] = months[m]
        assert kept() == plain(seen, owners)
    # A month comes again, without the key that was there twice; then a parent is known at last.
    months[1] = [(2, "b"), (8, "q")]
    states.add(1, spark.createDataFrame(months[1], schema), {"owners": owners})
    assert kept() == plain(months, owners)
    owners = spark.createDataFrame([("a",), ("b",), ("z",)], "o string")
    assert kept() == plain(months, owners)
    states.add(2, spark.createDataFrame([], schema), {"owners": owners})
    assert kept() == plain({1: months[1], 3: months[3]}, owners)
    empty = SuiteStates(spark, str(tmp_path / "none"), "t", ["id"], ["id"])
    assert {r.n_failures for r in empty.suite({}).collect()} == {0}


@given
def test_a_scoring_run_takes_few_jobs(spark):
    w = open_warehouse(spark, FOLDER)
    group = "guards"
    spark.sparkContext.setJobGroup(group, group)
    try:
        rows = scoring.labelled(w)
        after = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        scoring.run(rows, "1997-01-01")
        whole = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) - after
    finally:
        spark.sparkContext.setJobGroup("", "")
    # 88 when guards were jobs of their own and the fit took some forty steps.
    assert whole <= 60
