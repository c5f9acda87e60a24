"""Metrics against hand-made cases and brute force."""

import random

import pytest
from pyspark.sql import functions as F

from waybill.operators import metrics


def scored(spark, rows):
    return spark.createDataFrame(rows, "g string, p double, y int")


def brute_ap(rows):
    positives = sum(y for _, y in rows)
    area = tp = n = 0
    for s in sorted({p for p, _ in rows}, reverse=True):
        step = [y for p, y in rows if p == s]
        tp, n = tp + sum(step), n + len(step)
        area += sum(step) / positives * tp / n if positives else 0
    return area


def test_average_precision_cases(spark):
    cases = {
        "steps": [(0.9, 1), (0.8, 0), (0.7, 1), (0.6, 0)],
        "all_tied": [(0.5, 1), (0.5, 0), (0.5, 0), (0.5, 1)],
        "no_positive": [(0.1, 0), (0.9, 0)],
        "perfect": [(0.9, 1), (0.1, 0)],
    }
    rng = random.Random(2)
    cases["random"] = [(round(rng.random(), 2), int(rng.random() < 0.3)) for _ in range(400)]
    cases["unrounded"] = [(rng.random() ** 3, int(rng.random() < 0.1)) for _ in range(400)]
    df = scored(spark, [(g, p, y) for g, rows in cases.items() for p, y in rows])
    got = {r.g: r.average_precision for r in metrics.average_precision(df, ["g"], "p", "y").collect()}
    assert got["steps"] == pytest.approx(0.83333333)
    assert got["no_positive"] == 0.0
    for g, rows in cases.items():
        assert got[g] == pytest.approx(brute_ap(rows)), g


def test_binary_metrics_without_predictions(spark):
    df = scored(spark, [("a", 0.1, 1), ("a", 0.2, 0)]).withColumn("hit", F.lit(0))
    row = metrics.binary_metrics(df, ["g"], "y", "hit").first()
    assert (row.precision, row.recall, row.f1, row.base_rate) == (0.0, 0.0, 0.0, 0.5)


def test_threshold_table_matches_brute_force(spark):
    rng = random.Random(4)
    rows = [("a", rng.choice([0.1, 0.15, 0.29, 0.3, 0.55, 0.57, rng.random() * 0.8]), rng.randint(0, 1)) for _ in range(300)]
    grid = [i / 100 for i in range(10, 100, 5)]
    got = metrics.threshold_table(scored(spark, rows), "p", "y", grid).collect()
    assert [r.threshold for r in sorted(got, key=lambda r: r.threshold)] == grid
    for r in got:
        flagged = [y for _, p, y in rows if p >= r.threshold]
        assert (r.n_flagged, r.true_positives) == (len(flagged), sum(flagged))
        assert r.precision == pytest.approx(sum(flagged) / len(flagged) if flagged else 0, abs=5e-5)
        assert r.pct_flagged == pytest.approx(100 * len(flagged) / len(rows), abs=5e-3)


def test_minimum_precision_threshold(spark):
    df = scored(spark, [("a", 0.305, 0)] * 8 + [("a", 0.61, 1)] * 2)
    assert metrics.threshold_min_precision(df, "p", "y", 0.5).first().threshold == 0.31
    never = scored(spark, [("a", 0.3, 0)])
    assert metrics.threshold_min_precision(never, "p", "y", 0.2).count() == 0


def test_confusion_and_report(spark):
    pairs = [("x", "x")] * 3 + [("x", "y")] + [("y", "y")] * 2 + [("z", "x")]
    df = spark.createDataFrame(pairs, "a string, b string")
    cells = {(r.actual, r.predicted): r.n for r in metrics.confusion_matrix(df, "a", "b", ["x", "y", "z"]).collect()}
    assert len(cells) == 9 and cells["x", "x"] == 3 and cells["z", "x"] == 1 and cells["z", "z"] == 0
    report = {r["class"]: r for r in metrics.class_report(df, "a", "b", ["x", "y", "z"]).collect()}
    assert report["x"].precision == pytest.approx(3 / 4)
    assert report["z"].f1 == 0.0
    assert report["macro avg"].recall == pytest.approx((3 / 4 + 1 + 0) / 3)
    assert report["weighted avg"].recall == pytest.approx(5 / 7)
