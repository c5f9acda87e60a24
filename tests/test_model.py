"""Preparation, fits and drivers."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from waybill import fixed_values as fixed
from waybill.operators.boosting import Settings
from waybill.plans import evaluation, explain, model


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(0)
    data = []
    for i in range(400):
        x, z = rng.normal(), rng.normal(2, 5)
        late = int(rng.random() < 1 / (1 + np.exp(-(1.5 * x - 1.5))))
        kind = ["boleto", "card", None][i % 3] if i < 300 else "unseen"
        day = dt.date(2018, 1, 1) + dt.timedelta(days=i // 4)
        data.append((i, day, late, float(x), None if i % 17 == 0 else float(z), 4.0, kind))
    return spark.createDataFrame(
        data, "order_id int, date_key date, is_late int, x double, z double, flat double, kind string"
    ).cache()


CUTOFF = "2018-03-17"
NUMERIC = ["x", "z", "flat"]


def test_preparation_is_learnt_on_train_only(rows):
    train, test = model.temporal_split(rows, CUTOFF)
    model.assert_split(model.split_report(rows, CUTOFF))
    with pytest.raises(AssertionError):
        model.assert_split(model.split_report(rows, "2030-01-01"))
    fitted = model.fit_preparation(train, NUMERIC, "kind")
    pdf = train.toPandas()
    assert fitted.categories == ("boleto", "card") and fitted.mode in ("boleto", "card")
    assert fitted.medians["z"] == pytest.approx(pdf["z"].median())
    filled = pdf["z"].fillna(pdf["z"].median())
    assert fitted.stds["z"] == pytest.approx(filled.std(ddof=0)) and fitted.stds["flat"] == 0.0
    out = fitted.transform(rows, ["order_id"]).toPandas().set_index("order_id")
    assert list(out.columns) == fitted.names == ["cat__kind_boleto", "cat__kind_card", "num__x", "num__z", "num__flat"]
    assert (out.loc[300:, ["cat__kind_boleto", "cat__kind_card"]] == 0).all().all()
    assert (out["num__flat"] == 0).all() and not out.isna().any().any()


def test_logistic_fit_has_zero_gradient(rows):
    train, _ = model.temporal_split(rows, CUTOFF)
    fitted = model.fit_preparation(train, NUMERIC, "kind")
    prepared = fitted.transform(train, ["is_late"])
    lr = model.fit_logistic(prepared, fitted.names)
    pdf = prepared.toPandas()
    x, y = pdf[fitted.names].to_numpy(), pdf["is_late"].to_numpy()
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    beta = np.array(lr.coefficients)
    p = 1 / (1 + np.exp(-(x @ beta + lr.intercept)))
    assert np.abs(x.T @ (weight * (p - y)) + beta).max() < 1e-8
    assert abs((weight * (p - y)).sum()) < 1e-8 and lr.steps <= 12


def test_logistic_fit_equals_spark_s_own(rows):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    train, _ = model.temporal_split(rows, CUTOFF)
    fitted = model.fit_preparation(train, NUMERIC, "kind")
    prepared = fitted.transform(train, ["is_late"])
    lr = model.fit_logistic(prepared, fitted.names, c=0.5)
    ready = VectorAssembler(inputCols=fitted.names, outputCol="features").transform(model.weighted_rows(prepared, fitted.names, "is_late"))
    n = train.count()
    other = LogisticRegression(weightCol="weight", regParam=2 / n, standardization=False, maxIter=1000, tol=1e-12).fit(ready)
    assert np.abs(np.array(lr.coefficients) - other.coefficients.toArray()).max() < 1e-6
    assert abs(lr.intercept - other.intercept) < 1e-6


def test_logistic_fit_of_one_class_and_of_nulls(spark):
    df = spark.createDataFrame([(1.0, 1), (2.0, 1)], "x double, is_late int")
    one = model.fit_logistic(df, ["x"])
    assert one.coefficients == (0.0,) and model.score(one, df, ["x"], []).first()[0] == 1.0
    with pytest.raises(ValueError):
        model.fit_logistic(spark.createDataFrame([(None, 1), (2.0, 0)], "x double, is_late int"), ["x"])


def test_drivers_add_up_and_rank(rows):
    train, _ = model.temporal_split(rows, CUTOFF)
    fitted = model.fit_preparation(train, NUMERIC, "kind")
    prepared = fitted.transform(rows, ["order_id", "date_key", "is_late"])
    coefficients = {n: c for n, c in zip(fitted.names, (0.3, -0.2, 1.0, -2.0, 5.0))}
    drivers = model.risk_drivers(prepared, coefficients)
    assert drivers.count() == 3 * rows.count()
    pdf = prepared.toPandas().set_index("order_id")
    for r in drivers.filter("order_id < 40").collect():
        parts = (pdf.loc[r.order_id, fitted.names] * np.array(list(coefficients.values()))).astype(float)
        best = parts.abs().sort_values(ascending=False, kind="stable")
        assert r.feature_name == best.index[r.driver_rank - 1]
        assert r.contribution == pytest.approx(parts[r.feature_name], abs=6e-5)
        assert r.direction == ("retard" if parts[r.feature_name] > 0 else "à l'heure")


def test_tier_uses_the_unrounded_probability(spark):
    df = spark.createDataFrame(
        [(1, dt.date(2018, 1, 1), 0.70815), (2, dt.date(2018, 7, 1), 0.59999), (3, dt.date(2018, 7, 1), 0.6)],
        "order_id int, date_key date, probability double",
    )
    got = {r.order_id: r for r in model.risk_scores(df, 0.7082, fixed.CUTOFF_DATE, "2020-01-01").collect()}
    assert got[1].risk_probability == 0.7082 and got[1].risk_tier == "Alerte"
    assert got[2].risk_probability == 0.6 and not got[2].is_flagged_risk
    assert got[3].is_flagged_risk and got[1].is_in_sample and not got[3].is_in_sample
    assert model.extreme_tier(0.7082) == "Risque extrême (probabilité >= 0.71)"


def test_trees_and_evaluation(rows):
    train, test = model.temporal_split(rows, CUTOFF)
    fitted = model.fit_preparation(train, NUMERIC, "kind")
    keep = ["order_id", "date_key", "is_late"]
    prepared = fitted.transform(rows, keep)
    trees = model.fit_boosted_trees(prepared.filter(model.in_train(CUTOFF)), fitted.names, settings=Settings(trees=5))
    scored = model.score(trees, prepared, fitted.names, keep).withColumn("model", F.lit("trees"))
    floor = model.majority_scores(train, rows, "is_late", keep).withColumn("model", F.lit("floor"))
    got = {r.model: r for r in evaluation.evaluate_models(scored.unionByName(floor)).collect()}
    assert got["floor"].recall == 0.0 and got["floor"].pr_auc == got["floor"].no_skill_pr_auc
    assert got["trees"].pr_auc > got["floor"].pr_auc


def test_integration_checks(spark):
    days = [dt.date(2018, 1, 1), dt.date(2018, 7, 1)]
    df = spark.createDataFrame([(i, days[i % 2], 0.5) for i in range(6)], "order_id int, date_key date, probability double")
    scores = model.risk_scores(df, 0.9, fixed.CUTOFF_DATE, "2020-01-01")
    drivers = df.select("order_id", F.explode(F.array(*[F.lit(i) for i in (1, 2, 3)])).alias("driver_rank"))
    train = df.filter(model.in_train(fixed.CUTOFF_DATE))
    model.assert_integration(model.integration_checks(scores, drivers, df, train))
    with pytest.raises(AssertionError):
        model.assert_integration(model.integration_checks(scores, drivers.limit(5), df, df))


def test_importance_comparison(spark):
    left = spark.createDataFrame([("a", 3.0), ("b", 2.0), ("c", 1.0)], "feature string, importance double")
    right = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 3.0)], "feature string, importance double")
    row = explain.importance_compare(left, right, 2).first()
    assert row.rho == pytest.approx(-1.0)
    assert (row.overlap, row.only_left, row.only_right) == ("b", "a", "c")
    with pytest.raises(AssertionError):
        explain.assert_same_features(["a"], ["b"])


def test_ablation_verdict(spark):
    rows = [
        ("reference: logistic", 0.16, 0.11, 1.42), ("baseline: boosted trees", 0.28, 0.087, 3.23),
        ("hypothesis: without s", 0.27, 0.095, 2.8), ("control: without d", 0.25, 0.07, 3.5),
    ]
    table = spark.createDataFrame(
        rows, "variant string, pr_auc_train double, pr_auc_test double, ratio_train_test double"
    )
    row = explain.ablation_verdict(table).first()
    assert row.pct_explained == pytest.approx(100 * 0.43 / 1.81) and row.is_specific


def test_permutation_importance_finds_the_feature_that_matters(spark):
    rng = np.random.default_rng(0)
    rows = [(i, float(a), float(b), int(a + 0.1 * c > 0)) for i, (a, b, c) in enumerate(rng.standard_normal((300, 3)))]
    df = spark.createDataFrame(rows, "order_id int, x double, z double, is_late int")
    fitted = model.fit_logistic(df, ["x", "z"])
    got = {r.feature: r.importance for r in explain.permutation_importance(fitted, df, ["x", "z"]).collect()}
    assert got["x"] > 0.2 and abs(got["z"]) < 0.05


def test_reported_trees_are_the_default(rows):
    first, settings = next(iter(explain.ablation_variants(["a"]).items()))
    assert first.startswith("baseline") and settings == Settings(trees=100, leaves=15, ridge=1.0)


def test_labelled_rows_shuffle_pairs_once_by_seller(spark):
    """Order and seller pairs are written, and their history is no join: seller keys meet in one exchange and in small totals."""
    from waybill.plans import features

    orders = spark.range(50).selectExpr(
        "id as order_id", "timestamp_ntz'2018-01-01' + make_dt_interval(cast(id as int)) as order_purchase_timestamp",
        "timestamp_ntz'2018-01-09' + make_dt_interval(cast(id as int)) as order_delivered_customer_date",
        "timestamp_ntz'2018-01-08' + make_dt_interval(cast(id as int)) as order_estimated_delivery_date",
    )
    items = spark.range(90).selectExpr("id % 50 as order_id", "id % 3 as seller_id")
    plan = features.smoothed_rates(orders, items)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1


def test_softmax_ends_where_the_gradient_is_zero_in_few_passes(spark):
    """Against the plain gradient, with rows without entries, frequent terms and rare ones."""
    from waybill.operators.softmax import fit_softmax

    rng = np.random.default_rng(2)
    n, size, classes = 400, 300, 3
    rows = []
    for i in range(n):
        taken = np.unique((size * rng.random(12) ** 3).astype(int)) if i % 40 else np.array([], int)
        values = rng.random(len(taken)) + 0.1
        values /= np.sqrt((values**2).sum()) or 1.0
        rows.append(([(int(p), float(v)) for p, v in zip(taken, values, strict=True)], float(rng.integers(classes)), 0.5 + i % 3))
    df = spark.createDataFrame(rows, "entries array<struct<position:int,weight:double>>, label double, weight double")
    fitted = fit_softmax(df.repartition(3), size, classes)
    x = np.zeros((n, size))
    for i, (entries, _, _) in enumerate(rows):
        for p, v in entries:
            x[i, p] = v
    y, w = np.array([int(r[1]) for r in rows]), np.array([r[2] for r in rows])
    z = x @ fitted.coefficients.T + fitted.intercepts
    p = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
    miss = w[:, None] * (p - np.eye(classes)[y])
    assert np.abs(miss.T @ x + fitted.coefficients).max() / w.sum() < 1e-8
    assert np.abs(miss.sum(axis=0)).max() / w.sum() < 1e-8 and abs(fitted.intercepts.sum()) < 1e-9
    assert fitted.passes < 60


@pytest.mark.parametrize("kept", [1 << 18, 40])
def test_softmax_by_rows_finds_the_same_optimum_without_a_vector_of_terms(spark, monkeypatch, kept):
    """More terms than rows: the driver sends and gets a figure per row and class only, whatever ranges there are."""
    from waybill.operators import softmax

    rng = np.random.default_rng(5)
    n, size, classes = 90, 700, 3
    rows = []
    for i in range(n):
        taken = np.unique((size * rng.random(15) ** 3).astype(int)) if i % 30 else np.array([], int)
        values = rng.random(len(taken)) + 0.1
        values /= np.sqrt((values**2).sum()) or 1.0
        rows.append(([(int(p), float(v)) for p, v in zip(taken, values, strict=True)], float(rng.integers(classes)), 0.5 + i % 3))
    df = spark.createDataFrame(rows, "entries array<struct<position:int,weight:double>>, label double, weight double").repartition(3)
    monkeypatch.setattr(softmax, "RANGE", kept)
    monkeypatch.setattr(softmax, "TASK", 4 * kept)
    products, product = [], softmax._Ranges.product
    monkeypatch.setattr(softmax._Ranges, "product", lambda self, f: products.append((f.size, (found := product(self, f)).size)) or found)
    fitted = softmax.fit_by_rows(df, size, classes)
    want = softmax.fit_softmax(df, size, classes)
    assert set(products) == {(n * classes, n * classes)} and fitted.passes == len(products) < 100
    table = {r.position: r.b for r in fitted.coefficients.collect()}
    for position in range(size):
        assert table.get(position, [0.0] * classes) == pytest.approx(list(want.coefficients[:, position]), abs=1e-6)
    assert list(fitted.intercepts) == pytest.approx(list(want.intercepts), abs=1e-6)
    assert abs(sum(fitted.intercepts)) < 1e-9
