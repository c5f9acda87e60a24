"""Late-delivery model: preparation, fits, scores and exact linear drivers.

Fitted state (medians, means, scales, category list, coefficients) is a handful
of numbers per feature; everything per order stays on the executors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill import fixed_values as fixed
from waybill.operators import boosting
from waybill.operators.picking import top_entries
from waybill.operators.quality import assert_no_forbidden, key_set_difference
from waybill.operators.quantiles import exact_quantiles


def feature_columns(columns: Sequence[str]) -> list[str]:
    """Model inputs of a labelled feature table; refuses leaked columns."""
    names = [c for c in columns if c not in fixed.NON_FEATURE_COLUMNS]
    assert_no_forbidden(names, fixed.FORBIDDEN_FEATURE_COLUMNS)
    return names


# --- split -----------------------------------------------------------------


def in_train(cutoff: str) -> Column:
    return F.col("date_key") < F.lit(cutoff).cast("date")


def temporal_split(df: DataFrame, cutoff: str) -> tuple[DataFrame, DataFrame]:
    """Bought before the cutoff, bought from the cutoff on. Never shuffled."""
    return df.filter(in_train(cutoff)), df.filter(~in_train(cutoff))


def split_report(df: DataFrame, cutoff: str) -> DataFrame:
    train = in_train(cutoff)
    return df.agg(
        F.count_if(train).alias("n_train"),
        F.count_if(~train).alias("n_test"),
        F.max(F.when(train, F.col("date_key"))).alias("last_train"),
        F.min(F.when(~train, F.col("date_key"))).alias("first_test"),
    )


def assert_split(report: DataFrame) -> None:
    row = report.first()
    if row["last_train"] is None or row["first_test"] is None or row["last_train"] >= row["first_test"]:
        raise AssertionError(f"split is not in time order: {row.asDict()}")


# --- preparation -----------------------------------------------------------


def long_form(df: DataFrame, columns: Sequence[str], name: str = "feature") -> DataFrame:
    """(feature, value) rows of several numeric columns."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias(name), F.col(c).cast("double").alias("value")) for c in columns]
    )
    return df.select(F.inline(pairs))


def medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact median per column, NULLs ignored: (feature, median)."""
    return exact_quantiles(
        long_form(df, columns), ["feature"], "value", {"median": 0.5}, few_groups=True
    )


def most_frequent(df: DataFrame, column: str) -> DataFrame:
    """The mode of a column, ties by smallest value."""
    counts = (
        df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    )
    best = F.min(F.struct((-F.col("n")).alias("less"), F.col(column).alias("pick")))
    return counts.agg(best["pick"].alias("most_frequent"))


def category_counts(df: DataFrame, column: str) -> dict[str, int]:
    """Rows per category seen while fitting; as many entries as one-hot columns."""
    rows = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return {r[column]: r["n"] for r in rows.collect()}


def filled(columns: Sequence[str], values: Mapping[str, float]) -> dict[str, Column]:
    return {
        c: F.coalesce(F.col(c).cast("double"), F.lit(values.get(c)).cast("double")) for c in columns
    }


def moments(df: DataFrame, columns: Sequence[str], values: Mapping[str, float]) -> DataFrame:
    """Mean and population standard deviation per imputed column, in one row."""
    columns_now = filled(columns, values)
    return df.agg(
        *[F.avg(c).alias(f"{n}__mean") for n, c in columns_now.items()],
        *[F.stddev_pop(c).alias(f"{n}__std") for n, c in columns_now.items()],
    )


@dataclass(frozen=True)
class Preparation:
    """Imputation, one-hot encoding and scaling learnt from the training rows."""

    numeric: tuple[str, ...]
    categorical: str
    medians: Mapping[str, float]
    mode: str | None
    categories: tuple[str, ...]
    means: Mapping[str, float]
    stds: Mapping[str, float]

    @property
    def names(self) -> list[str]:
        return [f"cat__{self.categorical}_{c}" for c in self.categories] + [
            f"num__{n}" for n in self.numeric
        ]

    def columns(self) -> dict[str, Column]:
        """Transformed columns by name; categories never seen in training are all zero."""
        value = F.coalesce(F.col(self.categorical), F.lit(self.mode))
        encoded = {
            f"cat__{self.categorical}_{c}": F.coalesce((value == c).cast("double"), F.lit(0.0))
            for c in self.categories
        }
        imputed = filled(self.numeric, self.medians)
        scaled = {
            f"num__{n}": (imputed[n] - F.lit(self.means[n])) / F.lit(self.stds[n] or 1.0)
            for n in self.numeric
        }
        return encoded | scaled

    def transform(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        return df.select(*keep, *[c.alias(n) for n, c in self.columns().items()])


def fit_preparation(
    train: DataFrame,
    numeric: Sequence[str] = tuple(fixed.NUMERIC_FEATURES),
    categorical: str = fixed.CATEGORICAL_FEATURE,
) -> Preparation:
    middle = {r["feature"]: r["median"] for r in medians(train, numeric).collect()}
    row = moments(train, numeric, middle).first()
    seen = category_counts(train, categorical)
    return Preparation(
        numeric=tuple(numeric),
        categorical=categorical,
        medians=middle,
        mode=min(seen, key=lambda c: (-seen[c], c), default=None),
        categories=tuple(sorted(seen)),
        means={n: row[f"{n}__mean"] for n in numeric},
        stds={n: row[f"{n}__std"] for n in numeric},
    )


# --- class weights and fits ------------------------------------------------


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, n, weight) with weight = n_total / (n_classes * n)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    whole = counts.agg((F.sum("n") / F.count(F.lit(1))).alias("share"))
    return counts.withColumn("weight", whole.scalar() / F.col("n"))


def weight_column(weights: Mapping[object, float], label: str) -> Column:
    column = F.lit(None).cast("double")
    for value, weight in weights.items():
        column = F.when(F.col(label) == F.lit(value), F.lit(weight)).otherwise(column)
    return column


def weighted_rows(prepared: DataFrame, names: Sequence[str], label: str) -> DataFrame:
    """``names`` with label and weight of balanced classes; rows without a label are left out."""
    rows = class_weights(prepared, label).collect()
    weights = {r[label]: r["weight"] for r in rows if r[label] is not None}
    return prepared.where(F.col(label).isNotNull()).select(
        *names, F.col(label).cast("double").alias("label"), weight_column(weights, label).alias("weight")
    )


@dataclass(frozen=True)
class LogisticFit:
    """Coefficients of a logistic regression on prepared columns, and the steps that it took."""

    names: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float
    steps: int

    @property
    def numFeatures(self) -> int:  # noqa: N802 as Spark's own models have it
        return len(self.names)

    def probability(self) -> Column:
        """Probability of label 1 as an expression over the prepared columns."""
        terms = [F.col(n) * F.lit(c) for n, c in zip(self.names, self.coefficients, strict=True)]
        return 1 / (1 + F.exp(-reduce(lambda a, b: a + b, terms, F.lit(self.intercept))))


def _newton_sums(beta: np.ndarray):
    """Per batch of rows (features, label, weight): loss, gradient and Hessian of the weighted log loss, flat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(beta)
        total = np.zeros(1 + k + k * k)
        for b in batches:
            values = b.column("features").flatten().to_numpy(zero_copy_only=False)
            x = np.column_stack([values.reshape(b.num_rows, k - 1), np.ones(b.num_rows)])
            y, w = b.column("label").to_numpy(), b.column("weight").to_numpy()
            z = x @ beta
            p = 1 / (1 + np.exp(-np.clip(z, -700, 700)))
            total[0] += np.sum(w * (np.logaddexp(0, z) - y * z))
            total[1 : 1 + k] += x.T @ (w * (p - y))
            total[1 + k :] += ((x * (w * p * (1 - p))[:, None]).T @ x).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], ["at", "v"])

    return run


def fit_logistic(
    prepared: DataFrame,
    names: Sequence[str],
    label: str = "is_late",
    c: float = 1.0,
    tolerance: float = 1e-10,
    most_steps: int = 100,
) -> LogisticFit:
    """L2 logistic regression with balanced classes on already scaled columns, by Newton's method.

    The objective is the sum of weighted log losses plus |coefficients|^2 / (2 C), the
    intercept being free. A step needs its gradient and its Hessian, a square of the number
    of features, whatever the number of rows: one pass, summed a partition at a time and
    then over partitions. A step that doesn't lower the objective is halved. With one class
    only there is nothing to learn: all coefficients are 0 and the probability is 0 or 1.

    ``prepared`` is read once a step (some seven of them), so it is best a written table.
    """
    counts = class_weights(prepared, label).collect()
    weights = {r[label]: r["weight"] for r in counts if r[label] is not None}
    if len(weights) < 2:
        return LogisticFit(tuple(names), (0.0,) * len(names), math.inf if 1 in weights else -math.inf, 0)
    rows = prepared.where(F.col(label).isNotNull()).select(
        F.array(*[F.col(n).cast("double") for n in names]).alias("features"),
        F.col(label).cast("double").alias("label"),
        weight_column(weights, label).alias("weight"),
    )
    k = len(names) + 1
    ridge = np.append(np.full(k - 1, 1.0 / c), 0.0)

    def objective(beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        parts = rows.mapInArrow(_newton_sums(beta), "at int, v double").groupBy("at").agg(F.sum("v").alias("v"))
        flat = np.zeros(1 + k + k * k)
        for r in parts.collect():
            flat[r["at"]] = r["v"]
        if not np.isfinite(flat).all():
            raise ValueError("prepared columns hold nulls or values that are not finite")
        return flat[0] + 0.5 * float(ridge @ beta**2), flat[1 : 1 + k] + ridge * beta, flat[1 + k :].reshape(k, k) + np.diag(ridge)

    beta, steps = np.zeros(k), 0
    loss, gradient, hessian = objective(beta)
    while steps < most_steps:
        move = np.linalg.lstsq(hessian, gradient, rcond=None)[0]
        share = 1.0
        while True:
            steps += 1
            tried = objective(beta - share * move)
            if tried[0] <= loss + 1e-12 * abs(loss) or share < 1e-6 or steps >= most_steps:
                break
            share /= 2
        beta, (loss, gradient, hessian) = beta - share * move, tried
        if np.abs(share * move).max() <= tolerance * max(1.0, np.abs(beta).max()):
            break
    return LogisticFit(tuple(names), tuple(float(b) for b in beta[:-1]), float(beta[-1]), steps)


def fit_boosted_trees(
    prepared: DataFrame, names: Sequence[str], label: str = "is_late", settings: boosting.Settings | None = None
) -> boosting.BoostedTrees:
    """Leaf-wise boosted trees with balanced classes: 100 trees of 15 leaves, L2 penalty 1."""
    return fit_tree_variants(prepared, names, {"": settings or boosting.Settings()}, label)[""]


def fit_tree_variants(
    prepared: DataFrame, names: Sequence[str], variants: Mapping[str, boosting.Settings], label: str = "is_late"
) -> dict[str, boosting.BoostedTrees]:
    """Several models of boosted trees, grown in the same passes over the rows."""
    return boosting.fit_models(weighted_rows(prepared, names, label), names, variants)


def score(model, prepared: DataFrame, names: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """``keep`` columns plus the probability of being late."""
    if isinstance(model, LogisticFit):
        return prepared.select(*keep, model.probability().alias("probability"))
    return model.scored(prepared, keep).select(*keep, "probability")


def majority_scores(train: DataFrame, rows: DataFrame, label: str, keep: Sequence[str]) -> DataFrame:
    """The floor model: always the most frequent class, constant score 0 or 1."""
    counts = train.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("less"), F.col(label).alias("pick")))
    winner = counts.agg(best["pick"]).scalar()
    return rows.select(*keep, winner.cast("double").alias("probability"))


# --- scores and drivers ----------------------------------------------------


def extreme_tier(q90: float) -> str:
    return f"{fixed.RISK_TIER_EXTREME_PREFIX} (probabilité >= {q90:.2f})"


def risk_tier(probability: Column, q90: float) -> Column:
    """Tier from the unrounded probability; the rounded cut is compared as given."""
    return (
        F.when(probability >= q90, F.lit(extreme_tier(q90)))
        .when(probability >= fixed.DECISION_THRESHOLD, F.lit(fixed.RISK_TIER_ALERT))
        .otherwise(F.lit(fixed.RISK_TIER_LOW))
    )


def risk_scores(scored: DataFrame, q90: float, cutoff: str, scored_at: str) -> DataFrame:
    """Score table of all orders from (order_id, date_key, probability)."""
    p = F.col("probability")
    return scored.select(
        "order_id",
        F.round(p, 4).alias("risk_probability"),
        in_train(cutoff).alias("is_in_sample"),
        (p >= fixed.DECISION_THRESHOLD).alias("is_flagged_risk"),
        risk_tier(p, q90).alias("risk_tier"),
        F.lit(scored_at).cast("timestamp").alias("scored_at"),
    )


def contributions(coefficients: Mapping[str, float]) -> dict[str, Column]:
    """coefficient x transformed value; they add up to the log-odds minus the intercept."""
    return {name: F.col(name) * F.lit(float(c)) for name, c in coefficients.items()}


def risk_drivers(
    prepared: DataFrame,
    coefficients: Mapping[str, float],
    key: str = "order_id",
    top: int = fixed.N_TOP_DRIVERS,
) -> DataFrame:
    """The ``top`` contributions per order by absolute size. Row-local, no shuffle."""
    parts = contributions(coefficients)
    best = top_entries(list(parts), list(parts.values()), top)
    return prepared.select(key, F.posexplode(best).alias("place", "entry")).select(
        key,
        (F.col("place") + 1).alias("driver_rank"),
        F.col("entry.name").alias("feature_name"),
        F.round("entry.value", 4).alias("contribution"),
        F.when(F.col("entry.value") > 0, fixed.DIRECTION_UP)
        .otherwise(fixed.DIRECTION_DOWN)
        .alias("direction"),
    )


def integration_checks(
    scores: DataFrame, drivers: DataFrame, features: DataFrame, train: DataFrame
) -> DataFrame:
    """One row: row counts and in-sample differences; see ``assert_integration``."""
    ids = key_set_difference(scores.filter("is_in_sample"), train, "order_id")
    count = F.count(F.lit(1))
    return ids.select(
        "only_left",
        "only_right",
        scores.agg(count).scalar().alias("n_scores"),
        drivers.agg(count).scalar().alias("n_drivers"),
        features.agg(count).scalar().alias("n_orders"),
    )


def assert_integration(checks: DataFrame, top: int = fixed.N_TOP_DRIVERS) -> None:
    row = checks.first()
    problems = []
    if row["n_scores"] != row["n_orders"]:
        problems.append("scores do not cover the population")
    if row["n_drivers"] != top * row["n_orders"]:
        problems.append(f"drivers are not {top} per order")
    if row["only_left"] or row["only_right"]:
        problems.append("in-sample orders are not the training orders")
    if problems:
        raise AssertionError("; ".join(problems))


def assert_covered(orders: Mapping, scores: Mapping, drivers: Mapping, top: int = fixed.N_TOP_DRIVERS) -> None:
    """The checks of ``assert_integration`` from figures taken while the tables were written."""
    keys = ("rows", "keys_1", "keys_2")
    problems = []
    if any(scores[k] != orders[k] for k in keys):
        problems.append("scores do not cover the population")
    if drivers["all"] != top * orders["rows"] or any(drivers[k] != orders[k] for k in keys):
        problems.append(f"drivers are not {top} per order")
    if any(scores[f"train_{k}"] != orders[f"train_{k}"] for k in keys):
        problems.append("in-sample orders are not the training orders")
    if problems:
        raise AssertionError("; ".join(problems))
