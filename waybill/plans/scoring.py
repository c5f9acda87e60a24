"""The scoring run end to end: features in, score and driver tables out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill import fixed_values as fixed
from waybill.operators.boosting import BoostedTrees
from waybill.plans import evaluation, features, model
from waybill.session import key_sums, materialised, observed


def _prefixed(prefix: str, figures: dict) -> dict:
    return {f"{prefix}_{n}": c for n, c in figures.items()}


@dataclass(frozen=True)
class ScoringRun:
    prepared: DataFrame
    names: list[str]
    coefficients: dict[str, float]
    intercept: float
    scored: DataFrame
    scores: DataFrame
    drivers: DataFrame
    q90: float


def labelled(w) -> DataFrame:
    """Checked features with target, written once: every later step makes several passes."""
    return features.checked_labelled(w)


def prepare(rows: DataFrame, cutoff: str) -> tuple[DataFrame, list[str]]:
    """Imputed, encoded and scaled columns for all rows, learnt before the cutoff only."""
    model.feature_columns(rows.columns)
    fitted = model.fit_preparation(rows.filter(model.in_train(cutoff)))
    return fitted.transform(rows, ["order_id", "date_key", "is_late"]), fitted.names


def run(rows: DataFrame, cutoff: str = fixed.CUTOFF_DATE, scored_at: str = "1970-01-01") -> ScoringRun:
    """Fit on orders before ``cutoff``, then score and explain all orders.

    ``scored_at`` is given by the caller so a rerun reproduces the same tables.
    """
    model.assert_split(model.split_report(rows, cutoff))
    prepared, names = prepare(rows, cutoff)
    # Written: each step of the fit, the cut, scores and drivers read it. The figures of
    # the writes say whether scores and drivers cover the orders, without a pass of their own.
    in_train = model.in_train(cutoff)
    prepared, orders = observed(prepared, **key_sums("order_id"), **_prefixed("train", key_sums("order_id", in_train)))
    train = prepared.filter(in_train)
    fitted = model.fit_logistic(train, names)
    coefficients = dict(zip(names, fitted.coefficients, strict=True))
    scored = model.score(fitted, prepared, names, ["order_id", "date_key", "is_late"])
    q90 = evaluation.q90_cut(scored.filter(~in_train))
    scores, scores_seen = observed(
        model.risk_scores(scored, q90, cutoff, scored_at), **key_sums("order_id"), **_prefixed("train", key_sums("order_id", F.col("is_in_sample")))
    )
    drivers, drivers_seen = observed(model.risk_drivers(prepared, coefficients), **key_sums("order_id", F.col("driver_rank") == 1), all=F.count(F.lit(1)))
    model.assert_covered(orders, scores_seen, drivers_seen)
    return ScoringRun(
        prepared=prepared,
        names=names,
        coefficients=coefficients,
        intercept=float(fitted.intercept),
        scored=scored,
        scores=scores,
        drivers=drivers,
        q90=q90,
    )


def model_comparison(rows: DataFrame, cutoff: str, boosted: BoostedTrees | None = None) -> DataFrame:
    """(model, order_id, date_key, is_late, is_in_sample, probability) for all three models.

    ``boosted`` are trees fitted before on the same rows and cutoff; else they are fitted here.
    """
    prepared, names = prepare(rows, cutoff)
    prepared = materialised(prepared)
    train = prepared.filter(model.in_train(cutoff))
    keep = ["order_id", "date_key", "is_late"]
    linear = model.fit_logistic(train, names)
    boosted = boosted or model.fit_boosted_trees(train, names)
    if not len(names) == linear.numFeatures == boosted.numFeatures:
        raise AssertionError("the models do not see the same transformed features")
    scored = {
        "majority": model.majority_scores(train, prepared, "is_late", keep),
        "logistic": model.score(linear, prepared, names, keep),
        "boosted_trees": model.score(boosted, prepared, names, keep),
    }
    parts = [df.withColumn("model", F.lit(name)) for name, df in scored.items()]
    result = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return result.withColumn("is_in_sample", model.in_train(cutoff))
