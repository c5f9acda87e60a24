"""Which features matter: coefficients, contributions, comparisons, ablations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waybill import fixed_values as fixed
from waybill.operators.boosting import BoostedTrees, Settings
from waybill.operators.metrics import average_precision
from waybill.operators.picking import seeded_draw
from waybill.plans import model
from waybill.session import materialised


def coefficient_table(spark, coefficients: Mapping[str, float], n: int) -> DataFrame:
    rows = spark.createDataFrame(list(coefficients.items()), "feature string, coef double")
    return (
        rows.withColumn("abs_coef", F.abs("coef"))
        .orderBy(F.desc("abs_coef"), "feature")
        .limit(n)
        .select("feature", F.round("coef", 4).alias("coef"), F.round("abs_coef", 4).alias("abs_coef"))
    )


def mean_abs_contribution(prepared: DataFrame, coefficients: Mapping[str, float]) -> DataFrame:
    """(feature, importance) for all features, one pass, one aggregation."""
    parts = model.contributions(coefficients)
    means = F.array(
        *[
            F.struct(F.lit(n).alias("feature"), F.avg(F.abs(c)).alias("importance"))
            for n, c in parts.items()
        ]
    )
    return prepared.agg(means.alias("__means")).select(F.inline("__means"))


def global_importance(
    prepared: DataFrame, coefficients: Mapping[str, float], n: int = fixed.N_TOP_FEATURES_GLOBAL
) -> DataFrame:
    return (
        mean_abs_contribution(prepared, coefficients)
        .orderBy(F.desc("importance"), "feature")
        .limit(n)
    )


def additivity(run) -> DataFrame:
    """(order_id, gap): distance of an order's log-odds from intercept plus contributions."""
    parts = list(model.contributions(run.coefficients).values())
    total = reduce(lambda a, b: a + b, parts, F.lit(run.intercept))
    explained = run.prepared.select("order_id", total.alias("explained"))
    p = F.col("probability")
    return run.scored.join(explained, "order_id").select(
        "order_id", F.abs(F.log(p / (1 - p)) - F.col("explained")).alias("gap")
    )


def stationarity(run, cutoff: str) -> DataFrame:
    """(feature, gradient) of the weighted, penalised loss at the fitted coefficients.

    Balanced weights and the penalty as in ``model.fit_logistic``, per unit of weight:
    mean of weight x (probability - label) x value, plus coefficient / n.
    """
    train = run.prepared.filter(model.in_train(cutoff)).join(run.scored.select("order_id", "probability"), "order_id")
    weights = {r["is_late"]: r["weight"] for r in model.class_weights(train, "is_late").collect()}
    miss = model.weight_column(weights, "is_late") * (F.col("probability") - F.col("is_late"))
    n = F.count(F.lit(1))
    rows = [
        F.struct(F.lit(f).alias("feature"), (F.avg(miss * F.col(f)) + F.lit(c) / n).alias("gradient"))
        for f, c in run.coefficients.items()
    ]
    rows.append(F.struct(F.lit("(intercept)").alias("feature"), F.avg(miss).alias("gradient")))
    return train.agg(F.array(*rows).alias("__rows")).select(F.inline("__rows"))


def tree_contributions(trees: BoostedTrees, prepared: DataFrame, keep: Sequence[str] = ("order_id",)) -> DataFrame:
    """``keep`` columns and a column per model feature: its share of the trees' log-odds.

    Exact Shapley values; with ``trees.base`` they add up to the log-odds of the row.
    """
    parts = trees.attributions(prepared, keep)
    return parts.select(*keep, *[F.get("parts", F.lit(k)).alias(n) for k, n in enumerate(trees.names)])


def tree_importance(trees: BoostedTrees, prepared: DataFrame) -> DataFrame:
    """(feature, importance): mean absolute contribution over the rows, for all features."""
    ones = dict.fromkeys(trees.names, 1.0)
    return mean_abs_contribution(tree_contributions(trees, prepared, []), ones)


def tree_leaf_gaps(trees: BoostedTrees, train: DataFrame, settings: Settings, key: str = "order_id") -> DataFrame:
    """(tree, leaf, gap): distance of a leaf's value from what its training rows say it should be.

    Weighted gradients and Hessians are taken at the scores before the tree, which are the
    sums of the leaf values of the trees before it.
    """
    weights = {r["is_late"]: r["weight"] for r in model.class_weights(train, "is_late").collect()}
    members = trees.leaves(train, [key, "is_late"]).withColumn("weight", model.weight_column(weights, "is_late"))
    earlier = Window.partitionBy(key).orderBy("tree").rowsBetween(Window.unboundedPreceding, -1)
    p = 1 / (1 + F.exp(-F.coalesce(F.sum("value").over(earlier), F.lit(0.0))))
    rows = members.withColumn("p", p)
    gradient, hessian = F.sum(F.col("weight") * (F.col("p") - F.col("is_late"))), F.sum(F.col("weight") * F.col("p") * (1 - F.col("p")))
    value = -settings.rate * gradient / (hessian + settings.ridge)
    return rows.groupBy("tree", "leaf").agg(F.abs(value - F.min("value")).alias("gap"))


def permutation_importance(
    fitted, rows: DataFrame, names: Sequence[str], key: str = "order_id", label: str = "is_late", seed: int = 42
) -> DataFrame:
    """(feature, importance): how much average precision is lost when a feature's values are permuted.

    One job for all features. Rows are dealt by hash into buckets of about a thousand; each
    takes the value of the next row in its bucket's drawn order, the last one that of the
    first, so every column is permuted and no row is looked up elsewhere.
    """
    buckets = max(1, rows.count() // 1000)
    order = Window.partitionBy("__bucket").orderBy("__draw", key)
    values = F.array(*[F.col(n).cast("double") for n in names])
    drawn = rows.select(
        key, label, values.alias("__own"), seeded_draw([key], seed).alias("__draw"), F.pmod(F.xxhash64(key), F.lit(buckets)).alias("__bucket")
    )
    given = F.coalesce(
        F.lead("__own").over(order),
        F.first("__own").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
    )
    which = F.explode(F.sequence(F.lit(-1), F.lit(len(names) - 1))).alias("__changed")
    variants = drawn.withColumn("__other", given).select(label, "__own", "__other", which)
    mixed = F.transform("__own", lambda v, i: F.when(i == F.col("__changed"), F.get(F.col("__other"), i)).otherwise(v))
    columns = variants.select(label, "__changed", mixed.alias("__x")).select(label, "__changed", *[F.get("__x", F.lit(i)).alias(n) for i, n in enumerate(names)])
    scored = model.score(fitted, columns, names, [label, "__changed"])
    found = materialised(average_precision(scored, ["__changed"], "probability", label))
    whole = found.filter("__changed = -1").select("average_precision").scalar()
    feature = F.get(F.array(*[F.lit(n) for n in names]), F.col("__changed"))
    return found.filter("__changed >= 0").select(
        feature.alias("feature"), (whole - F.col("average_precision")).alias("importance")
    )


def importance_ranks(left: DataFrame, right: DataFrame) -> DataFrame:
    """Both importances per feature with competition and average ranks.

    One row per model feature, so ordering them needs no partitioning.
    """
    joined = left.select("feature", F.col("importance").alias("left_importance")).join(
        right.select("feature", F.col("importance").alias("right_importance")), "feature"
    )

    def ranks(side: str) -> list:
        descending = Window.orderBy(F.desc(f"{side}_importance"))
        ties = Window.partitionBy(f"{side}_importance")
        place = F.rank().over(descending)
        return [
            place.alias(f"rank_{side}"),
            (place + (F.count(F.lit(1)).over(ties) - 1) / 2).alias(f"average_rank_{side}"),
        ]

    return joined.select("feature", "left_importance", "right_importance", *ranks("left"), *ranks("right"))


def importance_compare(left: DataFrame, right: DataFrame, n: int) -> DataFrame:
    """One row: Spearman correlation, and overlap and differences of the two top-``n`` sets."""
    ranked = importance_ranks(left, right)
    on_left, on_right = F.col("rank_left") <= n, F.col("rank_right") <= n
    return ranked.agg(
        F.corr("average_rank_left", "average_rank_right").alias("rho"),
        F.count(F.lit(1)).alias("n_features"),
        F.count_if(on_left & on_right).alias("n_overlap"),
        F.array_join(F.array_sort(F.collect_set(F.when(on_left & on_right, F.col("feature")))), ",").alias("overlap"),
        F.array_join(F.array_sort(F.collect_set(F.when(on_left & ~on_right, F.col("feature")))), ",").alias("only_left"),
        F.array_join(F.array_sort(F.collect_set(F.when(~on_left & on_right, F.col("feature")))), ",").alias("only_right"),
    )


def extreme_examples(scored: DataFrame, key: str = "order_id") -> DataFrame:
    """Best hit, worst false alarm and worst miss: (example, key, label, probability)."""
    late = F.col("is_late") == 1
    row = F.struct(key, "is_late", "probability")

    def pick(kind: str, condition, sign: int):
        order = F.struct((sign * F.col("probability")).alias("p"), F.col(key).alias("k"))
        found = F.min_by(row, F.when(condition, order))
        return F.struct(F.lit(kind).alias("example"), found.alias("row"))

    picks = F.array(
        pick("true_positive", late, -1),
        pick("false_positive", ~late, -1),
        pick("false_negative", late, 1),
    )
    return (
        scored.agg(picks.alias("__picks"))
        .select(F.inline("__picks"))
        .select("example", "row.*")
        .filter(F.col(key).isNotNull())
    )


def local_explanations(
    prepared: DataFrame,
    examples: DataFrame,
    coefficients: Mapping[str, float],
    n: int = fixed.N_TOP_FEATURES_LOCAL,
    key: str = "order_id",
) -> DataFrame:
    """Top contributions of the picked orders (at most three)."""
    few = prepared.join(F.broadcast(examples.select("example", key)), key)
    drivers = model.risk_drivers(few, coefficients, key, n)
    return examples.join(drivers, key)


def assert_same_features(left: Sequence[str], right: Sequence[str]) -> None:
    if list(left) != list(right):
        raise AssertionError("the two models do not see the same transformed features")


def ablation_variants(names: Sequence[str]) -> dict[str, Settings]:
    """Label and settings; one change at a time, one combination."""
    def without(feature: str) -> tuple[str, ...]:
        return tuple(n for n in names if n != f"num__{feature}")

    suspect = fixed.ABLATION_SUSPECT
    return {
        "baseline: boosted trees": Settings(),
        f"hypothesis: without {suspect}": Settings(without(suspect)),
        **{f"control: without {c}": Settings(without(c)) for c in fixed.ABLATION_CONTROLS},
        "capacity: 7 leaves": Settings(leaves=7),
        "capacity: 30 trees": Settings(trees=30),
        f"combination: without {suspect}, 7 leaves": Settings(without(suspect), leaves=7),
    }


def ablation_scores(
    train: DataFrame, test: DataFrame, names: Sequence[str], fitted: Mapping[str, BoostedTrees] | None = None
) -> DataFrame:
    """Train and test scores of every variant: (variant, split, is_late, probability).

    All variants of the trees grow in the same passes over the training rows. ``fitted``
    are variants fitted before on the same rows.
    """
    fitted = fitted or model.fit_tree_variants(train, names, ablation_variants(names))
    models = {"reference: logistic": model.fit_logistic(train, names), **fitted}
    parts = [
        model.score(m, rows, names, ["is_late"]).withColumns({"variant": F.lit(label), "split": F.lit(split)})
        for label, m in models.items()
        for split, rows in (("train", train), ("test", test))
    ]
    return reduce(DataFrame.unionByName, parts)


def ablation_table(scores: DataFrame) -> DataFrame:
    """Average precision on train and test per variant, and their ratio."""
    ap = average_precision(scores, ["variant", "split"], "probability", "is_late", "ap")
    wide = ap.groupBy("variant").agg(
        F.max(F.when(F.col("split") == "train", F.col("ap"))).alias("ap_train"),
        F.max(F.when(F.col("split") == "test", F.col("ap"))).alias("ap_test"),
    )
    return wide.select(
        "variant",
        F.round("ap_train", 4).alias("pr_auc_train"),
        F.round("ap_test", 4).alias("pr_auc_test"),
        F.round(F.col("ap_train") / F.nullif(F.col("ap_test"), F.lit(0.0)), 2).alias("ratio_train_test"),
    ).orderBy("variant")


def ablation_verdict(table: DataFrame) -> DataFrame:
    """How much of the train/test gap the suspect explains, and whether only it does.

    The table has one row per variant; the result is one row.
    """
    def value(prefix: str, column: str):
        return F.max(F.when(F.col("variant").startswith(prefix), F.col(column)))

    logistic, base = value("reference", "ratio_train_test"), value("baseline", "ratio_train_test")
    without, base_test = value("hypothesis", "ratio_train_test"), value("baseline", "pr_auc_test")
    gap = base - logistic
    best_control = F.max(F.when(F.col("variant").startswith("control"), F.col("pr_auc_test")))
    return table.agg(
        F.when(gap > 0, 100 * (base - without) / gap).alias("pct_explained"),
        ((value("hypothesis", "pr_auc_test") >= base_test) & (best_control < base_test)).alias("is_specific"),
    )


def distinct_share(df: DataFrame, column: str) -> DataFrame:
    """How close to unique a feature is."""
    per_value = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    rows = df.agg(F.count(F.lit(1)))
    return per_value.agg(F.count(F.lit(1)).alias("n_distinct")).select(
        "n_distinct",
        rows.scalar().alias("n_rows"),
        (100.0 * F.col("n_distinct") / F.nullif(rows.scalar(), F.lit(0))).alias("pct_distinct"),
    )
