"""Classification metrics as aggregations. Scores stay distributed; only
score, threshold or class level counts are ever ordered."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waybill.functions.numbers import grid_position, percent, zero_ratio
from waybill.operators.quantiles import exact_quantiles
from waybill.operators.running import running_totals
from waybill.session import materialised

SCORE_STEPS = 100_000


def average_precision(
    df: DataFrame, keys: Sequence[str], score: str, label: str, name: str = "average_precision"
) -> DataFrame:
    """Step-wise average precision per group; equal scores form one step.

    0 when a group has no positive label.
    """
    steps = (
        df.groupBy(*keys, (-F.col(score)).alias("__descent"))
        .agg(F.count(F.lit(1)).alias("__n"), F.sum(F.col(label).cast("long")).alias("__tp"))
        .withColumn("__new", F.col("__tp"))
    )
    descent = F.col("__descent")
    curve = running_totals(
        steps,
        keys,
        "__descent",
        ["__n", "__tp"],
        F.floor(descent * SCORE_STEPS),
    )
    area = F.sum(F.col("__new") * (F.col("__tp") / F.col("__n")))
    return curve.groupBy(*keys).agg(
        F.coalesce(area / F.nullif(F.sum("__new"), F.lit(0)), F.lit(0.0)).alias(name)
    )


def binary_metrics(df: DataFrame, keys: Sequence[str], label: str, predicted: str) -> DataFrame:
    """Counts, base rate, precision, recall and F1 (0 when undefined) per group."""
    y, hit = F.col(label) == 1, F.col(predicted) == 1
    counts = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(y).alias("n_positive"),
        F.count_if(y & hit).alias("tp"),
        F.count_if(~y & hit).alias("fp"),
        F.count_if(y & ~hit).alias("fn"),
        F.count_if(~y & ~hit).alias("tn"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select(
        *keys,
        "n",
        "n_positive",
        "tp",
        "fp",
        "fn",
        "tn",
        zero_ratio(F.col("n_positive"), F.col("n")).alias("base_rate"),
        zero_ratio(tp, tp + fp).alias("precision"),
        zero_ratio(tp, tp + fn).alias("recall"),
        zero_ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def _known(df: DataFrame, columns: Sequence[str], classes: Sequence[object]) -> DataFrame:
    """``df``; a row whose value is null or none of ``classes`` stops the job instead of vanishing."""
    for c in columns:
        value = F.concat(F.lit(f"{c} is no given class: "), F.coalesce(F.col(c).cast("string"), F.lit("NULL")))
        known = F.coalesce(F.col(c).isin(*classes), F.lit(False))
        df = df.withColumn(c, F.when(known, F.col(c)).otherwise(F.raise_error(value)))
    return df


def confusion_matrix(
    df: DataFrame, label: str, predicted: str, classes: Sequence[object]
) -> DataFrame:
    """(actual, predicted, n) for every pair of the given classes, zeros included."""
    df = _known(df, [label, predicted], classes)
    cells = [
        F.struct(
            F.lit(a).alias("actual"),
            F.lit(p).alias("predicted"),
            F.count_if((F.col(label) == F.lit(a)) & (F.col(predicted) == F.lit(p))).alias("n"),
        )
        for a in classes
        for p in classes
    ]
    return df.agg(F.array(*cells).alias("__cells")).select(F.inline("__cells"))


def class_report(
    df: DataFrame, label: str, predicted: str, classes: Sequence[object]
) -> DataFrame:
    """Precision, recall, F1 and support per class, plus macro and weighted averages."""
    df = _known(df, [label, predicted], classes)
    rows = [
        F.struct(
            F.lit(str(c)).alias("class"),
            F.count_if((F.col(label) == F.lit(c)) & (F.col(predicted) == F.lit(c))).alias("tp"),
            F.count_if(F.col(predicted) == F.lit(c)).alias("n_predicted"),
            F.count_if(F.col(label) == F.lit(c)).alias("support"),
        )
        for c in classes
    ]
    scored = df.agg(F.array(*rows).alias("__rows")).select(F.inline("__rows")).select(
        "class",
        zero_ratio(F.col("tp"), F.col("n_predicted")).alias("precision"),
        zero_ratio(F.col("tp"), F.col("support")).alias("recall"),
        zero_ratio(2 * F.col("tp"), F.col("n_predicted") + F.col("support")).alias("f1"),
        "support",
    )
    measures = ["precision", "recall", "f1"]
    macro = scored.agg(
        F.lit("macro avg").alias("class"),
        *[F.avg(m).alias(m) for m in measures],
        F.sum("support").alias("support"),
    )
    weighted = scored.agg(
        F.lit("weighted avg").alias("class"),
        *[zero_ratio(F.sum(F.col(m) * F.col("support")), F.sum("support")).alias(m) for m in measures],
        F.sum("support").alias("support"),
    )
    return scored.unionByName(macro).unionByName(weighted)


def threshold_table(
    df: DataFrame, score: str, label: str, thresholds: Sequence[float]
) -> DataFrame:
    """Flagged share, precision, recall and hit counts for each threshold.

    Rows are counted once by their position on the grid; the cumulation from
    the top then runs over at most ``len(thresholds) + 1`` rows.
    """
    grid = sorted(float(t) for t in thresholds)
    positions = F.array(*[F.lit(i) for i in range(len(grid) + 1)])
    # One empty row per grid position keeps thresholds nobody reaches.
    counted = (
        df.groupBy(grid_position(F.col(score), grid).alias("position"))
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == 1).alias("tp"))
    )
    none = F.lit(0).cast("long")
    empty = df.sparkSession.range(1).select(
        F.explode(positions).alias("position"), none.alias("n"), none.alias("tp")
    )
    filled = (
        counted.unionByName(empty).groupBy("position").agg(F.sum("n").alias("n"), F.sum("tp").alias("tp"))
    )
    down = Window.orderBy(F.desc("position")).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    curve = filled.select(
        "position",
        F.sum("n").over(down).alias("n_flagged"),
        F.sum("tp").over(down).alias("true_positives"),
        F.sum("n").over(whole).alias("__n"),
        F.sum("tp").over(whole).alias("__positive"),
    ).filter(F.col("position") > 0)
    grid_value = F.element_at(F.array(*[F.lit(t) for t in grid]), F.col("position"))
    return curve.select(grid_value.alias("threshold"), *_flag_columns())


def _flag_columns() -> list[Column]:
    flagged, tp = F.col("n_flagged"), F.col("true_positives")
    return [
        percent(flagged, F.col("__n"), 2).alias("pct_flagged"),
        flagged.alias("n_flagged"),
        F.round(zero_ratio(tp, flagged), 4).alias("precision"),
        F.round(zero_ratio(tp, F.col("__positive")), 4).alias("recall"),
        tp.alias("true_positives"),
        (flagged - tp).alias("false_positives"),
    ]


def threshold_top_share(
    df: DataFrame, score: str, label: str, share: float
) -> DataFrame:
    """The score that flags the top ``share`` of rows, with the metrics at that score.

    ``df`` is counted once by score; quantile and metrics come from those counts.
    """
    counted = df.groupBy(F.col(score).alias("score")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == 1).alias("positive")
    )
    counted = materialised(counted)
    cut = exact_quantiles(counted, [], "score", {"cut": 1.0 - share}, few_groups=True, weight="n")
    hit = F.col("score") >= cut.scalar()

    def total(name: str, when: Column | None = None) -> Column:
        kept = F.col(name) if when is None else F.when(when, F.col(name))
        return F.coalesce(F.sum(kept), F.lit(0))

    return (
        counted.agg(
            total("n", hit).alias("n_flagged"),
            total("positive", hit).alias("true_positives"),
            total("n").alias("__n"),
            total("positive").alias("__positive"),
        )
        .select(F.round(cut.scalar(), 4).alias("threshold"), *_flag_columns())
    )


def threshold_min_precision(
    df: DataFrame, score: str, label: str, precision: float
) -> DataFrame:
    """Lowest threshold of the 0.01 grid that flags somebody and reaches ``precision``.

    Empty when no threshold does.
    """
    grid = [i / 100 for i in range(1, 100)]
    table = threshold_table(df, score, label, grid)
    exact = F.col("true_positives") / F.nullif(F.col("n_flagged"), F.lit(0))
    return table.filter(exact >= precision).orderBy("threshold").limit(1)
