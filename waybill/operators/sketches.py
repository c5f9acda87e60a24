"""Mergeable summaries of numeric columns: quantile and distinct-count sketches by group.

A table of sketches is built once per group (a month, a state); any union of groups is
summarised by merging their sketches, without the rows. Ranks are right to within
``RANK_ERROR`` of the rows, distinct counts to about ``DISTINCT_ERROR`` of themselves;
counts, means, deviations, least and greatest are exact. Exact forms stay the default.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sizes of the sketches, and the errors that they keep with 99 % certainty.
QUANTILE_SIZE = 800
DISTINCT_BITS = 14
RANK_ERROR = 0.005
DISTINCT_ERROR = 0.025


def sketch_table(rows: DataFrame, keys: Sequence[str], columns: Mapping[str, Column]) -> DataFrame:
    """(keys, feature, n_rows, n, total, squares, least, greatest, quantiles, distinct): a row per group and column.

    One pass; sketches are built where the rows are and merged after the shuffle. NULLs
    count as rows only.
    """
    names = list(columns)
    wide = rows.select(*keys, *[c.cast("double").alias(f"__{k}") for k, c in enumerate(columns.values())])

    def parts(k: int) -> Column:
        v = F.col(f"__{k}")
        return F.struct(
            F.lit(names[k]).alias("feature"),
            F.count(F.lit(1)).alias("n_rows"),
            F.count(v).alias("n"),
            F.sum(v).alias("total"),
            F.sum(v * v).alias("squares"),
            F.min(v).alias("least"),
            F.max(v).alias("greatest"),
            F.kll_sketch_agg_double(v, F.lit(QUANTILE_SIZE)).alias("quantiles"),
            F.hll_sketch_agg(F.xxhash64(v), F.lit(DISTINCT_BITS)).alias("distinct"),
        )

    packed = wide.groupBy(*keys).agg(F.array(*[parts(k) for k in range(len(names))]).alias("__parts"))
    return packed.select(*keys, F.inline("__parts"))


def merged(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of the union of groups, per feature and ``by`` columns."""
    total = lambda c: F.sum(c).alias(c)
    return sketches.where("n > 0").groupBy(*by, "feature").agg(
        total("n_rows"), total("n"), total("total"), total("squares"), F.min("least").alias("least"), F.max("greatest").alias("greatest"),
        F.kll_merge_agg_double("quantiles", F.lit(QUANTILE_SIZE)).alias("quantiles"),
        F.hll_union_agg("distinct").alias("distinct"),
    )


def quantile(p: float) -> Column:
    return F.kll_sketch_get_quantile_double("quantiles", F.lit(float(p)))


def describe(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, feature, count, mean, std, min, 25%, 50%, 75%, max), quartiles by sketch."""
    mean = F.col("total") / F.col("n")
    spread = F.greatest(F.col("squares") - F.col("n") * mean * mean, F.lit(0.0)) / F.nullif(F.col("n") - 1, F.lit(0))
    return merged(sketches, by).select(
        *by, "feature", F.col("n").alias("count"), mean.alias("mean"), F.sqrt(spread).alias("std"), F.col("least").alias("min"),
        *[quantile(p).alias(f"{int(100 * p)}%") for p in (0.25, 0.5, 0.75)], F.col("greatest").alias("max"),
    )


def boxes(sketches: DataFrame, by: Sequence[str] = (), reach: float = 1.5) -> DataFrame:
    """(by, feature, q1, median, q3, fence_low, fence_high): fences are ``reach`` quartile ranges away, inside the values."""
    q1, q3 = quantile(0.25), quantile(0.75)
    return merged(sketches, by).select(
        *by, "feature", q1.alias("q1"), quantile(0.5).alias("median"), q3.alias("q3"),
        F.greatest(F.col("least"), q1 - reach * (q3 - q1)).alias("fence_low"),
        F.least(F.col("greatest"), q3 + reach * (q3 - q1)).alias("fence_high"),
    )


def distinct_share(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, feature, n_distinct, n_rows, pct_distinct), distinct values by sketch."""
    n = F.hll_sketch_estimate("distinct")
    return merged(sketches, by).select(
        *by, "feature", n.alias("n_distinct"), "n_rows", (100.0 * n / F.nullif(F.col("n_rows"), F.lit(0))).alias("pct_distinct")
    )
