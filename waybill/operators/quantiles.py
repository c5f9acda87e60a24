"""Exact, linearly interpolated quantiles without collecting a group.

Pass 1 counts values per magnitude bucket; map-side aggregation keeps that
shuffle tiny. The buckets that hold the wanted ranks are then looked up, and
only their values go through an exact ranking. The table itself is never
sorted or shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waybill.functions.numbers import ordered_bucket
from waybill.operators.running import running_totals

COARSE_BITS = 8
FINE_BITS = 24


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    wanted: Mapping[str, float],
    few_groups: bool = False,
    weight: str | None = None,
) -> DataFrame:
    """One row per ``keys`` with a column per entry of ``wanted`` (name -> probability).

    NULL values and rows with a NULL key are ignored. ``few_groups`` declares that ``keys`` takes only a
    fixed handful of values (classes, feature names), so the list of selected
    buckets, two per group and probability, may be broadcast. ``weight`` names a column that
    says how many times a row counts.
    """
    keys = list(keys)
    times = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    values = df.select(*keys, F.col(value).cast("double").alias("__value"), times.alias("__times")).dropna()
    bucketed = values.withColumn("__bucket", ordered_bucket(F.col("__value"), COARSE_BITS))
    histogram = bucketed.groupBy(*keys, "__bucket").agg(F.sum("__times").alias("__n"))

    group = Window.partitionBy(*keys)
    earlier = group.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    placed = histogram.select(
        *keys,
        "__bucket",
        "__n",
        F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"),
        F.sum("__n").over(group).alias("__total"),
    )
    ranks = F.array(
        *[
            F.struct(
                F.lit(name).alias("name"),
                side((F.col("__total") - 1) * F.lit(float(p))).cast("long").alias("rank"),
                F.lit(upper).alias("upper"),
                ((F.col("__total") - 1) * F.lit(float(p))).alias("position"),
            )
            for name, p in wanted.items()
            for upper, side in ((False, F.floor), (True, F.ceil))
        ]
    )
    picks = (
        placed.withColumn("__pick", F.explode(ranks))
        .filter(
            (F.col("__pick.rank") >= F.col("__before"))
            & (F.col("__pick.rank") < F.col("__before") + F.col("__n"))
        )
        .select(*keys, "__bucket", "__before", "__pick.*")
    )
    chosen = picks.select(*keys, "__bucket").distinct()
    picks = F.broadcast(picks) if few_groups else picks
    chosen = F.broadcast(chosen) if few_groups else chosen

    place = keys + ["__bucket"]
    counts = (
        bucketed.join(chosen, place, "left_semi")
        .groupBy(*place, "__value")
        .agg(F.sum("__times").alias("__n"))
        .withColumn("__same", F.col("__n"))
    )
    ranked = running_totals(
        counts,
        place,
        "__value",
        ["__n"],
        ordered_bucket(F.col("__value"), FINE_BITS),
        exclusive=True,
    )
    rank_here = F.col("picks.rank") - F.col("picks.__before")
    found = (
        ranked.alias("ranked")
        .join(picks.alias("picks"), place)
        .filter(
            (rank_here >= F.col("ranked.__n"))
            & (rank_here < F.col("ranked.__n") + F.col("ranked.__same"))
        )
        .select(
            *keys,
            F.col("picks.name").alias("__name"),
            F.col("picks.upper").alias("__upper"),
            F.col("picks.position").alias("__position"),
            F.col("ranked.__value").alias("__value"),
        )
    )
    columns = []
    for name in wanted:
        here = F.col("__name") == name
        low = F.max(F.when(here & ~F.col("__upper"), F.col("__value")))
        high = F.max(F.when(here & F.col("__upper"), F.col("__value")))
        share = F.max(F.when(here, F.col("__position") - F.floor(F.col("__position"))))
        columns.append((low + (high - low) * share).alias(name))
    return found.groupBy(*keys).agg(*columns)
