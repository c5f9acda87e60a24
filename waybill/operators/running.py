"""Running totals over data of any size, without one big window.

A plain ``sum() over (partition by key order by time)`` sends a whole key to
one task, and without a key it sends the whole table there. Here the input
holds one row per (key, position); positions are cut into ordered buckets;
bucket totals give the offset before each bucket, and a window inside the
bucket does the rest. No task ever sees more than one bucket of one key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: str | Sequence[str],
    sums: Sequence[str],
    bucket: Column,
    maxima: Sequence[str] = (),
    exclusive: bool = False,
) -> DataFrame:
    """Replace ``sums`` and ``maxima`` by their running values within ``keys``.

    ``df`` must hold one row per (keys, order), best fresh from an aggregation:
    its shuffle is then shared by the two branches below. ``bucket`` is an
    expression of ``order`` that never decreases with it; the number of its
    values per key should be bounded (hours of the covered years, steps of a
    score), because bucket totals of one key are ordered in one task. With
    ``exclusive`` the current row is left out, which is what a strict "before"
    needs; running sums then start at 0 and running maxima at NULL. Rows with a
    NULL key belong to no group and get NULL totals. ``order`` may be several columns.
    """
    keys, sums, maxima = list(keys), list(sums), list(maxima)
    order = [order] if isinstance(order, str) else list(order)
    place = [*keys, "__step"]
    measures = sums + maxima
    kept = [c for c in df.columns if c not in measures]
    rows = df.withColumn("__step", bucket)

    last = -1 if exclusive else Window.currentRow
    inside = (
        Window.partitionBy(*place).orderBy(*order).rowsBetween(Window.unboundedPreceding, last)
    )
    within = rows.select(
        *kept,
        "__step",
        *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(c) for c in sums],
        *[F.max(c).over(inside).alias(c) for c in maxima],
    )

    totals = rows.groupBy(*place).agg(
        *[F.sum(c).alias(c) for c in sums], *[F.max(c).alias(c) for c in maxima]
    )
    earlier = (
        Window.partitionBy(*keys).orderBy("__step").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = totals.select(
        *place,
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(c) for c in sums],
        *[F.max(c).over(earlier).alias(c) for c in maxima],
    )
    joined = within.alias("now").join(offsets.alias("before"), place, "left")
    return joined.select(
        *[F.col(f"now.{c}") if c not in place else F.col(c) for c in kept],
        *[(F.col(f"now.{c}") + F.col(f"before.{c}")).alias(c) for c in sums],
        *[F.greatest(F.col(f"now.{c}"), F.col(f"before.{c}")).alias(c) for c in maxima],
    )
