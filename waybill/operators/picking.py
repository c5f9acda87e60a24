"""Choose one or a few rows per key.

Every operator here cuts each partition down to a few candidates per key
before anything is shuffled (map-side aggregation or Spark's per-group limit),
so a key with a third of all rows costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest_first(ts: Column) -> list[Column]:
    """Sort terms for "most recent first, unknown dates last"."""
    return [ts.desc_nulls_last()]


def best_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key under ``order``."""
    return first_rows(df, keys, order, 1, "__row").drop("__row")


def first_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, name: str
) -> DataFrame:
    """The first ``n`` rows of every key, numbered in column ``name``.

    Spark limits every partition to ``n`` rows per key before the shuffle.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(name, place).filter(F.col(name) <= n)


def dominant_category(df: DataFrame, key: str, category: str, amount: str, name: str) -> DataFrame:
    """The category with the largest summed amount per key, ties alphabetical."""
    # Rounded: the last bits of a sum of doubles depend on the order of addition.
    summed = df.groupBy(key, category).agg(F.round(F.sum(amount), 6).alias("__amount"))
    strongest = F.min(F.struct((-F.col("__amount")).alias("less"), F.col(category).alias("pick")))
    return summed.groupBy(key).agg(strongest["pick"].alias(name))


def first_child(
    df: DataFrame, key: str, position: str, value: str, name: str, first: int = 1
) -> DataFrame:
    """``value`` of the child row numbered ``first``, one row per key.

    Where a number is repeated, the smallest value in text order is taken, so that
    the choice doesn't depend on the type a source gives its keys.
    """
    smallest = F.min(F.struct(F.col(value).cast("string").alias("text"), F.col(value).alias("pick")))
    return df.filter(F.col(position) == first).groupBy(key).agg(smallest["pick"].alias(name))


def top_entries(
    names: Sequence[str], values: Sequence[Column], top: int
) -> Column:
    """Array of (name, value) of the ``top`` largest absolute values of one row.

    Ties keep the given order. Works inside the row: nothing is shuffled.
    """
    entries = F.array(
        *[
            F.struct(
                (-F.abs(v)).alias("less"),
                F.lit(i).alias("position"),
                F.lit(n).alias("name"),
                v.alias("value"),
            )
            for i, (n, v) in enumerate(zip(names, values))
        ]
    )
    return F.slice(F.sort_array(entries), 1, top)


def stable_sample(df: DataFrame, keys: Sequence[str], n: int, seed: int) -> DataFrame:
    """``n`` rows in an order that depends only on the keys and the seed."""
    return df.orderBy(seeded_draw(keys, seed), *keys).limit(n)


def seeded_draw(keys: Sequence[str], seed: int) -> Column:
    """A number below 2**52 from the MD5 of seed and keys: the same in any engine."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), *[F.col(k).cast("string") for k in keys]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")


def first_examples(
    df: DataFrame, group: str, order: str, text: str, n: int, length: int
) -> DataFrame:
    """The first ``n`` texts of every group, cut to ``length`` characters for display."""
    numbered = first_rows(df, [group], [F.col(order)], n, "example_no")
    return numbered.select(
        group, "example_no", order, F.substring(text, 1, length).alias("example")
    )
