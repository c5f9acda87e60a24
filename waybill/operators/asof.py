"""Strict backward as-of counts: what was known before each point in time.

Equivalent to a backward as-of join without exact matches onto cumulative
history, but expressed as an aggregation per instant and running totals, so one
very large key is spread over its hours.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.functions.dates import MICROS_PER_HOUR, micros
from waybill.operators.running import running_totals


def hour_of(ts: Column) -> Column:
    """Hours since the epoch: about 8,800 running-total buckets per year and key."""
    return F.floor(micros(ts) / MICROS_PER_HOUR)


def span_of(ts: Column) -> Column:
    """Spans of 30 days since the epoch: some twelve running-total buckets per year and key.

    For histories by key. Hours of a key mostly hold one row each, so totals per hour would
    be as many as the rows.
    """
    return F.floor(micros(ts) / (MICROS_PER_HOUR * 24 * 30))


def cumulative_history(
    history: DataFrame,
    keys: Sequence[str],
    time: str,
    measures: Mapping[str, Column],
) -> DataFrame:
    """Running totals up to and including each instant, one row per (keys, instant)."""
    reduced = history.groupBy(*keys, time).agg(
        *[F.sum(c).alias(n) for n, c in measures.items()]
    )
    return running_totals(reduced, keys, time, list(measures), hour_of(F.col(time)))


def known_before(
    rows: DataFrame,
    keys: Sequence[str],
    history_time: str,
    target_time: str,
    measures: Mapping[str, Column],
    last_seen: str = "last_seen",
) -> DataFrame:
    """What could be known at every instant: one row per (keys, instant).

    Each row of ``rows`` is history once its ``history_time`` has passed and
    asks a question at its ``target_time``. The result has all these instants
    under the name ``target_time``, the totals of ``measures`` over all history of
    the same keys strictly before it (0 when there is none), and the time of
    the latest history used (NULL when there is none).
    """
    names = list(measures)
    as_history = F.struct(
        F.col(history_time).alias("__at"),
        F.col(history_time).alias(last_seen),
        *[c.cast("long").alias(n) for n, c in measures.items()],
    )
    as_target = F.struct(
        F.col(target_time).alias("__at"),
        F.lit(None).cast(rows.schema[history_time].dataType).alias(last_seen),
        *[F.lit(0).cast("long").alias(n) for n in names],
    )
    instants = (
        rows.select(*keys, F.inline(F.array(as_history, as_target)))
        .filter(F.col("__at").isNotNull())
        .groupBy(*keys, "__at")
        .agg(
            F.max(last_seen).alias(last_seen),
            *[F.sum(n).alias(n) for n in names],
        )
    )
    known = running_totals(
        instants, keys, "__at", names, hour_of(F.col("__at")), maxima=[last_seen], exclusive=True
    )
    return known.withColumnRenamed("__at", target_time)


def attach_known(rows: DataFrame, known: DataFrame, keys: Sequence[str], target_time: str) -> DataFrame:
    """Add the result of ``known_before`` to the rows that asked.

    Rows without a key or time know nothing: counts 0, no latest history.
    """
    asked = [*keys, target_time]
    counts = [c for c, kind in known.dtypes if c not in asked and kind == "bigint"]
    joined = rows.join(known, asked, "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in counts})


def with_known(
    rows: DataFrame,
    keys: Sequence[str],
    history_time: str,
    target_time: str,
    measures: Mapping[str, Column],
    last_seen: str = "last_seen",
) -> DataFrame:
    """Every row with what was known before its ``target_time``: ``known_before`` attached, without a join.

    A row travels as a piece of history and as a question that takes its columns along, so
    rows are shuffled twice in one exchange and none is looked up again. Questions come
    before the history of their own instant. Rows without a key or time know nothing.
    ``rows`` are read twice, by the totals per bucket too: best a written table.
    """
    keys, names = list(keys), list(measures)
    kept = [c for c in rows.columns if c not in (*keys, target_time)]
    asks, known_at, bought = F.col("__asks"), F.col(history_time), F.col(target_time)
    is_history = known_at.isNotNull()
    for key in keys:
        is_history = is_history & F.col(key).isNotNull()
    both = rows.withColumn("__asks", F.explode(F.array(F.lit(True), F.lit(False)))).filter(asks | is_history)
    at = F.when(asks, bought).otherwise(known_at)
    instants = both.select(
        *keys,
        at.alias("__at"),
        (~asks).alias("__tells"),
        *[F.when(asks, F.col(c)).alias(c) for c in kept],
        *[F.when(asks, 0).otherwise(c.cast("long")).alias(f"__{n}") for n, c in measures.items()],
        F.when(~asks, known_at).alias("__last"),
    )
    bucket = span_of(F.col("__at")) if keys else hour_of(F.col("__at"))
    known = running_totals(
        instants, keys, ["__at", "__tells"], [f"__{n}" for n in names], bucket, maxima=["__last"], exclusive=True
    )
    return known.filter(~F.col("__tells")).select(
        *keys,
        F.col("__at").alias(target_time),
        *kept,
        *[F.coalesce(F.col(f"__{n}"), F.lit(0)).alias(n) for n in names],
        F.col("__last").alias(last_seen),
    )


def leakage_violations(
    df: DataFrame, checks: Mapping[str, tuple[str, str]]
) -> DataFrame:
    """Per check, rows matched to history and rows whose history is not strictly earlier."""
    columns = []
    for name, (last_seen, at) in checks.items():
        columns += [
            F.count(last_seen).alias(f"{name}_matched"),
            F.count_if(F.col(last_seen) >= F.col(at)).alias(f"{name}_violations"),
        ]
    return df.agg(*columns)
