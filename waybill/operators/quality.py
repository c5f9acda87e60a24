"""Data tests and run-time guards as DataFrame operations."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their count."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter(F.col("n_rows") > 1)
    )


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose non-null key has no parent."""
    keys = parent.select(F.col(parent_column).alias("__parent"))
    return child.filter(F.col(column).isNotNull()).join(
        keys, F.col(column) == F.col("__parent"), "left_anti"
    )


def _result(df: DataFrame, table: str, column: str, tests: Mapping[str, object]) -> DataFrame:
    pairs = [
        F.struct(F.lit(test).alias("test"), F.coalesce(failures, F.lit(0)).cast("long").alias("n_failures"))
        for test, failures in tests.items()
    ]
    return df.agg(F.array(*pairs).alias("__tests")).select(
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        F.inline("__tests"),
    )


def key_tests(df: DataFrame, table: str, column: str, tests: Sequence[str]) -> DataFrame:
    """``unique`` and ``not_null`` of one column from a single aggregation."""
    if list(tests) == ["not_null"]:
        return _result(df, table, column, {"not_null": F.count_if(F.col(column).isNull())})
    counted = df.groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    known = {
        "unique": F.count_if(F.col(column).isNotNull() & (F.col("n_rows") > 1)),
        "not_null": F.sum(F.when(F.col(column).isNull(), F.col("n_rows"))),
    }
    return _result(counted, table, column, {t: known[t] for t in tests})


def relationship_test(
    child: DataFrame, table: str, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    # Reducing to distinct keys first keeps a key with many rows from piling up.
    keys = child.groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    missing = orphans(keys, column, parent, parent_column)
    return _result(missing, table, column, {"relationships": F.sum("n_rows")})


def test_suite(
    tables: Mapping[str, DataFrame],
    key_columns: Iterable[tuple[str, str, Sequence[str]]],
    relationships: Iterable[tuple[str, str, str, str]],
) -> DataFrame:
    """All declared tests as one table (table_name, column_name, test, n_failures)."""
    parts = [key_tests(tables[t], t, c, tests) for t, c, tests in key_columns]
    parts += [
        relationship_test(tables[t], t, c, tables[p], pc) for t, c, p, pc in relationships
    ]
    return reduce(DataFrame.unionByName, parts)


def grain_report(base: DataFrame, key: str, blocks: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and distinct keys per block. A block joins without fan-out when they agree.

    Replaces recounting the result after every join: unique right-hand keys
    prove the same thing once.
    """
    def profile(name: str, df: DataFrame) -> DataFrame:
        per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
        return per_key.agg(
            F.coalesce(F.sum("__n"), F.lit(0)).cast("long").alias("n_rows"),
            F.count(key).alias("n_keys"),
            F.coalesce(F.max("__n"), F.lit(0)).cast("long").alias("max_rows_per_key"),
        ).withColumn("block", F.lit(name))

    parts = [profile("base", base)] + [profile(n, d) for n, d in blocks.items()]
    return reduce(DataFrame.unionByName, parts)


def assert_single_grain(report: DataFrame) -> None:
    """Fail when any block of a ``grain_report`` has more than one row per key."""
    bad = report.filter((F.col("max_rows_per_key") > 1) | (F.col("n_rows") != F.col("n_keys")))
    names = [r["block"] for r in bad.select("block").collect()]
    if names:
        raise AssertionError(f"join would fan out, keys not unique in: {sorted(names)}")


def assert_no_forbidden(
    columns: Iterable[str], forbidden: Iterable[str], anywhere_in_name: bool = False
) -> None:
    """Fail when a leaked column is among ``columns``; looks at names only, runs no job."""
    names, banned = list(columns), list(forbidden)
    if anywhere_in_name:
        leaked = [n for n in names if any(b in n for b in banned)]
    else:
        leaked = [n for n in names if n in banned]
    if leaked:
        raise AssertionError(f"forbidden columns present: {leaked}")


def key_set_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row: keys only on the left, only on the right. Both 0 means equal sets."""
    both = (
        left.select(key, F.lit(1).alias("__l"), F.lit(0).alias("__r"))
        .unionByName(right.select(key, F.lit(0).alias("__l"), F.lit(1).alias("__r")))
        .groupBy(key)
        .agg(F.max("__l").alias("__l"), F.max("__r").alias("__r"))
    )
    return both.agg(
        F.count_if((F.col("__l") == 1) & (F.col("__r") == 0)).alias("only_left"),
        F.count_if((F.col("__l") == 0) & (F.col("__r") == 1)).alias("only_right"),
    )
