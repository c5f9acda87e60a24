"""Data tests from stored states: a month is scanned once, when it comes.

Per month the states hold NULLs by column (additive), the distinct keys of unique columns
dealt into buckets by hash, and the keys without a parent. A new month, or one that comes
again, is scanned itself; its keys meet the keys of other months in the buckets they fall
into and nowhere else. The suite is then read off the states: the rows of the months
before are never read again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.sources.storage import path_exists

BUCKETS = 64
_KEYS = "column_name string, key string, n_rows long, bucket int, ym int"
_NULLS = "column_name string, n_null long, ym int"
_TWICE = "column_name string, n_failures long, bucket int"
_ORPHANS = "column_name string, parent string, key string, n_rows long, ym int"


@dataclass(frozen=True)
class SuiteStates:
    """The tests of one table, and the folder of their states.

    ``parents`` maps a column to the name that its parent's keys get in ``add`` and ``suite``.
    """

    spark: SparkSession
    folder: str
    table: str
    not_null: Sequence[str] = ()
    unique: Sequence[str] = ()
    parents: Mapping[str, str] | None = None

    def _read(self, name: str, schema: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def _write(self, df: DataFrame, name: str, *parts: str) -> None:
        """Replace the partitions that ``df`` has rows of; the others stay."""
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*parts).parquet(f"{self.folder}/{name}")

    def _each(self, columns: Sequence[str], *fields: Column) -> Column:
        return F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), *[f(c) for f in fields]) for c in columns]))

    def add(self, month: int, rows: DataFrame, parents: Mapping[str, DataFrame]) -> None:
        """Take in the rows of a month, in place of what was known of it.

        ``parents`` has a frame with one column, the keys, for each parent's name. One pass
        takes NULLs, one the distinct keys of the tested columns.
        """
        ym = F.lit(month).cast("int").alias("ym")
        nulls = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in self.not_null])
        self._write(nulls.select(self._each(self.not_null, lambda c: F.col(c).alias("n_null")), ym), "nulls", "ym")
        related = dict(self.parents or {})
        columns = list(dict.fromkeys([*self.unique, *related]))
        values = rows.select(self._each(columns, lambda c: F.col(c).cast("string").alias("key")))
        keys = values.where(F.col("key").isNotNull()).groupBy("column_name", "key").agg(F.count(F.lit(1)).alias("n_rows"))
        bucket = F.pmod(F.xxhash64("column_name", "key"), F.lit(BUCKETS)).cast("int")
        own = keys.where(F.col("column_name").isin(list(self.unique))).withColumns({"bucket": bucket, "ym": ym})
        # An empty row a bucket keeps every partition of the month there to be replaced.
        every = self.spark.range(BUCKETS).select(F.lit("").alias("column_name"), F.lit(None).cast("string").alias("key"), F.lit(0).cast("long").alias("n_rows"), F.col("id").cast("int").alias("bucket"), ym)
        before = {r["bucket"] for r in self._read("keys", _KEYS).where((F.col("ym") == month) & F.col("key").isNotNull()).select("bucket").distinct().collect()}
        self._write(own.unionByName(every), "keys", "ym", "bucket")
        now = self._read("keys", _KEYS)
        touched = before | {r["bucket"] for r in now.where((F.col("ym") == month) & F.col("key").isNotNull()).select("bucket").distinct().collect()}
        if touched:
            there = now.where(F.col("bucket").isin(sorted(touched)) & F.col("key").isNotNull())
            twice = there.groupBy("bucket", "column_name", "key").agg(F.sum("n_rows").alias("n")).where("n > 1")
            twice = twice.groupBy("column_name", "bucket").agg(F.count(F.lit(1)).alias("n_failures"))
            none = self.spark.createDataFrame([("", 0, b) for b in sorted(touched)], _TWICE)
            self._write(twice.select("column_name", "n_failures", "bucket").unionByName(none), "twice", "bucket")
        lost = [self._lost(keys.where(F.col("column_name") == c), c, name, parents[name]) for c, name in related.items()]
        none = self.spark.createDataFrame([("", "", None, 0)], "column_name string, parent string, key string, n_rows long")
        self._write(reduce(DataFrame.unionByName, lost, none).withColumn("ym", ym), "orphans", "ym")

    @staticmethod
    def _lost(keys: DataFrame, column: str, name: str, parent: DataFrame) -> DataFrame:
        known = parent.select(F.col(parent.columns[0]).cast("string").alias("__parent"))
        found = keys.join(known, F.col("key") == F.col("__parent"), "left_anti")
        return found.select(F.lit(column).alias("column_name"), F.lit(name).alias("parent"), "key", "n_rows")

    def suite(self, parents: Mapping[str, DataFrame]) -> DataFrame:
        """(table_name, column_name, test, n_failures) over all months taken in.

        Keys that had no parent when their month came are looked up again, in case the
        parent has grown since; others have one for good.
        """
        nulls = self._read("nulls", _NULLS).groupBy("column_name").agg(F.sum("n_null").alias("n_failures")).withColumn("test", F.lit("not_null"))
        twice = self._read("twice", _TWICE).groupBy("column_name").agg(F.sum("n_failures").alias("n_failures")).withColumn("test", F.lit("unique"))
        orphans = self._read("orphans", _ORPHANS).where("key is not null")
        lost = [
            self._lost(orphans.where(F.col("column_name") == c).groupBy("key").agg(F.sum("n_rows").alias("n_rows")), c, name, parents[name])
            .agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_failures")).withColumns({"column_name": F.lit(c), "test": F.lit("relationships")})
            for c, name in (self.parents or {}).items()
        ]
        columns = ["column_name", "test", "n_failures"]
        found = reduce(DataFrame.unionByName, [d.select(*columns) for d in (nulls, twice, *lost)])
        asked = [(c, "not_null") for c in self.not_null] + [(c, "unique") for c in self.unique] + [(c, "relationships") for c in self.parents or {}]
        wanted = self.spark.createDataFrame(asked, "column_name string, test string")
        return wanted.join(found, ["column_name", "test"], "left").select(
            F.lit(self.table).alias("table_name"), "column_name", "test", F.coalesce("n_failures", F.lit(0)).cast("long").alias("n_failures")
        )
