"""Persisted tables: replace, export and snapshot views."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Mapping

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, where = _file_system(spark, path)
    return fs.exists(where)


#: A table's folder holds a folder a version and this file, which names the version that counts.
POINTER = "_current"


def _version(spark: SparkSession, path: str) -> str | None:
    """The version that the pointer names; none where a folder holds plain files, or nothing."""
    fs, pointer = _file_system(spark, f"{path.rstrip('/')}/{POINTER}")
    if not fs.exists(pointer):
        return None
    stream = fs.open(pointer)
    try:
        return bytes(stream.readAllBytes()).decode().strip()
    finally:
        stream.close()


def current_path(spark: SparkSession, path: str) -> str:
    """The folder whose files are the table at ``path`` just now."""
    version = _version(spark, path)
    return f"{path.rstrip('/')}/{version}" if version else path


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """What ``replace_table`` wrote at ``path``, or the Parquet files that lie there.

    A bucketed version is opened as a table of the session's catalog, so that joins on its
    key know how its rows are dealt out.
    """
    return _opened(spark, current_path(spark, path))


_BUCKETED = re.compile(r"v-([0-9a-f]{32})-(\d+)-(\w+)$")


def _opened(spark: SparkSession, folder: str) -> DataFrame:
    if not (found := _BUCKETED.search(folder)):
        return spark.read.parquet(folder)
    name, (_, buckets, key) = f"waybill_{found[1]}", found.groups()
    if not spark.catalog.tableExists(name):
        columns = spark.read.parquet(folder)._jdf.schema().toDDL()
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`)"
            f" INTO {buckets} BUCKETS LOCATION '{folder}'"
        )
    return spark.table(name)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of the current version."""
    fs, where = _file_system(spark, current_path(spark, path))
    try:
        return fs.getContentSummary(where).getLength()
    except Py4JJavaError as error:
        raise FileNotFoundError(path) from error


def _point_to(spark: SparkSession, path: str, version: str) -> None:
    """Make ``version`` the one that counts, by renaming a new pointer over the old one."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    fs, new = _file_system(spark, f"{path}/{POINTER}-{version}")
    stream = fs.create(new, True)
    stream.write(version.encode())
    stream.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri(), conf)
    files.rename(new, jvm.org.apache.hadoop.fs.Path(f"{path}/{POINTER}"), options)


def _drop_others(spark: SparkSession, path: str, keep: set[str]) -> None:
    fs, where = _file_system(spark, path)
    for entry in fs.listStatus(where):
        if entry.getPath().getName() not in keep:
            fs.delete(entry.getPath(), True)


def replace_table(
    df: DataFrame,
    path: str,
    partition_by: Iterable[str] = (),
    compression: str = "zstd",
    bucket_by: str | None = None,
    buckets: int = 0,
) -> DataFrame:
    """Write ``df`` in place of whatever was at ``path`` and read it back.

    The new version is written beside the old one and counts from the moment a small
    pointer file is renamed: readers see either table whole, a write that dies half-way
    leaves the old one, and ``df`` may read from ``path`` itself. The version before stays
    for those who are reading it, older ones and the rests of failed writes go. One writer
    at a time; where a store can't rename a file at once, replacement is as atomic as that.

    With ``bucket_by`` rows are dealt into ``buckets`` files by that column and sorted by
    it: tables of one key and number of buckets are joined on it without a shuffle.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    before, version = _version(spark, path), f"v-{uuid.uuid4().hex}"
    if bucket_by:
        version = f"{version}-{buckets}-{bucket_by}"
    # A table without a pointer is the plain files of its folder: they are the version before.
    fs, where = _file_system(spark, path)
    old = {before} if before else {e.getPath().getName() for e in fs.listStatus(where)} if fs.exists(where) else set()
    old = {n for n in old if before or not n.startswith(("v-", POINTER))}
    writer = df.write.option("compression", compression)
    if partition_by := list(partition_by):
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        # Dealt out as the buckets are, each task writes one of them.
        writer = df.repartition(buckets, bucket_by).write.option("compression", compression).format("parquet")
        name = f"waybill_{version[2:34]}"
        writer.bucketBy(buckets, bucket_by).sortBy(bucket_by).option("path", f"{path}/{version}").saveAsTable(name)
    else:
        writer.parquet(f"{path}/{version}")
    _point_to(spark, path, version)
    _drop_others(spark, path, {version, POINTER, *old})
    return _opened(spark, f"{path}/{version}")


def save_table(df: DataFrame, name: str) -> DataFrame:
    """``replace_table`` for a catalog table (``layer.table``)."""
    if "." in name:
        df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {name.rsplit('.', 1)[0]}")
    df.write.mode("overwrite").format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def export_tables(tables: Mapping[str, DataFrame], folder: str) -> None:
    for name, df in tables.items():
        replace_table(df, f"{folder.rstrip('/')}/{name}.parquet")


def export_sizes(spark: SparkSession, folder: str, names: Iterable[str]) -> dict[str, int]:
    return {n: stored_bytes(spark, f"{folder.rstrip('/')}/{n}.parquet") for n in names}


def assert_export_size(sizes: Mapping[str, int], limit_bytes: int) -> None:
    total = sum(sizes.values())
    if total > limit_bytes:
        raise AssertionError(f"export is {total} bytes, more than the limit of {limit_bytes}")


def manifest(spark: SparkSession, folder: str, names: Iterable[str], exported_at: str) -> DataFrame:
    """(table_name, n_rows, size_bytes, exported_at) of an export folder."""
    names = list(names)
    sizes = export_sizes(spark, folder, names)
    parts = [
        read_table(spark, f"{folder.rstrip('/')}/{n}.parquet")
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select(
            F.lit(n).alias("table_name"),
            "n_rows",
            F.lit(sizes[n]).alias("size_bytes"),
            F.lit(exported_at).cast("timestamp").alias("exported_at"),
        )
        for n in names
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def read_snapshot(
    spark: SparkSession, folder: str, name: str, optional: bool = False
) -> DataFrame | None:
    path = f"{folder.rstrip('/')}/{name}.parquet"
    try:
        return read_table(spark, path)
    except AnalysisException:
        if optional:
            return None
        raise


#: Tables of a row an order. Their files are many times smaller than their rows, so by their
#: size alone Spark would take them for broadcasts, which the driver has to hold whole.
ORDER_GRAIN = {"int_orders_enriched", "order_risk_scores", "order_risk_drivers", "review_insights"}


def register_snapshots(
    spark: SparkSession, folder: str, names: Iterable[str], optional: Iterable[str] = ("review_insights",)
) -> list[str]:
    """Temporary views over exported tables, under the tables' own names.

    Exported drivers hold rank 1 only, without the rank column; the view adds
    it back so queries work on either form. Missing optional tables are left out. Views of a
    row an order are joined by sorting, never sent to all executors; the fact, which is joined
    to small dimensions as well, takes that from them.
    """
    optional, registered = set(optional), []
    for name in names:
        df = read_snapshot(spark, folder, name, optional=name in optional)
        if df is None:
            continue
        if name == "order_risk_drivers" and "driver_rank" not in df.columns:
            df = df.withColumn("driver_rank", F.lit(1))
        if name in ORDER_GRAIN:
            df = df.hint("merge")
        df.createOrReplaceTempView(name)
        registered.append(name)
    return registered
