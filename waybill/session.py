"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Folders that ``materialised`` has written, by application.
_WRITTEN: dict[str, list[str]] = {}


def build_session(
    app: str = "waybill",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the settings every plan in this package assumes.

    ``shuffle_partitions`` is only an upper bound: adaptive execution merges
    small shuffle partitions and splits skewed ones. On a cluster leave it
    unset and size it with ``spark.sql.shuffle.partitions`` at submit time.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
        "spark.ui.enabled": "false",
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(extra or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: ``spark.checkpoint.dir``, else the SQL warehouse.

    Both are paths that Spark itself resolves. Where neither was chosen, the warehouse is a
    folder of the driver's machine: right for a local master, and an error on a cluster.
    """
    if chosen := spark.conf.get("spark.checkpoint.dir", None):
        return chosen
    folder, master = spark.conf.get("spark.sql.warehouse.dir"), spark.sparkContext.master
    if not re.match(r"local(\[|$)", master) and re.match(r"(file:|/)", folder):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {master} share; {folder} is one machine's")
    return folder


def observed(df: DataFrame, **figures: Column) -> tuple[DataFrame, dict]:
    """``materialised``, and aggregates of the rows taken while they are written.

    Each task adds up its own rows, so the figures cost no pass and no shuffle. Figures are
    sums and the like; Spark allows no distinct counts here.
    """
    seen = Observation()
    table = materialised(df.observe(seen, *[c.alias(n) for n, c in figures.items()]))
    return table, seen.get


def key_sums(column: str, only: Column | None = None) -> dict[str, Column]:
    """Aggregates that tell sets of keys apart: rows, and two sums of 64-bit hashes, exact.

    Equal figures of two tables mean the same keys, each as often; that two different sets
    agree in all three is as likely as two 128-bit hashes to be equal.
    """
    key = F.col(column) if only is None else F.when(only, F.col(column))
    counted = F.lit(True) if only is None else F.coalesce(only, F.lit(False))
    hashed = lambda seed: F.coalesce(F.sum(F.when(key.isNotNull(), F.xxhash64(key, F.lit(seed)).cast("decimal(20)"))), F.lit(0))
    return {"rows": F.count_if(counted), "keys_1": hashed(1).cast("decimal(38)"), "keys_2": hashed(2).cast("decimal(38)")}


def materialised(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    Cuts lineage so that later passes neither recompute ``df`` nor depend on the
    executors that made it, and, being columnar, lets each pass read only the
    columns it needs.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}.parquet"
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    df.write.parquet(path)
    return spark.read.parquet(path)


def release(spark: SparkSession, keep: int = 0) -> None:
    """Delete the tables that this application has written, but for the first ``keep``."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    written = _WRITTEN.get(spark.sparkContext.applicationId, [])
    while len(written) > keep:
        place = jvm.org.apache.hadoop.fs.Path(written.pop())
        place.getFileSystem(conf).delete(place, True)


@contextmanager
def written_tables(spark: SparkSession) -> Iterator[None]:
    """Owns what is written inside: gone at the end, so results must have been stored or read by then."""
    before = len(_WRITTEN.get(spark.sparkContext.applicationId, []))
    try:
        yield
    finally:
        release(spark, before)
