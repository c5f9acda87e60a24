"""Registration of queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.catalog.sql import check_sql
from waybill.plans.warehouse import Warehouse
from waybill.sources.driver_tables import DriverTables

Build = Callable[[Warehouse], DataFrame]


@dataclass(frozen=True)
class Entry:
    build: Build
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    """Register ``build(warehouse)`` under ``name``, with its check when SQL can express it."""

    def register(build: Build) -> Build:
        if name in ENTRIES:
            raise ValueError(f"query {name} is registered twice")
        ENTRIES[name] = Entry(build, check_sql(sql) if sql else None)
        return build

    return register


_OPEN: dict[tuple[str, str], Warehouse] = {}


def open_warehouse(spark: SparkSession, folder: str) -> Warehouse:
    """The warehouse over one folder, opened once per session.

    Only definitions are kept: table schemas and unexecuted plans, no data.
    """
    place = (spark.sparkContext.applicationId, folder)
    if place not in _OPEN:
        _OPEN.clear()
        _OPEN[place] = Warehouse(DriverTables(spark, folder))
    return _OPEN[place]


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round for comparison: sums of doubles depend on the order of addition."""
    return df.withColumns({c: F.round(c, digits) for c in columns})
