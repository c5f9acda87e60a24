"""All layers over one set of raw tables, wired together once and kept lazy."""

from __future__ import annotations

from collections.abc import Mapping
from copy import copy
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.plans import order_grain as grain
from waybill.plans import staging, star
from waybill.plans.cells import order_cells
from waybill.plans.reports import bi_base
from waybill.session import materialised
from waybill.sources.storage import read_table, replace_table


class Warehouse:
    """``raw`` offers the nine raw tables as attributes (see ``DriverTables``).

    Nothing runs until an action; columns nobody asks for are never read.
    ``calendar`` defaults to the full years the orders touch.
    """

    def __init__(self, raw, calendar: DataFrame | None = None):
        self.raw = raw
        self._calendar = calendar
        self._order_rows: dict[tuple[str, ...], DataFrame] = {}

    @cached_property
    def stg_orders(self) -> DataFrame:
        return staging.stg_orders(self.raw.orders)

    @cached_property
    def stg_order_items(self) -> DataFrame:
        return staging.stg_order_items(self.raw.order_items)

    @cached_property
    def stg_order_payments(self) -> DataFrame:
        return staging.stg_order_payments(self.raw.order_payments)

    @cached_property
    def stg_order_reviews(self) -> DataFrame:
        return staging.stg_order_reviews(self.raw.order_reviews)

    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.stg_customers(self.raw.customers)

    @cached_property
    def stg_sellers(self) -> DataFrame:
        return staging.stg_sellers(self.raw.sellers)

    @cached_property
    def stg_products(self) -> DataFrame:
        return staging.stg_products(self.raw.products, self.raw.category_translation)

    @cached_property
    def stg_geolocation(self) -> DataFrame:
        return staging.stg_geolocation(self.raw.geolocation)

    @cached_property
    def int_order_items(self) -> DataFrame:
        return grain.int_order_items(self.stg_order_items)

    @cached_property
    def int_order_payments(self) -> DataFrame:
        return grain.int_order_payments(self.stg_order_payments)

    @cached_property
    def int_order_reviews(self) -> DataFrame:
        return grain.int_order_reviews(self.stg_order_reviews)

    @cached_property
    def int_geolocation(self) -> DataFrame:
        return grain.int_geolocation(self.stg_geolocation)

    @cached_property
    def int_orders_enriched(self) -> DataFrame:
        return grain.int_orders_enriched(
            self.stg_orders, self.int_order_items, self.int_order_payments, self.int_order_reviews
        )

    @cached_property
    def dim_date(self) -> DataFrame:
        if self._calendar is not None:
            return self._calendar
        return star.dim_date_covering(self.raw.orders, "order_purchase_timestamp")

    @cached_property
    def dim_customer(self) -> DataFrame:
        return star.dim_customer(self.stg_customers)

    @cached_property
    def dim_product(self) -> DataFrame:
        return star.dim_product(self.stg_products)

    @cached_property
    def dim_geography(self) -> DataFrame:
        return star.dim_geography(self.int_geolocation)

    def written(self, *names: str) -> Warehouse:
        """This warehouse with the tables ``names`` written once, for runs that read them many times."""
        found = copy(self)
        found._order_rows = {}
        for name in names:
            found.__dict__[name] = materialised(getattr(self, name))
        return found

    def order_rows(self, *columns: str, days: tuple[date, date] | None = None) -> DataFrame:
        """Fact and enriched order columns, with only the joins they need.

        ``days`` keeps orders bought between two days, both included.
        """
        if columns not in self._order_rows:
            self._order_rows[columns] = star.order_rows(
                self.stg_orders,
                self.int_order_items,
                self.stg_order_items,
                self.int_order_reviews,
                self.stg_customers,
                self.int_geolocation,
                columns,
            )
        rows = self._order_rows[columns]
        return rows.where(F.col("date_key").between(*map(F.lit, days))) if days else rows

    def fact(self, *columns: str, days: tuple[date, date] | None = None) -> DataFrame:
        """The given columns of the fact table. It never shows delivery dates or reviews."""
        unknown = set(columns) - set(star.FACT_COLUMNS)
        if unknown:
            raise ValueError(f"not columns of the fact table: {sorted(unknown)}")
        return self.order_rows(*columns, days=days)

    @property
    def fct_orders(self) -> DataFrame:
        return self.fact(*star.FACT_COLUMNS)

    @property
    def order_targets(self) -> DataFrame:
        """Key, purchase date and target of every fact row."""
        return self.fact("order_id", "date_key", "is_late")

    def build_intermediate(self, folder: str, buckets: int | None = None) -> dict[str, DataFrame]:
        """Write staged orders and the order-grain tables, then the enriched orders from them.

        With ``buckets`` all but the geography are dealt out and sorted by ``order_id``, so
        that joining them to each other shuffles nothing, now or later.
        """
        dealt = {"bucket_by": "order_id", "buckets": buckets} if buckets else {}
        written: dict[str, DataFrame] = {}
        for name in ("stg_orders", *INTERMEDIATE):
            table = self.enriched(written) if name == "int_orders_enriched" else getattr(self, name)
            how = {} if name == "int_geolocation" else dealt
            written[name] = replace_table(table, f"{folder}/intermediate/{name}", **how)
        return written

    @staticmethod
    def enriched(tables: Mapping[str, DataFrame]) -> DataFrame:
        """Orders with their items, payments and reviews, from tables that ``build_intermediate`` wrote."""
        return grain.int_orders_enriched(*[tables[n] for n in ("stg_orders", "int_order_items", "int_order_payments", "int_order_reviews")])

    def build(self, folder: str, buckets: int | None = None) -> StoredWarehouse:
        """Write the intermediate layer, then the marts from it, and open what was written.

        Running it again replaces every table. The fact is partitioned by month.
        """
        spark = self.dim_geography.sparkSession
        written = self.build_intermediate(folder, buckets)
        for name in DIMENSIONS:
            replace_table(getattr(self, name), f"{folder}/marts/{name}")
        month = F.year("date_key") * 100 + F.month("date_key")
        rows = star.order_rows(
            written["stg_orders"],
            written["int_order_items"],
            self.stg_order_items,
            written["int_order_reviews"],
            self.stg_customers,
            written["int_geolocation"],
            star.FACT_COLUMNS,
        )
        replace_table(rows.withColumn("ym", month), f"{folder}/marts/fct_orders", ["ym"])
        stored = StoredWarehouse(spark, folder, self)
        cells = order_cells(bi_base(stored)).withColumn("ym", F.col("annee") * 100 + F.col("mois"))
        replace_table(cells, f"{folder}/marts/order_cells", ["ym"])
        return stored


INTERMEDIATE = ["int_order_items", "int_order_payments", "int_order_reviews", "int_geolocation", "int_orders_enriched"]
DIMENSIONS = ["dim_date", "dim_customer", "dim_product", "dim_geography"]


class StoredWarehouse(Warehouse):
    """A written warehouse with the interface of the lazy one; staging but for orders stays a view over the raw tables."""

    def __init__(self, spark: SparkSession, folder: str, source: Warehouse):
        super().__init__(source.raw, source._calendar)
        tables = {name: f"{folder}/intermediate/{name}" for name in ("stg_orders", *INTERMEDIATE)}
        tables |= {name: f"{folder}/marts/{name}" for name in DIMENSIONS}
        # Written tables stand where the lazy ones would be computed.
        self.__dict__.update({name: read_table(spark, path) for name, path in tables.items()})
        self._fact = read_table(spark, f"{folder}/marts/fct_orders")
        self._spark, self._folder = spark, folder

    def written(self, *names: str) -> Warehouse:
        """Staged orders are written already."""
        return super().written(*[n for n in names if n != "stg_orders"])

    @property
    def order_cells(self) -> DataFrame:
        """Sums and counts by month, state and category; see ``plans.cells``."""
        return read_table(self._spark, f"{self._folder}/marts/order_cells")

    def order_rows(self, *columns: str, days: tuple[date, date] | None = None) -> DataFrame:
        """As in the lazy warehouse; a period reads the months it touches only."""
        rows = self._fact
        if days:
            first, last = (d.year * 100 + d.month for d in days)
            rows = rows.where(F.col("ym").between(first, last) & F.col("date_key").between(*map(F.lit, days)))
        extra = [c for c in columns if c in star.ENRICHED_ONLY]
        if extra:
            rows = rows.join(self.int_orders_enriched.select("order_id", *extra), "order_id")
        return rows.select(*columns)

