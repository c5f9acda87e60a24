"""The given TPC-H-like tables seen as the nine raw marketplace tables.

Only renames and row-wise formulas, so every plan built on top does its real
work on the full given tables. The same mapping is written in SQL in
``waybill.catalog.sql``.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# --- fixed values: demo codes given to the first nations and part types ----
DEMO_STATES = [
    "SP", "RJ", "MG", "RS", "PR", "SC", "BA", "DF", "GO", "ES",
    "PE", "CE", "PA", "MT", "MA", "MS", "PB", "PI", "RN", "AL",
]
DEMO_CATEGORIES = {
    "ECONOMY": "health_beauty",
    "LARGE": "bed_bath_table",
    "MEDIUM": "sports_leisure",
    "SMALL": "toys",
    "STANDARD": "standard_goods",
}
DEMO_THEMES = {
    "license": ["licen"],
    "contact": ["@"],
    "numbers": ["[0-9]{3}"],
    "schung": ["sch[a-z]*ung"],
}
# Ends of review texts: one or two for each theme, none, and words of no theme.
DEMO_SENTENCES = [
    "",
    "\nO pedido veio com atraso e ainda demora.",
    " Chegou quebrado e com defeito",
    "\nNÃO recebi o produto, faltou uma peça",
    " Produto errado, veio diferente do anúncio.",
    " a cor é mais escura, não é igual",
    "\npéssimo, não gostei",
]
ITEM_ORDER = [
    "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
    "l_shipdate", "l_tax", "l_discount", "l_returnflag", "l_linestatus",
]
DEMO_CUTOFF = "2000-01-01"
DEMO_CUTOFFS = ["1998-01-01", "1999-01-01", "2000-01-01", "2001-01-01"]
DEMO_Q90 = 0.9


def _seconds(n: Column) -> Column:
    return F.make_dt_interval(secs=n)


def _days(n: Column) -> Column:
    return F.make_dt_interval(days=n.cast("int"))


class DriverTables:
    """Raw tables over one folder of given Parquet files; everything is lazy."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._given: dict[str, DataFrame] = {}

    def given(self, name: str) -> DataFrame:
        """One of the given tables; its footer is read once."""
        if name not in self._given:
            self._given[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._given[name]

    @cached_property
    def _per_order(self) -> DataFrame:
        return self.given("lineitem").groupBy("l_orderkey").agg(
            F.sum(F.col("l_partkey") + F.col("l_suppkey")).alias("mix")
        )

    @cached_property
    def orders(self) -> DataFrame:
        key = F.col("o_orderkey")
        purchase = F.col("o_orderdate") + _seconds((key * 7919) % 86400)
        promised_days = F.when(F.col("o_orderpriority") == "5-LOW", 30).otherwise(20)
        promised_days = F.when(key % 251 == 0, -2).otherwise(promised_days)
        delivered = (
            F.col("o_orderdate")
            + _days(1 + F.col("mix") % 26)
            + _seconds((key * 104729) % 86400)
        )
        joined = self.given("orders").join(
            self._per_order.select("l_orderkey", "mix"), key == F.col("l_orderkey"), "left"
        )
        return joined.select(
            key.alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.when(F.col("o_orderstatus") == "F", "canceled").otherwise("delivered").alias("order_status"),
            purchase.alias("order_purchase_timestamp"),
            (purchase + _seconds((key * 31) % 7200 - 60)).alias("order_approved_at"),
            (delivered - _seconds(F.lit(43200))).alias("order_delivered_carrier_date"),
            delivered.alias("order_delivered_customer_date"),
            (F.col("o_orderdate") + _days(promised_days)).alias("order_estimated_delivery_date"),
        )

    @cached_property
    def order_items(self) -> DataFrame:
        """Items numbered from 1 within each order, without ties. Plans that don't use the
        number lose its window to column pruning."""
        number = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*ITEM_ORDER))
        return self.given("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            number.alias("order_item_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("seller_id"),
            F.col("l_shipdate").alias("shipping_limit_date"),
            F.col("l_extendedprice").alias("price"),
            (F.col("l_quantity") * F.col("l_tax")).alias("freight_value"),
        )

    @cached_property
    def order_payments(self) -> DataFrame:
        event = F.col("event_id")
        return self.given("events").select(
            F.expr("event_id div 3").alias("order_id"),
            (event % 3 + 1).cast("int").alias("payment_sequential"),
            F.col("event_type").alias("payment_type"),
            (1 + event % 10).cast("int").alias("payment_installments"),
            F.col("value").alias("payment_value"),
        )

    @cached_property
    def order_reviews(self) -> DataFrame:
        doc = F.col("doc_id")
        created = F.lit("2018-01-01").cast("timestamp_ntz") + _days((doc % 3) * (doc % 3) % 3)
        score = (
            F.when(F.col("toxic") == 1, F.lit(1))
            .when((F.col("quality") == 0) | (doc % 5 < 2), F.lit(2))
            .when(F.col("quality") == 1, (4 + doc % 2).cast("int"))
            .otherwise(F.lit(3))
        )
        return self.given("documents").join(self.given("labels"), "doc_id", "left").select(
            doc.alias("review_id"),
            F.expr("doc_id div 2").alias("order_id"),
            score.alias("review_score"),
            F.when(doc % 3 != 0, F.col("source")).alias("review_comment_title"),
            F.concat("text", F.get(F.array(*[F.lit(s) for s in DEMO_SENTENCES]), doc % len(DEMO_SENTENCES))).alias(
                "review_comment_message"
            ),
            created.alias("review_creation_date"),
            (created + _seconds((doc * 977) % 172800)).alias("review_answer_timestamp"),
        )

    def _state(self, nation: Column, name: Column) -> Column:
        code = F.get(F.array(*[F.lit(" " + s.lower()) for s in DEMO_STATES]), nation)
        return F.coalesce(code, name)

    @cached_property
    def customers(self) -> DataFrame:
        nation = F.col("c_nationkey")
        return (
            self.given("customer")
            .join(self.given("nation"), nation == F.col("n_nationkey"))
            .select(
                F.col("c_custkey").alias("customer_id"),
                F.col("c_name").alias("customer_unique_id"),
                nation.alias("customer_zip_code_prefix"),
                F.col("c_mktsegment").alias("customer_city"),
                self._state(nation, F.col("n_name")).alias("customer_state"),
            )
        )

    @cached_property
    def sellers(self) -> DataFrame:
        nation = F.col("s_nationkey")
        return (
            self.given("supplier")
            .join(self.given("nation"), nation == F.col("n_nationkey"))
            .select(
                F.col("s_suppkey").alias("seller_id"),
                nation.alias("seller_zip_code_prefix"),
                self._state(nation, F.col("n_name")).alias("seller_state"),
                F.col("s_name").alias("seller_city"),
            )
        )

    @cached_property
    def products(self) -> DataFrame:
        size = F.col("p_size")
        side = F.when(size != 50, size)
        return self.given("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_type").alias("product_category_name"),
            F.length("p_name").alias("product_name_lenght"),
            F.length("p_brand").alias("product_description_lenght"),
            (size % 5).alias("product_photos_qty"),
            (100 * size).alias("product_weight_g"),
            side.alias("product_length_cm"),
            (side + 1).alias("product_height_cm"),
            (side + 2).alias("product_width_cm"),
        )

    @cached_property
    def category_translation(self) -> DataFrame:
        names = F.create_map(*[F.lit(x) for pair in DEMO_CATEGORIES.items() for x in pair])
        return (
            self.given("part")
            .select(F.col("p_type").alias("product_category_name"))
            .distinct()
            .withColumn("product_category_name_english", names[F.col("product_category_name")])
            .filter(F.col("product_category_name_english").isNotNull())
        )

    @cached_property
    def geolocation(self) -> DataFrame:
        label = F.col("label")
        return self.given("embeddings").select(
            label.alias("geolocation_zip_code_prefix"),
            (F.lit(-14.0) + 80 * F.get("embedding", F.lit(0)).cast("double")).alias("geolocation_lat"),
            (F.lit(-51.0) + 90 * F.get("embedding", F.lit(1)).cast("double")).alias("geolocation_lng"),
            F.lit(" Cidade ").alias("geolocation_city"),
            F.concat(F.lit("s"), (label % 3).cast("string")).alias("geolocation_state"),
        )

    def all_raw(self) -> dict[str, DataFrame]:
        return {
            "orders": self.orders,
            "order_items": self.order_items,
            "order_payments": self.order_payments,
            "order_reviews": self.order_reviews,
            "customers": self.customers,
            "products": self.products,
            "sellers": self.sellers,
            "geolocation": self.geolocation,
            "category_translation": self.category_translation,
        }


def demo_probability(key: Column) -> Column:
    """A stand-in score in [0, 1) with four decimals, many orders sharing a value."""
    return (((key % 10000) * 5761) % 10000).cast("double") / F.lit(10000.0).cast("double")
