"""Raw CSV tables: explicit all-string schemas, types are given in staging.

Reading everything as text keeps leading zeros of postal codes and spares the
extra pass that schema inference needs.
"""

from __future__ import annotations

import csv
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill.operators.running import running_totals

# --- fixed values: columns of the raw files, in file order -----------------
RAW_COLUMNS = {
    "orders": [
        "order_id", "customer_id", "order_status", "order_purchase_timestamp",
        "order_approved_at", "order_delivered_carrier_date",
        "order_delivered_customer_date", "order_estimated_delivery_date",
    ],
    "order_items": [
        "order_id", "order_item_id", "product_id", "seller_id",
        "shipping_limit_date", "price", "freight_value",
    ],
    "order_payments": [
        "order_id", "payment_sequential", "payment_type",
        "payment_installments", "payment_value",
    ],
    "order_reviews": [
        "review_id", "order_id", "review_score", "review_comment_title",
        "review_comment_message", "review_creation_date", "review_answer_timestamp",
    ],
    "customers": [
        "customer_id", "customer_unique_id", "customer_zip_code_prefix",
        "customer_city", "customer_state",
    ],
    "products": [
        "product_id", "product_category_name", "product_name_lenght",
        "product_description_lenght", "product_photos_qty", "product_weight_g",
        "product_length_cm", "product_height_cm", "product_width_cm",
    ],
    "sellers": ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"],
    "geolocation": [
        "geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng",
        "geolocation_city", "geolocation_state",
    ],
    "category_translation": ["product_category_name", "product_category_name_english"],
}


# Tables whose quoted free text may contain line breaks; only these are stitched.
MULTI_LINE_TABLES = {"order_reviews"}

_QUOTING = {"quote": '"', "escape": '"'}


def _header(spark: SparkSession, path: str) -> tuple[str, list[str]]:
    """The first line of a file (of the first file of a folder) and the names in it."""
    first = spark.read.text(path, lineSep="\n").first()
    if first is None:
        raise ValueError(f"{path} has no header")
    # Hadoop's line reader has left out a byte-order mark.
    line = first["value"].removesuffix("\r")
    return line, next(csv.reader([line], doublequote=True))


def _assert_has(names: list[str], columns: list[str], path: str) -> None:
    if missing := [c for c in columns if c not in names]:
        raise ValueError(f"{path} lacks columns {missing}; its header has {names}")
    if twice := [c for c in columns if names.count(c) > 1]:
        raise ValueError(f"{path} has columns {twice} more than once")


def read_csv(
    spark: SparkSession, path: str, columns: list[str], multi_line: bool = False
) -> DataFrame:
    """``columns`` of one CSV file or folder by the names in its header, doubled quotes inside quoted fields.

    Order in the file doesn't matter, further columns are left out, and a missing column
    raises ``ValueError``. Every file of a folder must have the header of the first; reading
    one that hasn't fails. A byte-order mark does no harm. With ``multi_line`` quoted fields
    may hold line breaks; files are still read in blocks by many tasks.
    """
    line, names = _header(spark, path)
    _assert_has(names, columns, path)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    if not multi_line:
        # Not enforcing the schema makes Spark hold every file's header against it.
        rows = spark.read.csv(path, schema=schema, header=True, enforceSchema=False, **_QUOTING)
        return rows.select(*[F.col(f"`{c}`") for c in columns])
    quoted = ", ".join("`{}` STRING".format(n.replace("`", "``")) for n in names)
    record = F.from_csv("value", quoted, _QUOTING)
    parsed = records(split_lines(spark, path), line).select(record.alias("r"))
    return parsed.select(*[F.col("r").getField(c).alias(c) for c in columns])


def split_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, line, value, quotes, before, rank): every line of the files and where it stands.

    ``before`` has the quotes that come before a line in its file: odd inside a quoted
    field, as a doubled quote counts twice. ``rank`` has the lines before it. Sums run
    within a block of a file, and over the blocks by their totals, so a file of any size is
    read and summed by as many tasks as it has blocks.
    """
    value = F.col("value")
    quotes = (F.length(value) - F.length(F.replace(value, F.lit('"'), F.lit("")))).cast("long")
    rows = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        # Rises along a block, which one task reads from start to end.
        F.monotonically_increasing_id().alias("line"),
        value,
        quotes.alias("quotes"),
        quotes.alias("before"),
        F.lit(1).cast("long").alias("rank"),
    )
    return running_totals(rows, ["file"], "line", ["before", "rank"], F.col("block"), exclusive=True)


def records(lines: DataFrame, header: str) -> DataFrame:
    """(value): the records of ``split_lines``, without headers and empty lines.

    A line that begins outside of quotes and closes all its own is a record as it stands.
    The others, few, are put together: each goes with the last line that began outside. A
    quote that is never closed makes one record of the rest of its file.
    """
    value, inside, odd = F.col("value"), F.col("before") % 2 == 1, F.col("quotes") % 2 == 1
    is_header = F.col("rank") == 0
    wrong = F.concat(F.lit("a CSV file has another header than the first: "), F.col("file"))
    row = F.when(~is_header, True).when(F.regexp_replace("value", "\r$", "") == header, False).otherwise(F.raise_error(wrong).cast("boolean"))
    rows = lines.where(row)
    whole = rows.where(~inside & ~odd).select("value")
    parts = rows.where(inside | odd).select("file", "block", "line", value, F.when(~inside, F.col("rank")).alias("start"), "rank")
    # Lines of one record carry the rank of its first.
    started = running_totals(parts, ["file"], "line", [], F.col("block"), maxima=["start"])
    line = F.struct("rank", "value")
    joined = started.groupBy("file", "start").agg(F.array_sort(F.collect_list(line)).alias("parts"))
    text = F.array_join(F.transform("parts", lambda p: p["value"]), "\n")
    every = whole.unionByName(joined.select(text.alias("value")))
    plain = F.regexp_replace(F.regexp_replace("value", "\r$", ""), "\r\n", "\n")
    return every.select(plain.alias("value")).where(F.col("value") != "")


def write_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    """CSV in the form ``read_csv`` reads, replacing what was there.

    A compressed file is read by one task; every task that writes makes a file.
    """
    df.write.mode("overwrite").csv(
        path,
        header=True,
        compression=compression,
        quote='"',
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def read_raw(
    spark: SparkSession, folder: str, files: Mapping[str, str] | None = None
) -> dict[str, DataFrame]:
    """Every table of the manifest ``{table: file name}`` as a lazy frame."""
    files = files or {table: f"{table}.csv" for table in RAW_COLUMNS}
    return {
        table: read_csv(
            spark, f"{folder.rstrip('/')}/{name}", RAW_COLUMNS[table], table in MULTI_LINE_TABLES
        )
        for table, name in files.items()
    }


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, n_rows) of all tables, in one job."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def parse_timestamps(df: DataFrame, columns: list[str]) -> DataFrame:
    """Text to wall-clock timestamps; unreadable text becomes NULL."""
    return df.withColumns({c: F.expr(f"try_cast({c} as timestamp_ntz)") for c in columns})
