"""The registered queries of this package, and SQL that checks those that SQL can express."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.llm import (
    chat_format,
    collocations,
    embedding_dedup,
    host_rules,
    html_text,
    lexical_search,
    mixing,
    packing,
    quality_model,
    secrets,
    simhash,
    substring_dedup,
    url_lists,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def register(f):
        QUERIES[name] = f
        return f

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path() -> str:
    """Where the tokenizer file is on this machine; executors have the same packages."""
    import public_tokenizers

    return os.environ.get("WAYBILL_TOKENIZER") or str(public_tokenizers.path("word_bpe_49k.json"))


def drawn(value: Column, at: int) -> Column:
    """A number below 65,536 from four hex digits of a value's MD5, which SQL has too."""
    return F.conv(F.substring(F.md5(value), at, 4), 16, 10).cast("int")


@query("op1_substring_dedup")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.substring_dedup(table(spark, folder, "documents")).drop("kept_text")


@query("op2_quality_classifier")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return quality_model.quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op3_best_fit_packing")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), tokenizer_path())


def captures(pages: DataFrame) -> DataFrame:
    """Pages have no fetch day; it follows from the id: 1,000 days from 2021 on."""
    return pages.withColumn("fetched_on", F.expr("date_add(date'2021-01-01', cast(page_id % 1000 as int))"))


def dated_list(pages: DataFrame) -> DataFrame:
    """A list log over the pages' own hosts: a block and its end for each host, and blocks of some parent domains."""
    hosts = pages.select(url_lists.host_of(F.col("url")).alias("host")).where("host is not null").distinct()
    host = F.col("host")
    day = lambda c: F.date_add(F.lit("2020-06-01").cast("date"), c)
    began = drawn(host, 1) % 1200
    ended = began + drawn(host, 5) % 500
    own = hosts.where(drawn(host, 9) % 3 > 0)
    block = own.select(host.alias("domain"), day(began).alias("listed_on"), F.lit("block").alias("action"))
    end = own.select(host.alias("domain"), day(ended).alias("listed_on"), F.when(drawn(host, 13) % 2 == 0, "remove").otherwise("allow").alias("action"))
    parent = F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1)
    above = hosts.select(parent.alias("domain")).where("domain <> ''").distinct()
    above = above.select("domain", day(drawn(F.col("domain"), 1) % 1200).alias("listed_on"), F.lit("block").alias("action"))
    return block.unionByName(end).unionByName(above)


@query("op4_url_lists")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return url_lists.url_filter(captures(pages.select("page_id", "url")), dated_list(pages))


@query("op5_embedding_dedup")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.embedding_dedup(table(spark, folder, "embeddings"))


def with_domain(docs: DataFrame) -> DataFrame:
    """Documents have no domain; it follows from the source."""
    return docs.withColumn("domain", F.concat(F.lit("d"), (drawn(F.col("source"), 1) % 3).cast("string")))


def target_weights(docs: DataFrame) -> DataFrame:
    """(domain, lang, source, weight): languages weigh 5 (en), 2 (de, fr) or 1, sources 1 to 5."""
    leaves = docs.select("domain", "lang", "source").distinct()
    lang = F.when(F.col("lang") == "en", 5).when(F.col("lang").isin("de", "fr"), 2).otherwise(1)
    return leaves.withColumn("weight", (lang * (1 + F.coalesce(drawn(F.col("source"), 5), F.lit(0)) % 5)).cast("double"))


@query("op6_mixing")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    docs = with_domain(table(spark, folder, "documents"))
    return mixing.mixed(docs, target_weights(docs)).drop("key")


@query("op7_secret_scan")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.secret_spans(table(spark, folder, "documents"))


@query("op8_host_rules")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return host_rules.host_rules(table(spark, folder, "documents"))


@query("op9_simhash_near_dedup")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.simhash_near_dedup(table(spark, folder, "documents")).drop("kept")


@query("op10_chat_format")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return chat_format.chat_format(table(spark, folder, "conversations"))


@query("op11_lexical_search")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return lexical_search.lexical_search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op12_collocations")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


@query("op13_html_text")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.html_text(table(spark, folder, "pages"))


@query("pipeline")
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)
