"""Host-level quality rules.

Every document is measured and judged by plain rules. The rules' failures are then
added up by host, each host's rates are shrunk towards the corpus rate by a beta
prior that is fitted to the hosts themselves, and hosts whose shrunk rate is beyond a
limit lose all their documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.llm.shared import WORD, let, words
from waybill.session import materialised

SYMBOLS = "#*$%&|<>"
#: A rule's largest shrunk failure rate of a host that is kept. Each rule is a column of ``measured``.
LIMITS = {"base_failed": 0.5, "symbols_failed": 0.5, "lines_failed": 0.5}


def repeated_words(w: Column, width: int = 3) -> Column:
    """Words of ``w`` inside windows of ``width`` words that occur twice or more.

    Windows are sorted by hash within the row, so equal ones are neighbours; then the
    starts of repeated windows are sorted, and each covers what the next does not.
    """
    grams = F.transform(
        F.sequence(F.lit(0), F.size(w) - width),
        lambda i: F.struct(F.xxhash64(*[F.get(w, i + k) for k in range(width)]).alias("h"), i.alias("i")),
    )

    def starts(s: Column) -> Column:
        twin = lambda x, k: (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"])
        return F.sort_array(F.transform(F.filter(s, lambda x, k: F.coalesce(twin(x, k), F.lit(False))), lambda x: x["i"]))

    def covered(p: Column) -> Column:
        return F.aggregate(
            F.transform(p, lambda x, k: F.least(F.lit(width), F.coalesce(F.get(p, k + 1) - x, F.lit(width)))),
            F.lit(0),
            lambda a, b: a + b,
        )

    return F.when(F.size(w) > width, let(let(F.sort_array(grams), starts), covered)).otherwise(0).cast("long")


def repeated_lines(text: Column) -> Column:
    """Lines that hold a word and equal an earlier line."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: its host, measures and failed rules."""
    text = F.coalesce(F.col("text"), F.lit(""))
    facts = lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.aggregate(w, F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("word_chars"),
        repeated_words(w).alias("n_repeat_words"),
    )
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).cast("string").alias("host"), F.col(text_col).alias("text"))
    rows = rows.select(
        "doc_id",
        "host",
        let(words(F.col("text")), facts).alias("f"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        repeated_lines(text).alias("n_dup_lines"),
        F.size(F.split(text, "\n", -1)).alias("n_lines"),
    )
    rows = rows.select("doc_id", "host", "f.*", "n_symbols", "n_dup_lines", "n_lines")
    return rows.withColumns(
        {
            "base_failed": (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
            "symbols_failed": 10 * F.col("n_symbols") > F.col("n_words"),
            "lines_failed": 10 * F.col("n_dup_lines") > 3 * F.col("n_lines"),
        }
    )


def host_rates(rows: DataFrame, rules: list[str]) -> DataFrame:
    """Per host: number of documents and, for each rule, the failures and the shrunk rate.

    The prior of a rule has the corpus rate m as its mean. Its weight follows from the
    spread of host rates beyond what m(1-m)/n would give by chance (moments), between 1
    and a million documents. Only the moments, one row, come to the driver.
    """
    hosts = rows.where(F.col("host").isNotNull()).groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(F.col(r).cast("long")).alias(r) for r in rules]
    )
    sums = [F.sum("n").alias("n"), F.count(F.lit(1)).alias("hosts")]
    sums += [x for r in rules for x in (F.sum(r).alias(r), F.sum(F.col(r) * F.col(r) / F.col("n")).alias(f"{r}_sq"))]
    total = hosts.agg(*sums).first()
    for r in rules:
        n = total["n"] or 1
        mean = (total[r] or 0) / n
        spread = (total[f"{r}_sq"] or 0) / n - mean * mean
        chance = mean * (1 - mean)
        between = spread - chance * total["hosts"] / n
        weight = min(1e6, max(1.0, chance / between - 1)) if between > 0 else 1e6
        hosts = hosts.withColumn(f"{r}_rate", (F.col(r) + mean * weight) / (F.col("n") + weight))
    return hosts


def host_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    limits: dict[str, float] | None = None,
) -> DataFrame:
    """doc_id, the measures, base_failed, host_failed, kept: one row per row of ``docs``.

    A null text has no words and fails the base rule like any text under 50 words. A
    document without host is judged by the base rule alone. Repeated rows count as often
    as they occur, other columns are ignored, an empty table gives an empty result.
    Measures are written once to the shared folder, so texts are read once.
    """
    limits = LIMITS if limits is None else limits
    rows = materialised(measured(docs, id_col, text_col, host_col))
    hosts = materialised(host_rates(rows, list(limits)))
    failed = F.lit(False)
    for rule, limit in limits.items():
        failed = failed | (F.col(f"{rule}_rate") > limit)
    verdicts = hosts.where(failed).select("host", F.lit(True).alias("host_failed"))
    return rows.join(verdicts, "host", "left").select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        F.coalesce("host_failed", F.lit(False)).alias("host_failed"),
        (~F.col("base_failed") & F.col("host_failed").isNull()).alias("kept"),
    )
