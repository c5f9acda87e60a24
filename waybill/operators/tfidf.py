"""TF-IDF weights in long form (document, term, weight).

Word n-grams, document-frequency limits, logarithmic term counts, smoothed
inverse document frequency plus one, and unit length per document.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.functions.text import word_ngrams, words
from waybill.session import materialised


def term_counts(df: DataFrame, doc: str, text: str, longest: int = 2) -> DataFrame:
    """Occurrences of every n-gram in every document."""
    tokens = df.select(doc, words(F.col(text)).alias("__tokens"))
    return (
        tokens.select(doc, F.explode(word_ngrams(F.col("__tokens"), longest)).alias("term"))
        .groupBy(doc, "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )


def inverse_frequencies(
    counts: DataFrame, n_docs: DataFrame, min_df: int = 3, max_df: float = 0.9
) -> DataFrame:
    """Kept vocabulary (term, df, idf). ``n_docs`` is a one-row, one-column frame."""
    total = n_docs.scalar()
    return (
        counts.groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"))
        .filter((F.col("df") >= min_df) & (F.col("df") <= max_df * total))
        .withColumn("idf", F.log((1 + total) / (1 + F.col("df"))) + 1)
    )


def weigh(counts: DataFrame, doc: str, vocabulary: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Unit-length weights of the terms of ``counts`` that are in ``vocabulary``.

    ``vocabulary`` has a row per term, so a very frequent term is a skewed join that
    adaptive execution splits. ``keep`` names more of its columns.
    """
    known = counts.join(vocabulary.select("term", "idf", *keep), "term")
    raw = known.select(doc, "term", *keep, ((1 + F.log("tf")) * F.col("idf")).alias("__raw"))
    lengths = raw.groupBy(doc).agg(F.sqrt(F.sum(F.col("__raw") * F.col("__raw"))).alias("__length"))
    weight = (F.col("__raw") / F.col("__length")).alias("weight")
    return raw.join(lengths, doc).select(doc, "term", *keep, weight)


def tfidf(
    df: DataFrame,
    doc: str,
    text: str,
    longest: int = 2,
    min_df: int = 3,
    max_df: float = 0.9,
) -> DataFrame:
    """(doc, term, weight). The n-gram counts are built and written once for all passes over them."""
    counts = materialised(term_counts(df, doc, text, longest))
    n_docs = df.agg(F.count(F.lit(1)).alias("n"))
    return weigh(counts, doc, inverse_frequencies(counts, n_docs, min_df, max_df))
