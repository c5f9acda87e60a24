"""Review themes: cleaned text, sentiment, rule labels and a text classifier.

Themes are data (``{theme: patterns}`` in priority order); the fixed production
themes are the default.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill import fixed_values as fixed
from waybill.functions.dates import year_month
from waybill.functions.text import (
    clean_text,
    is_filled,
    matches_any,
    rule_label,
    sentiment_from_score,
    word_count,
)
from waybill.operators.picking import first_examples, seeded_draw, stable_sample
from waybill.operators.quantiles import exact_quantiles
from waybill.operators.running import running_totals
from waybill.operators.softmax import fit_by_rows, fit_softmax
from waybill.operators.tfidf import inverse_frequencies, term_counts, weigh
from waybill.plans.model import class_weights, weight_column
from waybill.plans.order_grain import latest_reviews
from waybill.session import materialised

Themes = Mapping[str, Sequence[str]]


# --- populations -----------------------------------------------------------


def reviewed_orders(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """Every order with its latest review, cleaned; orders without one are kept."""
    latest = latest_reviews(reviews).select(
        "order_id", "review_score", "review_comment_title", "review_comment_message"
    )
    text = clean_text(F.col("review_comment_title"), F.col("review_comment_message"))
    return orders.select("order_id").join(latest, "order_id", "left").select(
        "order_id", "review_score", sentiment_from_score(F.col("review_score")).alias("sentiment"),
        text.alias("texte_nettoye"),
    )


def is_negative_with_text() -> Column:
    negative = F.col("sentiment") == fixed.SENTIMENT_NEGATIVE
    return F.coalesce(negative & (F.col("texte_nettoye") != ""), F.lit(False))


def negative_corpus(reviewed: DataFrame) -> DataFrame:
    return reviewed.filter(is_negative_with_text())


def all_reviews(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """Delivered orders with every review they got; several reviews give several rows."""
    return orders.select("order_id", "order_purchase_timestamp").join(
        reviews.select(
            "order_id", "review_id", "review_score", "review_comment_title", "review_comment_message"
        ),
        "order_id",
    )


# --- rules -----------------------------------------------------------------


def label_with_rules(negative: DataFrame, themes: Themes = fixed.THEME_PATTERNS) -> DataFrame:
    return negative.withColumn("motif_regle", rule_label(F.col("texte_nettoye"), themes))


def rule_counts(df: DataFrame, text: str, themes: Themes) -> DataFrame:
    """Per theme: texts it matches, texts it wins by priority, and shares.

    One pass; the catch-all row counts texts no theme matches.
    """
    flags = {t: matches_any(F.col(text), p) for t, p in themes.items()}
    matched = df.select(*[c.alias(f"m{i}") for i, c in enumerate(flags.values())])
    names = list(flags)
    cells, beaten = [], F.lit(False)
    for i, theme in enumerate(names):
        hit = F.col(f"m{i}")
        cells.append((theme, F.count_if(hit), F.count_if(hit & ~beaten)))
        beaten = beaten | hit
    cells.append((fixed.THEME_OTHER, F.count_if(~beaten), F.lit(0).cast("long")))
    rows = [
        F.struct(F.lit(t).alias("motif"), a.alias("n_independent"), b.alias("n_priority"))
        for t, a, b in cells
    ]
    counted = matched.agg(F.array(*rows).alias("__rows"), F.count(F.lit(1)).alias("total")).select(
        F.inline("__rows"), "total"
    )
    share = 100.0 / F.nullif(F.col("total"), F.lit(0))
    pct = F.col("n_independent") * share
    return counted.select(
        "motif",
        "n_independent",
        "n_priority",
        F.round(pct, 1).alias("pct_independent"),
        F.round(F.col("n_priority") * share, 1).alias("pct_priority"),
        (pct < fixed.MARGINAL_THEME_PCT).alias("is_marginal"),
    )


def theme_examples(negative: DataFrame, themes: Themes, n: int = 5, length: int = 100) -> DataFrame:
    """The first texts of every theme that matches them, whether or not it wins."""
    matching = F.filter(
        F.array(
            *[F.when(matches_any(F.col("texte_nettoye"), p), F.lit(t)) for t, p in themes.items()]
        ),
        lambda t: t.isNotNull(),
    )
    rows = negative.withColumn("motif", F.explode(matching))
    return first_examples(rows, "motif", "order_id", "texte_nettoye", n, length)


def unlabelled_sample(labelled: DataFrame, n: int, seed: int) -> DataFrame:
    rest = labelled.filter(F.col("motif_regle") == fixed.THEME_OTHER)
    return stable_sample(rest, ["order_id"], n, seed)


def stratified_split(df: DataFrame, key: str, label: str, share: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``is_test``: the same share of every label, chosen by a hash of the key.

    The cut is an exact quantile of the hash per label, so shares hold to
    within a row without ordering a label's rows in one task. Rows without a
    label are a group of their own and are split like any other.
    """
    group = F.struct(F.col(label).isNull(), F.coalesce(F.col(label).cast("string"), F.lit("")))
    drawn = df.withColumns({"__draw": seeded_draw([key], seed).cast("double"), "__group": group})
    cuts = exact_quantiles(drawn, ["__group"], "__draw", {"__cut": share}, few_groups=True)
    return drawn.join(F.broadcast(cuts), "__group").select(
        *df.columns, (F.col("__draw") < F.col("__cut")).alias("is_test")
    )


# --- classifier ------------------------------------------------------------


class ThemeClassifier:
    """Multinomial logistic regression on TF-IDF, trained on rule labels.

    The model keeps one coefficient per term and class, with an L2 penalty of 1 on the sum of
    balanced losses, in a written table that texts are joined with. Where terms are more than
    texts, the driver holds nothing by term. Texts without any frequent term, or of one class only,
    leave nothing to learn: then every text gets the catch-all with certainty.
    """

    def __init__(self, key: str = "order_id", text: str = "texte_nettoye", label: str = "motif_regle"):
        self.key, self.text, self.label = key, text, label

    def fit(self, labelled: DataFrame) -> ThemeClassifier:
        counts = materialised(term_counts(labelled, self.key, self.text))
        n_docs = labelled.agg(F.count(F.lit(1)).alias("n"))
        terms = inverse_frequencies(counts, n_docs).withColumn("position", F.lit(1))
        # Numbered by ranges of their hash, so that no prefix that many terms share is one task's.
        place = F.struct(F.xxhash64("term").alias("hash"), "term")
        numbered = running_totals(
            terms.withColumn("place", place), [], "place", ["position"], F.shiftright("place.hash", 52), exclusive=True
        )
        self.vocabulary = materialised(numbered.drop("place"))
        self.size = self.vocabulary.count()
        rows = class_weights(labelled, self.label).orderBy(self.label).collect()
        self.classes, self.terms = [r[self.label] for r in rows], None
        if self.size == 0 or len(rows) < 2:
            self.classes = [fixed.THEME_OTHER]
            return self
        number = {c: float(i) for i, c in enumerate(self.classes)}
        weights = {r[self.label]: r["weight"] for r in rows}
        ready = self._vectors(labelled, counts, [self.label]).select(
            "entries", weight_column(number, self.label).alias("label"), weight_column(weights, self.label).alias("weight")
        )
        if self.size <= sum(r["n"] for r in rows):
            fitted = fit_softmax(ready, self.size, len(self.classes))
            coefficients = fitted.table(labelled)
        else:
            fitted = fit_by_rows(ready, self.size, len(self.classes))
            coefficients = fitted.coefficients
        self.intercepts = [float(i) for i in fitted.intercepts]
        self.terms = materialised(self.vocabulary.join(coefficients, "position"))
        return self

    def _vectors(self, df: DataFrame, counts: DataFrame, keep: list[str]) -> DataFrame:
        """One row of sorted entries (position, unit-length weight) per text; texts without a known term get none."""
        known = counts.join(self.vocabulary.select("term", "idf", "position"), "term")
        raw = (1 + F.log("tf")) * F.col("idf")
        entry = F.struct(F.col("position").cast("int").alias("position"), raw.alias("raw"))
        found = known.groupBy(self.key).agg(F.sort_array(F.collect_list(entry)).alias("raw"), F.sqrt(F.sum(raw * raw)).alias("length"))
        # Scaled behind the join, where the length is a column: Spark would put an expression into each entry's.
        rows = df.select(self.key, *keep).join(found, self.key, "left")
        scaled = F.transform("raw", lambda e: F.struct(e["position"].alias("position"), (e["raw"] / F.col("length")).alias("weight")))
        none = F.array().cast("array<struct<position:int,weight:double>>")
        return rows.select(self.key, *keep, F.coalesce(scaled, none).alias("entries"))

    def probabilities(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """(key, keep.., probabilities) with one probability per class."""
        if self.terms is None:
            return df.select(self.key, *keep, F.array(F.lit(1.0)).alias("probabilities"))
        classes = range(len(self.classes))
        known = term_counts(df, self.key, self.text).join(self.terms.select("term", "idf", "b"), "term")
        raw = ((1 + F.log("tf")) * F.col("idf")).alias("raw")
        known = known.select(self.key, raw, "b")
        sums = [F.sum(F.col("raw") * F.get("b", F.lit(k))).alias(f"__{k}") for k in classes]
        found = known.groupBy(self.key).agg(F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("__length"), *sums)
        margins = [F.coalesce(F.col(f"__{k}") / F.col("__length"), F.lit(0.0)) + F.lit(self.intercepts[k]) for k in classes]
        rows = df.select(self.key, *keep).join(found, self.key, "left").select(self.key, *keep, F.array(*margins).alias("__z"))
        # Less the largest, as exponentials of large margins overflow.
        top = rows.select(self.key, *keep, "__z", F.array_max("__z").alias("__top"))
        e = top.select(self.key, *keep, F.transform("__z", lambda z: F.exp(z - F.col("__top"))).alias("__e"))
        total = e.select(self.key, *keep, "__e", F.aggregate("__e", F.lit(0.0), lambda a, x: a + x).alias("__total"))
        return total.select(self.key, *keep, F.transform("__e", lambda x: x / F.col("__total")).alias("probabilities"))

    def stationarity(self, labelled: DataFrame) -> DataFrame:
        """(class, position, gradient) of the penalised loss at the fitted coefficients, per unit of weight.

        Position -1 is the intercept. Row-local residuals meet the weights of their text's
        terms and are added by term, so nothing but the coefficients is ever whole.
        """
        counts = materialised(term_counts(labelled, self.key, self.text))
        weights = {r[self.label]: r["weight"] for r in class_weights(labelled, self.label).collect()}
        n = labelled.count()
        label = F.array(*[(F.col(self.label) == c).cast("double") for c in self.classes])
        miss = F.transform(
            F.arrays_zip(F.col("probabilities").alias("p"), label.alias("y")),
            lambda z: weight_column(weights, self.label) * (z["p"] - z["y"]) / n,
        )
        rows = materialised(self.probabilities(labelled, [self.label]).select(self.key, miss.alias("miss")))
        terms = weigh(counts, self.key, self.vocabulary, ["position"]).select(self.key, "position", "weight")
        each = terms.join(rows, self.key).unionByName(rows.select(self.key, F.lit(-1).cast("long").alias("position"), F.lit(1.0).alias("weight"), "miss"))
        sums = each.groupBy("position").agg(*[F.sum(F.col("weight") * F.get("miss", F.lit(k))).alias(f"g{k}") for k in range(len(self.classes))])
        both = sums.join(self.terms.select("position", "b"), "position", "left")
        penalty = lambda k: F.coalesce(F.get("b", F.lit(k)), F.lit(0.0)) / n
        parts = [
            F.struct(F.lit(c).alias("class"), (F.col(f"g{k}") + penalty(k)).alias("gradient"))
            for k, c in enumerate(self.classes)
        ]
        return both.select("position", F.inline(F.array(*parts))).select("class", "position", "gradient")


def most_likely(probabilities: Column, classes: Sequence[str]) -> Column:
    names = F.array(*[F.lit(c) for c in classes])
    return F.element_at(names, F.array_position(probabilities, F.array_max(probabilities)).cast("int"))


def reclassify(
    probabilities: Column, classes: Sequence[str], threshold: float = fixed.CONFIDENCE_THRESHOLD
) -> Column:
    """The most likely class when its probability is high enough, else the catch-all."""
    sure = F.array_max(probabilities) >= threshold
    return F.when(sure, most_likely(probabilities, classes)).otherwise(F.lit(fixed.THEME_OTHER))


def reclassified(labelled: DataFrame, classifier: ThemeClassifier) -> DataFrame:
    """``motif_final``: rule labels stay, only unlabelled texts may get a class."""
    other = F.col("motif_regle") == fixed.THEME_OTHER
    guesses = classifier.probabilities(labelled.filter(other)).select(
        "order_id", reclassify(F.col("probabilities"), classifier.classes).alias("__guess")
    )
    return labelled.join(guesses, "order_id", "left").withColumn(
        "motif_final", F.coalesce(F.when(other, F.col("__guess")), F.col("motif_regle"))
    ).drop("__guess")


# --- final table and reports -----------------------------------------------


def review_insights(
    reviewed: DataFrame, themes: Themes = fixed.THEME_PATTERNS, classifier: ThemeClassifier | None = None
) -> DataFrame:
    """(order_id, motif, sentiment, texte_nettoye), one row per order.

    Without a classifier the theme comes from the rules alone.
    """
    text = F.when(F.col("texte_nettoye") != "", F.col("texte_nettoye"))
    if classifier is None:
        theme = F.when(is_negative_with_text(), rule_label(F.col("texte_nettoye"), themes))
        rows = reviewed
    else:
        # Written, as the rules would be worked out anew for each reader of their labels.
        final = reclassified(materialised(label_with_rules(negative_corpus(reviewed), themes)), classifier)
        rows = reviewed.join(final.select("order_id", "motif_final"), "order_id", "left")
        theme = F.col("motif_final")
    return rows.select(
        "order_id",
        F.coalesce(theme, F.lit(fixed.THEME_NOT_APPLICABLE)).alias("motif"),
        "sentiment",
        text.alias("texte_nettoye"),
    )


def theme_distribution(insights: DataFrame, negative_only: bool = False) -> DataFrame:
    rows = insights.filter(F.col("sentiment") == fixed.SENTIMENT_NEGATIVE) if negative_only else insights
    counts = rows.groupBy("motif").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n"))
    return counts.withColumn("pct", F.round(100.0 * F.col("n") / total.scalar(), 1))


def text_coverage(joined: DataFrame) -> DataFrame:
    title = is_filled(F.col("review_comment_title"))
    message = is_filled(F.col("review_comment_message"))
    title, message = F.coalesce(title, F.lit(False)), F.coalesce(message, F.lit(False))
    return joined.agg(
        F.count(F.lit(1)).alias("n_reviews"),
        F.count_if(title).alias("n_title"),
        F.count_if(message).alias("n_message"),
        F.count_if(title | message).alias("n_either"),
        F.count_if(title & message).alias("n_both"),
    )


def text_coverage_by_month(joined: DataFrame) -> DataFrame:
    title = F.coalesce(is_filled(F.col("review_comment_title")), F.lit(False))
    message = F.coalesce(is_filled(F.col("review_comment_message")), F.lit(False))
    return joined.groupBy(year_month(F.col("order_purchase_timestamp")).alias("mois")).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(title | message).alias("avec_texte"),
        F.round(100.0 * F.count_if(title | message) / F.count(F.lit(1)), 1).alias("pct"),
    )


def text_length_stats(joined: DataFrame) -> DataFrame:
    """Words per filled message and per filled title: mean, min, max."""
    cells = []
    for name in ("review_comment_message", "review_comment_title"):
        length = F.when(is_filled(F.col(name)), word_count(F.col(name)))
        cells.append(
            F.struct(
                F.lit(name).alias("field"),
                F.avg(length).alias("mean_words"),
                F.min(length).alias("min_words"),
                F.max(length).alias("max_words"),
            )
        )
    return joined.agg(F.array(*cells).alias("__cells")).select(F.inline("__cells"))


def text_coverage_by_score(joined: DataFrame) -> DataFrame:
    message = F.coalesce(is_filled(F.col("review_comment_message")), F.lit(False))
    return joined.groupBy("review_score").agg(
        F.count(F.lit(1)).alias("n_reviews"),
        F.count_if(message).alias("n_message"),
        F.round(100.0 * F.count_if(message) / F.count(F.lit(1)), 1).alias("pct"),
    )
