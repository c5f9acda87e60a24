"""Review themes and text statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from waybill.catalog.demo import reviewed, rule_insights
from waybill.catalog.registry import query, rounded
from waybill.fixed_values import EXPLORED_THEME_PATTERNS, THEME_OTHER, THEME_PATTERNS
from waybill.functions.text import clean_text, sentiment_from_score
from waybill.operators.metrics import class_report, confusion_matrix
from waybill.operators.tfidf import tfidf
from waybill.plans import themes
from waybill.session import materialised
from waybill.sources.driver_tables import DEMO_THEMES


@query("dim_population_left", "select order_id, review_score, sentiment, texte_nettoye from reviewed")
def dim_population_left(w):
    return reviewed(w)


@query("reviews_raw_join", "select * from joined_reviews")
def reviews_raw_join(w):
    return themes.all_reviews(w.stg_orders, w.stg_order_reviews)


_CLEAN = r"""regexp_replace(
    regexp_replace(lower(coalesce(review_comment_title, '')), '^\s+|\s+$', '', 'g') || ' ' ||
    regexp_replace(lower(coalesce(review_comment_message, '')), '^\s+|\s+$', '', 'g'),
    '^\s+|\s+$', '', 'g')"""


@query("clean_text", f"select review_id, {_CLEAN} as texte_nettoye from stg_order_reviews")
def clean_texts(w):
    text = clean_text(F.col("review_comment_title"), F.col("review_comment_message"))
    return w.stg_order_reviews.select("review_id", text.alias("texte_nettoye"))


@query(
    "sentiment_from_score",
    """select review_id, case when review_score <= 2 then 'negatif' when review_score = 3 then 'neutre'
        when review_score is not null then 'positif' end as sentiment
    from stg_order_reviews""",
)
def sentiments(w):
    return w.stg_order_reviews.select(
        "review_id", sentiment_from_score(F.col("review_score")).alias("sentiment")
    )


@query("negative_text_corpus", "select * from negatives")
def negative_text_corpus(w):
    return themes.negative_corpus(reviewed(w))


def _labelled(w):
    return themes.label_with_rules(themes.negative_corpus(reviewed(w)), DEMO_THEMES)


@query("rule_label", "select order_id, motif_regle from rule_labels")
def rule_label(w):
    return _labelled(w).select("order_id", "motif_regle")


@query("review_insights", "select * from insights")
def review_insights(w):
    return rule_insights(w)


@query(
    "theme_distribution",
    """select 'all' as scope, motif, count(*) as n,
        round(100.0 * count(*) / (select count(*) from insights), 1) as pct
    from insights group by motif
    union all
    select 'negative', motif, count(*),
        round(100.0 * count(*) / (select count(*) from insights where sentiment = 'negatif'), 1)
    from insights where sentiment = 'negatif' group by motif""",
)
def theme_distribution(w):
    insights = rule_insights(w)
    whole = themes.theme_distribution(insights).withColumn("scope", F.lit("all"))
    negative = themes.theme_distribution(insights, negative_only=True)
    return whole.unionByName(negative.withColumn("scope", F.lit("negative")))


def _rule_counts_sql() -> str:
    names = list(DEMO_THEMES)
    hits = {t: f"regexp_matches(t, '{'|'.join(p)}')" for t, p in DEMO_THEMES.items()}
    parts = []
    for i, theme in enumerate(names):
        before = " and ".join(f"not {hits[n]}" for n in names[:i]) or "true"
        parts.append((theme, hits[theme], f"{hits[theme]} and {before}"))
    parts.append(("autre", " and ".join(f"not {h}" for h in hits.values()), "false"))
    return " union all ".join(
        f"""select '{t}' as motif, count(*) filter (where {a}) as n_independent,
            count(*) filter (where {b}) as n_priority,
            round(100.0 * count(*) filter (where {a}) / count(*), 1) as pct_independent,
            round(100.0 * count(*) filter (where {b}) / count(*), 1) as pct_priority,
            100.0 * count(*) filter (where {a}) / count(*) < 3 as is_marginal
        from texts"""
        for t, a, b in parts
    )


@query(
    "rule_independent_vs_priority",
    f"with texts as (select {_CLEAN} as t from joined_reviews) " + _rule_counts_sql(),
)
def rule_independent_vs_priority(w):
    joined = themes.all_reviews(w.stg_orders, w.stg_order_reviews)
    text = clean_text(F.col("review_comment_title"), F.col("review_comment_message"))
    return themes.rule_counts(joined.select(text.alias("texte")), "texte", DEMO_THEMES)


@query(
    "examples_per_theme",
    " union all ".join(
        f"""select '{t}' as motif, row_number() over (order by order_id)::integer as example_no, order_id,
            substr(texte_nettoye, 1, 100) as example
        from negatives where regexp_matches(texte_nettoye, '{'|'.join(p)}')
        qualify row_number() over (order by order_id) <= 5"""
        for t, p in DEMO_THEMES.items()
    ),
)
def examples_per_theme(w):
    return themes.theme_examples(themes.negative_corpus(reviewed(w)), DEMO_THEMES)


_DRAW = "('0x' || substr(md5('42:' || order_id), 1, 13))::bigint"


@query(
    "sample_rows",
    f"""select order_id, review_score, sentiment, texte_nettoye, motif_regle from rule_labels
    where motif_regle = 'autre' order by {_DRAW}, order_id limit 25""",
)
def sample_rows(w):
    return themes.unlabelled_sample(_labelled(w), 25, 42)


@query(
    "random_stratified_split",
    f"""with drawn as (select order_id, motif_regle, {_DRAW}::double as draw from rule_labels)
    select order_id, motif_regle, draw < quantile_cont(draw, 0.2) over (partition by motif_regle) as is_test from drawn""",
)
def random_stratified_split(w):
    return themes.stratified_split(_labelled(w), "order_id", "motif_regle").select(
        "order_id", "motif_regle", "is_test"
    )


def _re2(pattern: str) -> str:
    """A pattern for the SQL side, whose word boundary knows ASCII letters only."""
    return pattern.replace(r"\b", r"(?:^|[^\p{L}\p{N}_])").replace("'", "''")


def _themes_sql(text: str, patterns) -> dict[str, str]:
    return {t: f"regexp_matches({text}, '{'|'.join(f'(?:{_re2(x)})' for x in p)}')" for t, p in patterns.items()}


@query(
    "rule_label_production",
    "select order_id, case "
    + " ".join(f"when {hit} then '{t}'" for t, hit in _themes_sql("texte_nettoye", THEME_PATTERNS).items())
    + " else 'autre' end as motif_regle from negatives",
)
def rule_label_production(w):
    """The production patterns over negative texts."""
    return themes.label_with_rules(themes.negative_corpus(reviewed(w))).select("order_id", "motif_regle")


EXPLORED = THEME_PATTERNS | EXPLORED_THEME_PATTERNS


@query(
    "rule_counts_explored",
    " union all ".join(
        f"select '{t}' as motif, count(*) filter (where {hit}) as n_independent from negatives"
        for t, hit in (
            _themes_sql("texte_nettoye", EXPLORED)
            | {"autre": "not (" + " or ".join(_themes_sql("texte_nettoye", EXPLORED).values()) + ")"}
        ).items()
    ),
)
def rule_counts_explored(w):
    """Production themes and the explored one, each counted on its own."""
    texts = themes.negative_corpus(reviewed(w))
    return themes.rule_counts(texts, "texte_nettoye", EXPLORED).select("motif", "n_independent")


_GRAMS = r"""
    with tokens as (
        select order_id, regexp_extract_all(lower(texte_nettoye), '[\p{L}\p{N}_]{2,}') as t from negatives),
    placed as (select order_id, t, unnest(range(1, len(t) + 1)) as i from tokens where len(t) > 0),
    grams as (
        select order_id, t[i] as term from placed
        union all
        select order_id, t[i] || ' ' || t[i + 1] from placed where i < len(t)),
    tf as (select order_id, term, count(*) as tf from grams group by 1, 2),
    df as (
        select term, count(*) as df from tf group by 1
        having count(*) >= 3 and count(*) <= 0.9 * (select count(*) from negatives)),
    raw as (
        select tf.order_id, tf.term,
            (1 + ln(tf.tf)) * (ln((1 + (select count(*) from negatives)) / (1 + df.df)) + 1) as w
        from tf join df on tf.term = df.term)
    select order_id, term, round(w / sqrt(sum(w * w) over (partition by order_id)), 6) as weight from raw"""


@query("tfidf_features", _GRAMS)
def tfidf_features(w):
    weights = tfidf(themes.negative_corpus(reviewed(w)), "order_id", "texte_nettoye")
    return rounded(weights, 6, "weight")


@query(
    "reclassify_confident",
    """with given as (
        select review_id, [((review_id % 101) * 37) % 100 + 1, ((review_id % 103) * 53) % 100 + 1,
            ((review_id % 107) * 71) % 100 + 1, ((review_id % 109) * 89) % 100 + 1] as raw
        from stg_order_reviews),
    shares as (select review_id, list_transform(raw, lambda x: x / list_sum(raw)) as p from given)
    select review_id, case when list_max(p) >= 0.6
        then (['contact', 'license', 'numbers', 'schung'])[list_position(p, list_max(p))]
        else 'autre' end as motif
    from shares""",
)
def reclassify_confident(w):
    key = F.col("review_id")
    raw = [((key % m) * f) % 100 + 1 for m, f in ((101, 37), (103, 53), (107, 71), (109, 89))]
    total = raw[0] + raw[1] + raw[2] + raw[3]
    probabilities = F.array(*[r / total for r in raw])
    return w.stg_order_reviews.select(
        "review_id",
        themes.reclassify(probabilities, ["contact", "license", "numbers", "schung"]).alias("motif"),
    )


def _rule_labelled(w):
    """Training rows, as in production: negative texts that a rule labels.

    Texts are cleaned and labelled once, however often the rows are read: Spark would put both
    into every filter and pass.
    """
    negatives = materialised(themes.negative_corpus(reviewed(w)))
    return materialised(themes.label_with_rules(negatives)).filter(F.col("motif_regle") != THEME_OTHER)


def _held_out_guesses(w):
    parts = materialised(themes.stratified_split(_rule_labelled(w), "order_id", "motif_regle"))
    fitted = themes.ThemeClassifier().fit(parts.filter(~F.col("is_test")))
    guesses = fitted.probabilities(parts.filter("is_test"), ["motif_regle"])
    return guesses.withColumn("guess", themes.most_likely(F.col("probabilities"), fitted.classes))


@query("theme_classifier")
def theme_classifier(w):
    """Class report of the classifier on its held-out fifth of the rule-labelled texts."""
    return class_report(_held_out_guesses(w), "motif_regle", "guess", [*THEME_PATTERNS, THEME_OTHER])


@query("theme_stationarity", "select 0::bigint as n_beyond, true as covers_vocabulary")
def theme_stationarity(w):
    """The gradient of the classifier's penalised loss is zero for every term and class."""
    labelled = _rule_labelled(w)
    fitted = themes.ThemeClassifier().fit(labelled)
    found = fitted.stationarity(labelled)
    whole = (fitted.size + 1) * len(fitted.classes)
    return found.agg(
        F.coalesce(F.count_if(F.abs("gradient") > 1e-5), F.lit(0)).alias("n_beyond"), (F.count(F.lit(1)) == whole).alias("covers_vocabulary")
    )


@query("theme_confusion")
def theme_confusion(w):
    """Confusion of the same held-out fifth over all themes."""
    return confusion_matrix(_held_out_guesses(w), "motif_regle", "guess", [*THEME_PATTERNS, THEME_OTHER])


@query("review_insights_classified")
def review_insights_classified(w):
    base = materialised(reviewed(w))
    labelled = materialised(themes.label_with_rules(themes.negative_corpus(base))).filter(F.col("motif_regle") != THEME_OTHER)
    return themes.review_insights(base, classifier=themes.ThemeClassifier().fit(labelled))


# --- text coverage ---------------------------------------------------------

_HAS_TITLE = r"coalesce(regexp_replace(review_comment_title, '^\s+|\s+$', '', 'g') <> '', false)"
_HAS_MESSAGE = r"coalesce(regexp_replace(review_comment_message, '^\s+|\s+$', '', 'g') <> '', false)"


@query(
    "text_coverage",
    f"""select count(*) as n_reviews, count(*) filter (where {_HAS_TITLE}) as n_title,
        count(*) filter (where {_HAS_MESSAGE}) as n_message,
        count(*) filter (where {_HAS_TITLE} or {_HAS_MESSAGE}) as n_either,
        count(*) filter (where {_HAS_TITLE} and {_HAS_MESSAGE}) as n_both
    from joined_reviews""",
)
def text_coverage(w):
    return themes.text_coverage(themes.all_reviews(w.stg_orders, w.stg_order_reviews))


@query(
    "text_coverage_by_month",
    f"""select strftime(order_purchase_timestamp, '%Y-%m') as mois, count(*) as total,
        count(*) filter (where {_HAS_TITLE} or {_HAS_MESSAGE}) as avec_texte,
        round(100.0 * count(*) filter (where {_HAS_TITLE} or {_HAS_MESSAGE}) / count(*), 1) as pct
    from joined_reviews group by 1""",
)
def text_coverage_by_month(w):
    return themes.text_coverage_by_month(themes.all_reviews(w.stg_orders, w.stg_order_reviews))


def _length_sql(column: str, filled: str) -> str:
    words = rf"len(regexp_split_to_array(regexp_replace({column}, '^\s+|\s+$', '', 'g'), '\s+'))"
    return f"""select '{column}' as field, round(avg({words}), 6) as mean_words,
        min({words})::integer as min_words, max({words})::integer as max_words
        from joined_reviews where {filled}"""


@query(
    "text_length_stats",
    _length_sql("review_comment_message", _HAS_MESSAGE)
    + " union all "
    + _length_sql("review_comment_title", _HAS_TITLE),
)
def text_length_stats(w):
    joined = themes.all_reviews(w.stg_orders, w.stg_order_reviews)
    return rounded(themes.text_length_stats(joined), 6, "mean_words")


@query(
    "text_coverage_by_score",
    f"""select review_score, count(*) as n_reviews, count(*) filter (where {_HAS_MESSAGE}) as n_message,
        round(100.0 * count(*) filter (where {_HAS_MESSAGE}) / count(*), 1) as pct
    from joined_reviews group by 1""",
)
def text_coverage_by_score(w):
    return themes.text_coverage_by_score(themes.all_reviews(w.stg_orders, w.stg_order_reviews))
