"""Review texts: cleaning, rules, weights, insights."""

import math
import re
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from waybill import fixed_values as fixed
from waybill.functions import text
from waybill.operators import softmax
from waybill.operators.tfidf import tfidf
from waybill.plans import themes

SENTENCES = [
    "Atraso na entrega", "muito atrasado", "o produto demorou demais", "não recebi dentro do prazo",
    "prazo de entrega venceu", "Faltou um item", "só veio um", "pedi dois e recebi um",
    "não recebi o pedido completo", "Produto errado", "recebi outro modelo", "cor diferente da foto",
    "chegou quebrado", "atrasou e chegou quebrado", "péssima qualidade", "tá solta a peça",
    "adorei tudo", "xédano nada", "dano na caixa", "pedi algo\ne recebi outra coisa", "",
    "chegaram apenas 3", "veio com defeito", "embalagem ruim", "SÓ RECEBI metade",
]


def python_label(sentence):
    for theme, patterns in fixed.THEME_PATTERNS.items():
        if any(re.search(p, sentence) for p in patterns):
            return theme
    return fixed.THEME_OTHER


def test_rules_match_python_regexes(spark):
    df = spark.createDataFrame([(s.lower(),) for s in SENTENCES], "t string")
    got = df.select("t", text.rule_label(F.col("t"), fixed.THEME_PATTERNS).alias("m")).collect()
    for r in got:
        assert r.m == python_label(r.t), r.t
    assert len({r.m for r in got}) == 5


def test_every_fixed_pattern_compiles(spark):
    both = {**fixed.THEME_PATTERNS, **fixed.EXPLORED_THEME_PATTERNS}
    df = spark.createDataFrame([("a cor é bem diferente",)], "t string")
    counts = {r.motif: r.n_independent for r in themes.rule_counts(df, "t", both).collect()}
    assert counts["aspect_mismatch"] == 1 and counts["produit_incorrect"] == 0
    assert sum(len(p) for p in fixed.THEME_PATTERNS.values()) == 72


def test_clean_text_is_pythons(spark):
    pairs = [(None, None), ("  A\t", None), (None, "\n B \n c "), (" X ", " Y "), ("   ", "  ")]
    df = spark.createDataFrame(pairs, "a string, b string")
    low = lambda s: (s or "").lower().strip()
    for r in df.select("a", "b", text.clean_text(F.col("a"), F.col("b")).alias("c")).collect():
        assert r.c == (low(r.a) + " " + low(r.b)).strip()


def test_sentiment(spark):
    df = spark.createDataFrame([(s,) for s in (1, 2, 3, 4, 5, None)], "s int")
    got = [r[0] for r in df.select(text.sentiment_from_score(F.col("s"))).collect()]
    assert got == ["negatif", "negatif", "neutre", "positif", "positif", None]


def brute_tfidf(docs, min_df, max_df):
    counts = {}
    for d, t in docs.items():
        words = re.findall(r"\w\w+", t.lower())
        counts[d] = Counter(words + [" ".join(p) for p in zip(words, words[1:])])
    df = Counter(t for c in counts.values() for t in c)
    kept = {t: n for t, n in df.items() if min_df <= n <= max_df * len(docs)}
    out = {}
    for d, c in counts.items():
        raw = {
            t: (1 + math.log(n)) * (math.log((1 + len(docs)) / (1 + kept[t])) + 1)
            for t, n in c.items() if t in kept
        }
        length = math.sqrt(sum(v * v for v in raw.values()))
        out.update({(d, t): v / length for t, v in raw.items()})
    return out


def test_tfidf_matches_brute_force(spark):
    docs = {
        i: s for i, s in enumerate(
            ["o produto chegou quebrado", "produto chegou atrasado produto", "chegou bem o produto",
             "não chegou", "produto chegou produto chegou sim", "x", "péssimo péssimo atendimento"]
        )
    }
    df = spark.createDataFrame(list(docs.items()), "id int, t string")
    for min_df, max_df in ((1, 1.0), (2, 0.9), (3, 0.8)):
        got = {(r.id, r.term): r.weight for r in tfidf(df, "id", "t", 2, min_df, max_df).collect()}
        want = brute_tfidf(docs, min_df, max_df)
        assert got.keys() == want.keys()
        for key, value in want.items():
            assert got[key] == pytest.approx(value)


def reviewed(spark):
    rows = [
        (1, 1, "atraso enorme"), (2, 2, "nada a dizer"), (3, 2, ""), (4, 5, "chegou quebrado"),
        (5, None, ""), (6, 3, "lento"),
    ]
    df = spark.createDataFrame(rows, "order_id int, review_score int, texte_nettoye string")
    return df.withColumn("sentiment", text.sentiment_from_score(F.col("review_score")))


def test_insights_cover_the_three_cases(spark):
    got = {r.order_id: r for r in themes.review_insights(reviewed(spark)).collect()}
    assert [got[i].motif for i in range(1, 7)] == [
        "retard_livraison", "autre", "non_applicable", "non_applicable", "non_applicable", "non_applicable",
    ]
    assert got[5].sentiment is None and got[5].texte_nettoye is None and got[3].texte_nettoye is None
    assert got[4].texte_nettoye == "chegou quebrado"


def test_classifier_only_fills_unlabelled_rows(spark):
    from waybill.session import observed

    # A session that has taken figures of a write can still send the model to its tasks.
    assert observed(spark.range(3), n=F.count("id"))[1]["n"] == 3
    base = [("atraso longo demais", "a"), ("produto quebrado ruim", "b")]
    rows = [(i, base[i % 2][0] + " palavra", base[i % 2][1]) for i in range(40)]
    train = spark.createDataFrame(rows, "order_id int, texte_nettoye string, motif_regle string")
    fitted = themes.ThemeClassifier().fit(train)
    assert fitted.classes == ["a", "b"]
    mixed = spark.createDataFrame(
        [(100, "produto quebrado ruim", "autre"), (101, "zzz", "autre"), (102, "produto quebrado ruim", "a")],
        train.schema,
    )
    got = {r.order_id: r.motif_final for r in themes.reclassified(mixed, fitted).collect()}
    assert got == {100: "b", 101: "autre", 102: "a"}
    nothing = themes.ThemeClassifier().fit(train.limit(2))
    got = {r.order_id: r.motif_final for r in themes.reclassified(mixed, nothing).collect()}
    assert got == {100: "autre", 101: "autre", 102: "a"}


def test_stratified_split_keeps_shares(spark):
    rows = [(i, "big" if i % 10 else "small") for i in range(500)]
    df = spark.createDataFrame(rows, "order_id int, l string")
    got = themes.stratified_split(df, "order_id", "l", 0.2, 7)
    unlabelled = df.withColumn("l", F.when(F.col("order_id") % 2 == 0, F.col("l")))
    assert themes.stratified_split(unlabelled, "order_id", "l", 0.2, 7).count() == 500
    counts = {(r.l, r.is_test): r["count"] for r in got.groupBy("l", "is_test").count().collect()}
    assert counts["big", True] == 90 and counts["small", True] == 10
    again = {r.order_id for r in themes.stratified_split(df, "order_id", "l", 0.2, 7).filter("is_test").collect()}
    assert again == {r.order_id for r in got.filter("is_test").collect()}


def test_ngrams_of_long_texts_take_no_square_of_their_length(spark):
    """Each n-gram reads its own words only: slices of an array copy all of it each time."""
    from waybill.functions.text import word_ngrams, words

    long = " ".join(f"w{i % 977}" for i in range(3000))
    df = spark.createDataFrame([(0, long), (1, "um dois tres"), (2, "um"), (3, ""), (4, None)], "k int, t string")
    grams = df.select("k", words(F.col("t")).alias("w")).select("k", word_ngrams(F.col("w"), 3).alias("g"))
    got = {r.k: r.g for r in grams.collect()}
    tokens = long.split()
    assert got[0] == [" ".join(tokens[i : i + n]) for n in (1, 2, 3) for i in range(len(tokens) - n + 1)]
    assert got[1] == ["um", "dois", "tres", "um dois", "dois tres", "um dois tres"]
    assert got[2] == ["um"] and got[3] == [] and got[4] is None
    assert "slice(" not in grams._jdf.queryExecution().analyzed().toString()


def test_classifier_of_more_terms_than_texts_keeps_nothing_by_term_on_the_driver(spark, monkeypatch):
    """The same probabilities either way; with repeated, null and wordless texts, and texts of unknown words only."""
    rng = np.random.default_rng(3)
    line = lambda kind: " ".join([f"{kind}{w}" for w in rng.integers(60, size=25)] + [f"w{w}" for w in rng.integers(90, size=25)])
    rows = [(i, line("ab"[i % 2]), "ab"[i % 2]) for i in range(60)] + [(7, line("a"), "a"), (None, line("a"), "a"), (61, None, "b"), (62, "!", "a")]
    train = spark.createDataFrame(rows, "order_id int, texte_nettoye string, motif_regle string")
    asked = train.unionByName(spark.createDataFrame([(90, "zz yy", "a")], train.schema))
    scored = lambda c: {(r.order_id, r.motif_regle): r.probabilities for r in c.probabilities(asked, ["motif_regle"]).collect()}

    def by_terms(*_):
        raise AssertionError("a vector over all terms on the driver")

    with monkeypatch.context() as m:
        m.setattr(themes, "fit_softmax", by_terms)
        fitted = themes.ThemeClassifier().fit(train)
    assert fitted.size > len(rows)
    held = [v for v in vars(fitted).values() if not isinstance(v, (str, int, type(train)))]
    assert max(len(v) for v in held) == len(fitted.classes) == 2
    found = scored(fitted)
    with monkeypatch.context() as m:
        m.setattr(themes, "fit_by_rows", lambda *given: SimpleNamespace(coefficients=(f := softmax.fit_softmax(*given)).table(train), intercepts=f.intercepts))
        want = scored(themes.ThemeClassifier().fit(train))
    assert found.keys() == want.keys() and len(found) == 65
    for key, p in found.items():
        assert p == pytest.approx(want[key], abs=1e-6) and sum(p) == pytest.approx(1.0)
    assert found[90, "a"] == pytest.approx(found[61, "b"])
