"""Text expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from waybill.fixed_values import (
    SENTIMENT_NEGATIVE,
    SENTIMENT_NEUTRAL,
    SENTIMENT_POSITIVE,
    THEME_OTHER,
)

# Unicode classes and boundaries; "." stops at "\n" only.
PATTERN_FLAGS = "(?Ud)"
WORD_PATTERN = r"[\p{L}\p{N}_]{2,}"


def strip(text: Column) -> Column:
    """Remove every kind of surrounding whitespace, not only spaces."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def normalise(text: Column) -> Column:
    return strip(F.lower(F.coalesce(text, F.lit(""))))


def clean_text(title: Column, message: Column) -> Column:
    """Title and message, lower-cased and trimmed, as one text ('' when both are empty)."""
    return strip(F.concat(normalise(title), F.lit(" "), normalise(message)))


def is_filled(text: Column) -> Column:
    return text.isNotNull() & (strip(text) != "")


def word_count(text: Column) -> Column:
    return F.size(F.split(strip(text), r"(?U)\s+"))


def sentiment_from_score(score: Column) -> Column:
    """NULL score -> NULL sentiment."""
    return (
        F.when(score <= 2, SENTIMENT_NEGATIVE)
        .when(score == 3, SENTIMENT_NEUTRAL)
        .when(score.isNotNull(), SENTIMENT_POSITIVE)
    )


def matches_any(text: Column, patterns: Sequence[str]) -> Column:
    """True when one of the patterns is found; one regex pass per theme."""
    return text.rlike(PATTERN_FLAGS + "|".join(f"(?:{p})" for p in patterns))


def rule_label(text: Column, themes: Mapping[str, Sequence[str]]) -> Column:
    """First theme, in mapping order, with a matching pattern; else the catch-all."""
    label = F.lit(THEME_OTHER)
    for theme, patterns in reversed(list(themes.items())):
        label = F.when(matches_any(text, patterns), F.lit(theme)).otherwise(label)
    return label


def words(text: Column) -> Column:
    """Lower-cased words of two or more letters, digits or underscores."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"({WORD_PATTERN})"), F.lit(1))


def word_ngrams(tokens: Column, longest: int) -> Column:
    """All n-grams of 1..``longest`` consecutive tokens, space separated."""

    def of_length(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.size(tokens) - (n - 1))
        # Single elements, as ``slice`` copies the whole array each time: a square of a text's length.
        grams = F.transform(starts, lambda start: F.concat_ws(" ", *[F.get(tokens, start + (k - 1)) for k in range(n)]))
        return F.when(F.size(tokens) >= n, grams).otherwise(F.array().cast("array<string>"))

    return F.concat(tokens, *[of_length(n) for n in range(2, longest + 1)])
