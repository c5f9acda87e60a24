"""Readable names for codes. The name tables are small constants, so they are
folded into the plan as literals instead of being joined."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from waybill import fixed_values as fixed


def label_or_raw(code: Column, names: Mapping[str, str]) -> Column:
    """The name of a code, or the code itself when it has none."""
    pairs = [F.lit(part) for pair in names.items() for part in pair]
    return F.coalesce(F.create_map(*pairs)[code], code)


def state_label(code: Column) -> Column:
    return label_or_raw(code, fixed.STATE_NAMES)


def feature_label(name: Column) -> Column:
    return label_or_raw(name, fixed.FEATURE_LABELS)


def theme_label(theme: Column) -> Column:
    return label_or_raw(theme, fixed.THEME_LABELS)


def direction_label(direction: Column) -> Column:
    return label_or_raw(direction, fixed.DIRECTION_LABELS)


def category_label(category: Column) -> Column:
    """Unknown categories are made readable: underscores out, first letter up."""
    spaced = F.regexp_replace(category, "_", " ")
    readable = F.concat(F.upper(F.substring(spaced, 1, 1)), F.lower(F.substring(spaced, 2, 1 << 30)))
    pairs = [F.lit(part) for pair in fixed.CATEGORY_LABELS.items() for part in pair]
    return F.coalesce(F.create_map(*pairs)[category], readable)


def tier_label(tier: Column) -> Column:
    return F.when(
        tier.startswith(fixed.RISK_TIER_EXTREME_PREFIX), F.lit(fixed.TIER_LABEL_EXTREME)
    ).otherwise(label_or_raw(tier, fixed.TIER_LABELS))


def month_label(year: Column, month: Column) -> Column:
    return F.concat_ws("-", year.cast("string"), F.lpad(month.cast("string"), 2, "0"))
