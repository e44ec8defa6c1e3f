"""Conditional columns of the indicator and place models."""

from functools import reduce

from pyspark.sql import Column, functions as F

from vereda import presets

_COMPARE = {
    ">": lambda left, right: left > right,
    ">=": lambda left, right: left >= right,
    "<": lambda left, right: left < right,
    "<=": lambda left, right: left <= right,
}


def first_match(cases, default) -> Column:
    """``CASE WHEN`` over (condition, value) pairs; a null condition falls through."""
    (condition, value), *rest = cases
    chain = reduce(
        lambda built, case: built.when(case[0], F.lit(case[1])),
        rest,
        F.when(condition, F.lit(value)),
    )
    return chain.otherwise(F.lit(default))


def _above(value, bounds, default):
    return first_match([(value > F.lit(float(bound)), label) for bound, label in bounds], default)


def classify_series(name: Column, categories=None, default=presets.OTHER_CATEGORY) -> Column:
    """Category of a series name."""
    by_label = {}
    for series, label in (categories or presets.CATEGORIES).items():
        by_label.setdefault(label, []).append(series)
    return first_match([(name.isin(names), label) for label, names in by_label.items()], default)


def size_bucket(population: Column, bounds=presets.SIZE_BOUNDS, default=presets.SMALLEST_SIZE):
    """Size label of a place."""
    return _above(population, bounds, default)


def relevance_score(population: Column, bounds=presets.SCORE_BOUNDS, default=presets.LOWEST_SCORE):
    """Relevance score of a place, 1 to 5."""
    return _above(population, bounds, default)


def market_profile(region: Column, profiles=None, default=presets.OTHER_PROFILE) -> Column:
    """Market profile of a region."""
    pairs = (profiles or presets.PROFILES).items()
    return first_match([(region == F.lit(name), label) for name, label in pairs], default)


def interpretation(series: Column, rules=presets.MARKET_RULES, default=presets.NEUTRAL) -> Column:
    """Label of the first rule that holds for the row."""
    cases = [
        ((series == F.lit(name)) & _COMPARE[sign](F.col(column), F.lit(bound)), label)
        for name, column, sign, bound, label in rules
    ]
    return first_match(cases, default)


def above_target_flag(series: Column, year_to_date: Column, name=presets.TARGET_SERIES,
                      target=presets.TARGET) -> Column:
    """True where the target series has gone past the target, never null."""
    over = (series == F.lit(name)) & (year_to_date > F.lit(target))
    return F.when(over, F.lit(True)).otherwise(F.lit(False))


def trend_3(value: Column, previous: Column, before: Column) -> Column:
    """Rising or falling against both earlier points, steady otherwise."""
    return first_match(
        [
            ((value > previous) & (value > before), presets.RISING),
            ((value < previous) & (value < before), presets.FALLING),
        ],
        presets.STEADY,
    )


def abs_change(value: Column, previous: Column) -> Column:
    return F.round(value - previous, 4)


def pct_change(value: Column, previous: Column) -> Column:
    """Change in percent of the previous value's size, null after a zero."""
    return F.round(F.try_divide(value - previous, F.abs(previous)) * F.lit(100.0), 4)


def severity_bucket(score: Column, anomalous: Column, bounds=presets.SEVERITIES,
                    normal=presets.NORMAL) -> Column:
    """Severity of an anomalous row by its 0-100 score; other rows are normal."""
    graded = F.when(~F.coalesce(anomalous, F.lit(False)), F.lit(normal))
    lowest = score >= F.lit(0.0)
    for bound, label in bounds:
        graded = graded.when(lowest & (score <= F.lit(bound)), F.lit(label))
    return graded


def composite_score(value_percentile: Column, score_percentile: Column,
                    value_weight=presets.VALUE_WEIGHT, score_weight=presets.SCORE_WEIGHT):
    """Weighted mean of two percentiles, unrounded."""
    return value_percentile * F.lit(value_weight) + score_percentile * F.lit(score_weight)
