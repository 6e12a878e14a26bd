"""Column expressions: binning, correlation, growth and labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Thresholds and labels of growth and correlation.
TREND_THRESHOLD = 0.05
PRICE_SALES_THRESHOLD = 0.4
MILEAGE_PRICE_STRONG = -0.6
MILEAGE_PRICE_WEAK = -0.2


def bin_right_closed(value: Column, edges: Sequence[float], labels: Sequence) -> Column:
    """Label of the interval (low, high] holding the value; NULL outside all of them."""
    if len(labels) != len(edges) - 1:
        raise ValueError("there must be one label per interval")
    out = F.when(value <= edges[0], None)
    for high, label in zip(edges[1:], labels):
        out = out.when(value <= high, F.lit(label))
    return out


def safe_corr(x: Column, y: Column) -> Column:
    """Pearson correlation over complete pairs; NULL when either side is constant.

    The built-in ``corr`` raises on a constant column under ANSI mode.
    """
    paired_x, paired_y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    return F.try_divide(
        F.covar_pop(x, y), F.stddev_pop(paired_x) * F.stddev_pop(paired_y)
    )


def price_sales_label(r: Column) -> Column:
    return (
        F.when(r < -PRICE_SALES_THRESHOLD, "negative")
        .when(r > PRICE_SALES_THRESHOLD, "positive")
        .otherwise("neutral")
    )


def mileage_price_label(r: Column) -> Column:
    return (
        F.when(r < MILEAGE_PRICE_STRONG, "strong negative")
        .when(r < MILEAGE_PRICE_WEAK, "negative")
        .otherwise("neutral")
    )


def growth(first: Column, last: Column, periods: Column) -> Column:
    """last/first - 1, or 0 with a single period or a first value that is not positive."""
    return F.when((periods > 1) & (first > 0), F.try_divide(last, first) - 1).otherwise(F.lit(0.0))


def cagr(first: Column, last: Column, periods: Column) -> Column:
    """Yearly growth over ``periods`` present years, so periods - 1 steps."""
    steps = (periods - 1).cast("double")
    ratio = F.try_divide(last, first)
    return F.when(
        (periods > 1) & (first > 0), F.pow(ratio, F.try_divide(F.lit(1.0), steps)) - 1
    ).otherwise(F.lit(0.0))


def change(previous: Column, current: Column) -> Column:
    """Relative change against a previous value; NULL without a usable one."""
    return F.try_divide(current, previous) - 1


def trend_label(rate: Column) -> Column:
    return (
        F.when(rate > TREND_THRESHOLD, "increasing")
        .when(rate < -TREND_THRESHOLD, "decreasing")
        .otherwise("stable")
    )
