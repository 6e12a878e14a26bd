"""Yearly series, growth rates and trend summaries.

A series has one entry per present year of an item, so gathering the entries
of one item into an array is bounded by the span of years, not by the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salescope.functions.formats import joined, money, percent, text, thousands
from salescope.functions.stats import cagr, change, growth, trend_label
from salescope.operators.aggregate import units_sum
from salescope.schema import drop_null_keys


def yearly_series(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Units and row-mean price per (keys, year)."""
    by = [*keys, "year"]
    return (
        drop_null_keys(df, by)
        .groupBy(*by)
        .agg(units_sum().alias("units"), F.avg("price_usd").alias("avg_price"))
    )


def cagr_global(df: DataFrame) -> DataFrame:
    """Growth per present year of all units, with its label."""
    ends = (
        yearly_series(df)
        .agg(
            F.min_by("units", "year").alias("first_units"),
            F.max_by("units", "year").alias("last_units"),
            F.count("year").alias("years"),
        )
        .withColumn("cagr", cagr(F.col("first_units"), F.col("last_units"), F.col("years")))
    )
    return ends.withColumn("trend", trend_label(F.col("cagr")))


def item_series(df: DataFrame, item: str, n: int | None = None) -> DataFrame:
    """Per item its total units and its yearly series, optionally the top n only.

    The top n come from the same small (item, year) rows as the series, so the
    fact table is scanned once and nothing is joined back. Rows without a year
    count in the total but have no place in the series.
    """
    entry = F.struct("year", "units", "avg_price")
    items = (
        drop_null_keys(df, [item])
        .groupBy(item, "year")
        .agg(units_sum().alias("units"), F.avg("price_usd").alias("avg_price"))
        .groupBy(item)
        .agg(
            F.sum("units").alias("total_units"),
            F.sort_array(F.collect_list(F.when(F.col("year").isNotNull(), entry))).alias("series"),
        )
    )
    if n is not None:
        items = items.orderBy(F.desc("total_units"), F.asc(item)).limit(n)
    return items.where(F.size("series") > 0)


def trend_yearly(df: DataFrame, item: str, n: int = 3) -> DataFrame:
    """Units and mean price per year of the top n items."""
    return item_series(df, item, n).select(item, F.inline("series"))


def with_summary(items: DataFrame) -> DataFrame:
    """First and last year's price and the growth in between, from ``series``."""
    first, last = F.get("series", F.lit(0)), F.get("series", F.size("series") - 1)
    return items.withColumns(
        {
            "growth": growth(first["units"], last["units"], F.size("series")),
            "first_price": first["avg_price"],
            "last_price": last["avg_price"],
        }
    )


def trend_summary(df: DataFrame, item: str, n: int = 3) -> DataFrame:
    """Per top item: growth over the whole span, first and last year's mean price."""
    return with_summary(item_series(df, item, n)).select(
        item, "total_units", "growth", "first_price", "last_price"
    )


# The text of a trend and of its yearly entries.
SUMMARY_FORMAT = "Growth: %s | Start_Year_Price: %s | End_Year_Price: %s"
ENTRY_FORMAT = "Y%s: S%s/P%s"
ENTRY_SEPARATOR = " | "


def trend_text(items: DataFrame) -> DataFrame:
    """``summary`` and ``breakdown`` text per item, from ``series``."""
    entry = text(ENTRY_FORMAT, "CAST(x.year AS STRING)", thousands("x.units"), money("x.avg_price"))
    summary = text(
        SUMMARY_FORMAT, percent("growth", signed=True), money("first_price"), money("last_price")
    )
    return with_summary(items).withColumns(
        {
            "summary": F.expr(summary),
            "breakdown": F.expr(joined("series", entry, ENTRY_SEPARATOR)),
        }
    )


def trend_breakdown(df: DataFrame, item: str, n: int = 3) -> DataFrame:
    """Per top item its summary line and its yearly breakdown line."""
    return trend_text(item_series(df, item, n)).select(item, "summary", "breakdown")


def with_yoy(series: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Growth against the previous present year; NULL in the first one.

    Takes a yearly table: a partition holds one item's years. Without keys it
    is the whole table, which has one row per year.
    """
    order = Window.partitionBy(*keys).orderBy("year")
    return series.withColumn("yoy", change(F.lag("units").over(order), F.col("units")))
