"""Totals, yearly and grouped statistics, correlations and box statistics.

Sums over low-cardinality keys combine map-side, so a hot key costs no more
than any other: each task sends one row per group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.functions.formats import literal, mixed
from salescope.functions.quantiles import BUCKET_VALUES, GROUP_ROWS, QUARTILES, describe
from salescope.functions.stats import mileage_price_label, price_sales_label, safe_corr
from salescope.schema import drop_null_keys, require_numeric, whole_columns
from salescope.sources.staging import materialize

GLOBAL_LABEL = "Global"


def units_sum(column: str = "sales_volume"):
    """Sum of units; a group whose units are all missing sums to 0."""
    return F.coalesce(F.sum(column), F.lit(0))


def with_revenue(df: DataFrame, price: str = "price_usd", units: str = "sales_volume") -> DataFrame:
    return df.withColumn("revenue", F.col(units) * F.col(price))


def totals(df: DataFrame) -> DataFrame:
    """Revenue, units and the first and last year."""
    return with_revenue(df).agg(
        F.coalesce(F.sum("revenue"), F.lit(0.0)).alias("total_revenue"),
        units_sum().alias("total_units"),
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"),
    )


def units_by(df: DataFrame, keys: Sequence[str], units: str = "sales_volume") -> DataFrame:
    """Units per group of the given keys."""
    return drop_null_keys(df, keys).groupBy(*keys).agg(units_sum(units).alias("units"))


def yearly_units(df: DataFrame) -> DataFrame:
    """Units by year, ascending."""
    return units_by(df, ["year"]).orderBy("year")


def yearly_region_units(df: DataFrame) -> DataFrame:
    return units_by(df, ["year", "region"]).orderBy("year", "region")


def global_series(df: DataFrame, group: str = "region") -> DataFrame:
    """Yearly units of all rows, labelled as a group of their own."""
    return units_by(df, ["year"]).withColumn(group, F.lit(GLOBAL_LABEL))


def union_global(df: DataFrame, group: str = "region") -> DataFrame:
    """Regional yearly units followed by a global series, as a union."""
    return units_by(df, ["year", group]).unionByName(global_series(df, group))


def rollup_global(df: DataFrame, group: str = "region") -> DataFrame:
    """The same table from one pass, with a flag for the global rows.

    Rows without a region count in the global series only.
    """
    sets = (
        drop_null_keys(df, ["year"])
        .groupingSets([["year", group], ["year"]], "year", group)
        .agg(F.grouping(group).alias("rolled"), units_sum().alias("units"))
    )
    is_global = F.col("rolled") == 1
    return sets.where(is_global | F.col(group).isNotNull()).select(
        "year",
        F.when(is_global, GLOBAL_LABEL).otherwise(F.col(group)).alias(group),
        "units",
        is_global.alias("is_global"),
    )


def stats_column(df: DataFrame, column: str) -> DataFrame:
    """Mean, median, std, min, max, quartiles, count and missing of one column."""
    return stats_columns(df, [column]).drop("column")


def stats_columns(
    df: DataFrame,
    columns: Sequence[str],
    group_rows: int = GROUP_ROWS,
    bucket_values: int = BUCKET_VALUES,
) -> DataFrame:
    """The same for several columns in one go, one row each. What is larger than
    ``group_rows`` is selected from buckets (see :mod:`salescope.functions.quantiles`)."""
    return describe(df, columns, group_rows=group_rows, bucket_values=bucket_values).select(
        "column",
        "mean",
        F.col("q50").alias("median"),
        "std",
        "min",
        "max",
        "q25",
        "q50",
        "q75",
        F.col("n").alias("count"),
        "missing",
    )


def stats_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The statistics of columns as text, one row each: counts, and the ends of a column
    of whole numbers, plainly; all other figures with commas and two decimals."""
    whole = whole_columns(df)
    stats = stats_columns(df, columns)

    def shown(name: str) -> str:
        fraction, plain = mixed(f"`{name}`", False), mixed(f"`{name}`", True)
        if name in ("count", "missing"):
            return plain
        named = ", ".join(literal(c) for c in columns if c in whole)
        return f"IF(column IN ({named}), {plain}, {fraction})" if named and name in ("min", "max") else fraction

    return stats.select("column", *[F.expr(shown(c)).alias(c) for c in stats.columns if c != "column"])


def stats_grouped(
    df: DataFrame,
    column: str,
    by: Sequence[str],
    order_by: str | None = None,
    group_rows: int = GROUP_ROWS,
    bucket_values: int = BUCKET_VALUES,
) -> DataFrame:
    """Mean, median, std, min, max and count of a column per group.

    ``order_by`` names a column that sorts the groups (such as a bin's
    number); it must be constant within a group.
    """
    keys = [*by, order_by] if order_by else list(by)
    return (
        describe(df, [column], keys, {"median": 0.5}, group_rows=group_rows, bucket_values=bucket_values)
        .select(*keys, "mean", "median", "std", "min", "max", F.col("n").alias("count"))
        .orderBy(order_by or list(by))
    )


def fuel_transmission(df: DataFrame) -> DataFrame:
    """Mean price, units and mean engine size by transmission and fuel, without gaps."""
    keys = ["transmission", "fuel_type"]
    return (
        drop_null_keys(df, keys)
        .groupBy(*keys)
        .agg(
            F.avg("price_usd").alias("avg_price_usd"),
            units_sum().alias("total_sales_volume"),
            F.avg("engine_size_l").alias("avg_engine_size"),
        )
        .dropna("any")
    )


def corr_price_sales(df: DataFrame) -> DataFrame:
    return df.agg(safe_corr(F.col("price_usd"), F.col("sales_volume")).alias("correlation")).select(
        "correlation", price_sales_label(F.col("correlation")).alias("label")
    )


def corr_mileage_price(df: DataFrame) -> DataFrame:
    return df.agg(safe_corr(F.col("mileage_km"), F.col("price_usd")).alias("correlation")).select(
        "correlation", mileage_price_label(F.col("correlation")).alias("label")
    )


def box_stats(
    df: DataFrame,
    column: str,
    by: Sequence[str],
    group_rows: int = GROUP_ROWS,
    bucket_values: int = BUCKET_VALUES,
) -> DataFrame:
    """Quartiles, range, count and whiskers per cell.

    A whisker ends at the last value within 1.5 interquartile ranges of the box: the
    least and the greatest value between the fences, which combine map-side. A cell
    without values beyond its fences has them at its ends; its rows are not read again.
    """
    require_numeric(df, column)
    by = list(by)
    points = df.dropna(subset=[*by, column]).select(*by, F.col(column).cast("double").alias("value"))
    rows = points.count()
    boxes = materialize(
        describe(points, ["value"], by, rows=rows, group_rows=group_rows, bucket_values=bucket_values).select(
            *by, F.col("n").alias("count"), "min", "q25", F.col("q50").alias("median"), "q75", "max"
        ),
        "boxes",
    )
    reach = (F.col("q75") - F.col("q25")) * 1.5
    low, high = F.col("q25") - reach, F.col("q75") + reach
    whole = (F.col("min") >= low) & (F.col("max") <= high)
    fences = boxes.where(~whole).select(*by, "q25", "q75")  # a written table of small rows: no hint needed
    inside = F.col("value").between(low, high)
    whiskers = (
        points.join(fences, by)
        .groupBy(*by)
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
        )
    )
    ends = boxes.where(whole).select(*by, F.col("min").alias("whisker_low"), F.col("max").alias("whisker_high"))
    return boxes.join(whiskers.unionByName(ends), by)


def box_points(df: DataFrame) -> DataFrame:
    """The rows that have all that a price box needs."""
    return df.dropna(subset=["engine_size_l", "price_usd", "fuel_type"])


def chart_box(
    df: DataFrame, group_rows: int = GROUP_ROWS, bucket_values: int = BUCKET_VALUES
) -> DataFrame:
    """Price boxes by whole engine size and fuel."""
    return box_stats(box_points(df), "price_usd", ["engine_size", "fuel_type"], group_rows, bucket_values)
