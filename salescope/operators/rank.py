"""Top-n, per-group leaders and the order of chart series.

Ties always go to the smaller key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salescope.operators.aggregate import units_by, units_sum
from salescope.schema import drop_null_keys, numeric_columns
from salescope.sources.staging import materialize

TOP_DIMENSIONS = ("region", "model", "engine_size_l", "fuel_type", "color")


def top_n(df: DataFrame, column: str, metric: str = "sales_volume", n: int = 3) -> DataFrame:
    """The n items with the largest sum of the metric."""
    return units_by(df, [column], metric).orderBy(F.desc("units"), F.asc(column)).limit(n)


def top_dimensions(df: DataFrame, columns: Sequence[str] = TOP_DIMENSIONS, n: int = 3) -> DataFrame:
    """``top_n`` of several columns from one scan, as (dimension, item, units, position)."""
    sets = df.groupingSets([[c] for c in columns], *columns).agg(
        *[F.grouping(c).alias(f"{c}__rolled") for c in columns], units_sum().alias("units")
    )
    numeric = numeric_columns(df)
    dimension, item, key = F.lit(None), F.lit(None), F.lit(None)
    for c in columns:
        here = F.col(f"{c}__rolled") == 0
        dimension = F.when(here, c).otherwise(dimension)
        item = F.when(here, F.col(c).cast("string")).otherwise(item)
        if c in numeric:
            # Numbers sort as numbers on ties.
            key = F.when(here, F.col(c).cast("double")).otherwise(key)
    named = sets.select(dimension.alias("dimension"), item.alias("item"), key.alias("key"), "units")
    order = Window.partitionBy("dimension").orderBy(F.desc("units"), "key", "item")
    return (
        named.where("item IS NOT NULL")
        .withColumn("position", F.row_number().over(order))
        .where(F.col("position") <= n)
        .drop("key")
    )


def rank_groups(df: DataFrame, column: str = "region") -> DataFrame:
    """All groups by units, largest first."""
    return units_by(df, [column]).orderBy(F.desc("units"), F.asc(column))


def top_per_group(
    df: DataFrame, group: str, column: str, metric: str = "sales_volume", n: int = 1
) -> DataFrame:
    """Within each group, the n items with the largest sum of the metric."""
    order = Window.partitionBy(group).orderBy(F.desc("units"), F.asc(column))
    return (
        units_by(df, [group, column], metric)
        .withColumn("position", F.row_number().over(order))
        .where(F.col("position") <= n)
    )


def group_profile(
    df: DataFrame,
    group: str = "region",
    leaders: Sequence[str] = ("model", "fuel_type", "transmission"),
) -> DataFrame:
    """Per group: units, mean price, mean mileage and the leading item of each kind.

    One scan computes the group rows and the (group, item) rows together as
    grouping sets; the leaders are picked from those small rows.
    """
    keyed = drop_null_keys(df, [group])
    sets = keyed.groupingSets([[group], *[[group, c] for c in leaders]], group, *leaders).agg(
        *[F.grouping(c).alias(f"{c}__rolled") for c in leaders],
        units_sum().alias("units"),
        F.avg("price_usd").alias("avg_price"),
        F.avg("mileage_km").alias("avg_mileage"),
    )
    kind, item = F.lit(group), F.lit(None)
    for c in leaders:
        here = F.col(f"{c}__rolled") == 0
        kind = F.when(here, c).otherwise(kind)
        item = F.when(here, F.col(c).cast("string")).otherwise(item)
    rows = sets.select(group, kind.alias("kind"), item.alias("item"), "units", "avg_price", "avg_mileage")
    order = Window.partitionBy(group, "kind").orderBy(F.desc("units"), F.asc("item"))
    leading = (
        rows.where((F.col("kind") == group) | F.col("item").isNotNull())
        .withColumn("position", F.row_number().over(order))
        .where("position = 1")
    )
    whole = F.col("kind") == group
    return (
        leading.groupBy(group)
        .agg(
            F.max(F.when(whole, F.col("units"))).alias("total_units"),
            F.max(F.when(whole, F.col("avg_price"))).alias("avg_price"),
            F.max(F.when(whole, F.col("avg_mileage"))).alias("avg_mileage"),
            *[F.max(F.when(F.col("kind") == c, F.col("item"))).alias(f"top_{c}") for c in leaders],
        )
        .orderBy(F.desc("total_units"), F.asc(group))
    )


def with_category_order(series: DataFrame, group: str = "region") -> DataFrame:
    """``series_order`` of a yearly table: by first year and name, global rows last.

    The table has one row per point of a line chart, so one task can order it.
    """
    first_year = F.min("year").over(Window.partitionBy(group, "is_global"))
    order = Window.orderBy("is_global", "first_year", group)
    return (
        series.withColumn("first_year", first_year)
        .withColumn("series_order", F.dense_rank().over(order))
        .drop("first_year")
    )


def category_order(series: DataFrame, group: str = "region") -> DataFrame:
    """One row per series of a yearly table, with its place in the chart."""
    return with_category_order(series, group).select(group, "is_global", "series_order").distinct()


def semi_join_top(df: DataFrame, column: str = "model", n: int = 10) -> DataFrame:
    """Rows whose item is among the top n; at most n keys are broadcast."""
    return df.join(F.broadcast(top_n(df, column, n=n).select(column)), column, "left_semi")


def top_model_fuel_years(df: DataFrame, n: int = 10) -> DataFrame:
    """Units by (year, model, fuel) of the top n models, with the model's position.

    The fact table is scanned once: ranking and details both read the written
    group sums. At most n rows are broadcast and numbered.
    """
    sums = materialize(
        drop_null_keys(df, ["model"]).groupBy("year", "model", "fuel_type").agg(units_sum().alias("units")),
        "model-fuel-years",
    )
    best = top_n(sums, "model", metric="units", n=n)
    positions = best.select(
        "model", F.row_number().over(Window.orderBy(F.desc("units"), F.asc("model"))).alias("model_order")
    )
    return drop_null_keys(sums, ["year", "fuel_type"]).join(F.broadcast(positions), "model")
