"""The four chart tables, ready to draw."""

from __future__ import annotations

from pyspark.sql import DataFrame

from salescope.operators.aggregate import chart_box, fuel_transmission, rollup_global
from salescope.operators.rank import top_model_fuel_years, with_category_order
from salescope.sources.sinks import write_table


def sales_trend(df: DataFrame) -> DataFrame:
    """Chart 1: units by year and region with the global line last."""
    return with_category_order(rollup_global(df)).orderBy("series_order", "year")


def top_models(df: DataFrame, n: int = 10) -> DataFrame:
    """Chart 2: units of the top models by year and fuel, models by total units."""
    return top_model_fuel_years(df, n).orderBy("year", "model_order", "fuel_type")


def price_elasticity(df: DataFrame) -> DataFrame:
    """Chart 3: mean price against units by fuel and transmission."""
    return fuel_transmission(df).orderBy("transmission", "fuel_type")


def engine_price(df: DataFrame) -> DataFrame:
    """Chart 4: price boxes by engine size and fuel, engine sizes ascending."""
    return chart_box(df).orderBy("engine_size", "fuel_type")


CHARTS = {
    "combined_sales_trend": sales_trend,
    "top_models_sales": top_models,
    "price_elasticity": price_elasticity,
    "engine_price_box": engine_price,
}


def write_charts(df: DataFrame, folder: str) -> list[str]:
    """Write each chart table under ``folder`` and return the paths."""
    paths = []
    for name, chart in CHARTS.items():
        path = f"{folder.rstrip('/')}/{name}"
        write_table(chart(df), path)
        paths.append(path)
    return paths
