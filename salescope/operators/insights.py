"""Market questions answered from small group sums of the fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salescope.functions.stats import cagr, change, price_sales_label, safe_corr
from salescope.operators.aggregate import (
    chart_box,
    fuel_transmission,
    rollup_global,
    units_by,
    units_sum,
)
from salescope.operators.rank import top_model_fuel_years, top_n
from salescope.operators.trends import item_series, trend_summary, with_yoy, yearly_series
from salescope.schema import drop_null_keys
from salescope.sources.staging import materialize


def yoy_global(df: DataFrame) -> DataFrame:
    """Units by year with growth against the year before."""
    return with_yoy(yearly_series(df).select("year", "units"))


def growth_top_bottom(df: DataFrame, group: str = "region", n: int = 3) -> DataFrame:
    """Growth per year, and in the latest year, of the n largest and n smallest groups."""
    first, last = F.get("series", F.lit(0)), F.get("series", F.size("series") - 1)
    before_last = F.get("series", F.size("series") - 2)["units"]
    groups = item_series(df, group).select(
        group,
        "total_units",
        cagr(first["units"], last["units"], F.size("series")).alias("cagr"),
        change(before_last, last["units"]).alias("latest_yoy"),
    )

    def side(name: str, total) -> DataFrame:
        # At most n rows are left when they are numbered.
        order = Window.orderBy(total, F.asc(group))
        return (
            groups.orderBy(total, F.asc(group))
            .limit(n)
            .select(F.lit(name).alias("side"), F.row_number().over(order).alias("position"), "*")
        )

    return side("top", F.desc("total_units")).unionByName(side("bottom", F.asc("total_units")))


def top_5_models(df: DataFrame) -> DataFrame:
    return top_n(df, "model", n=5)


def top_price_pair(df: DataFrame, n: int = 1) -> DataFrame:
    """The (model, region) pair with the highest mean price."""
    keys = ["model", "region"]
    return (
        drop_null_keys(df, keys)
        .groupBy(*keys)
        .agg(F.avg("price_usd").alias("avg_price"))
        .orderBy(F.desc("avg_price"), *keys)
        .limit(n)
    )


def segment_underperformer(
    df: DataFrame, segment: str = "fuel_type", years: int = 2, n: int = 1
) -> DataFrame:
    """The segments with the weakest unit growth over the last ``years`` years."""
    series = materialize(units_by(df, [segment, "year"]), "segment-years")
    last_year = series.agg(F.max("year")).scalar()
    return (
        series.withColumn("last_year", last_year)
        .groupBy(segment)
        .agg(
            F.sum(F.when(F.col("year") == F.col("last_year") - years, F.col("units"))).alias("units_then"),
            F.sum(F.when(F.col("year") == F.col("last_year"), F.col("units"))).alias("units_now"),
        )
        .withColumn("growth", change(F.col("units_then"), F.col("units_now")))
        .where("growth IS NOT NULL")
        .orderBy(F.asc("growth"), F.asc(segment))
        .limit(n)
    )


def corr_in_top_segment(df: DataFrame, segment: str = "fuel_type") -> DataFrame:
    """Price-units correlation in the segment with most units, from one pass."""
    return (
        drop_null_keys(df, [segment])
        .groupBy(segment)
        .agg(
            units_sum().alias("units"),
            safe_corr(F.col("price_usd"), F.col("sales_volume")).alias("correlation"),
        )
        .orderBy(F.desc("units"), F.asc(segment))
        .limit(1)
        .withColumn("label", price_sales_label(F.col("correlation")))
    )


def fuel_distribution(df: DataFrame, column: str = "fuel_type") -> DataFrame:
    """Units and share of all units by fuel type."""
    units = units_by(df, [column])
    return units.withColumn("share", F.try_divide(F.col("units"), units.agg(F.sum("units")).scalar()))


def fuel_momentum(df: DataFrame, column: str = "fuel_type", n: int = 1) -> DataFrame:
    """The fuel type that grew most in the latest year."""
    series = materialize(units_by(df, [column, "year"]), "fuel-years")
    return (
        with_yoy(series, [column])
        .where((F.col("year") == series.agg(F.max("year")).scalar()) & F.col("yoy").isNotNull())
        .orderBy(F.desc("yoy"), F.asc(column))
        .limit(n)
    )


def transmission_growth(df: DataFrame, column: str = "transmission", n: int = 2) -> DataFrame:
    """First-to-last-year growth per transmission."""
    return trend_summary(df, column, n).select(column, "total_units", "growth")


def region_price_premium(df: DataFrame, group: str = "region") -> DataFrame:
    """Mean price per region against the mean of all rows, in percent.

    The sums per region are written, so the table is read once for both means.
    """
    sums = materialize(
        df.groupBy(group).agg(F.sum("price_usd").alias("total"), F.count("price_usd").alias("n")),
        "price-sums",
    )
    overall = sums.agg(F.try_divide(F.sum("total"), F.sum("n"))).scalar()
    priced = sums.where(F.col(group).isNotNull()).select(
        group, F.try_divide("total", "n").alias("avg_price"), overall.alias("global_price")
    )
    return priced.withColumn("premium_pct", change(F.col("global_price"), F.col("avg_price")) * 100)


def niche_pricing_power(df: DataFrame) -> DataFrame:
    """(model, region) cells that sell little but above the model's mean price.

    Little is fewer units than the mean cell. The model's mean weighs rows, so
    it is the sum of prices over the count of prices of its cells.
    """
    cells = (
        drop_null_keys(df, ["model", "region"])
        .groupBy("model", "region")
        .agg(
            units_sum().alias("units"),
            F.sum("price_usd").alias("total"),
            F.count("price_usd").alias("n"),
        )
    )
    cells = materialize(cells, "model-regions")
    model = Window.partitionBy("model")
    model_price = F.try_divide(F.sum("total").over(model), F.sum("n").over(model))
    return (
        cells.select(
            "model",
            "region",
            "units",
            F.try_divide("total", "n").alias("avg_price"),
            model_price.alias("model_price"),
        )
        .withColumn("premium", change(F.col("model_price"), F.col("avg_price")))
        .where((F.col("units") < cells.agg(F.avg("units")).scalar()) & (F.col("premium") > 0))
        .orderBy(F.desc("premium"), "model", "region")
    )


def region_vs_global(df: DataFrame, group: str = "region") -> DataFrame:
    """Yearly growth of each region minus that of all regions together."""
    series = with_yoy(rollup_global(df, group), ["is_global", group])
    # The rows of one year: one per region and the global one.
    year = Window.partitionBy("year")
    overall = F.max(F.when(F.col("is_global"), F.col("yoy"))).over(year)
    return (
        series.withColumn("global_yoy", overall)
        .where(~F.col("is_global"))
        .select("year", group, "units", "yoy", "global_yoy", (F.col("yoy") - F.col("global_yoy")).alias("lead"))
    )


def fuel_share_top_models(df: DataFrame, n: int = 10) -> DataFrame:
    """Share of each fuel in a top model's yearly units, and whether it dominates."""
    cell = Window.partitionBy("year", "model")
    order = cell.orderBy(F.desc("units"), F.asc("fuel_type"))
    return top_model_fuel_years(df, n).select(
        "year",
        "model",
        "fuel_type",
        "units",
        F.try_divide(F.col("units"), F.sum("units").over(cell)).alias("share"),
        (F.row_number().over(order) == 1).alias("dominant"),
    )


def elasticity_fit(df: DataFrame) -> DataFrame:
    """Correlation, slope and log-log slope of units on price over the cells of chart 3."""
    price, units = F.col("avg_price_usd"), F.col("total_sales_volume")
    positive = (price > 0) & (units > 0)
    log_price, log_units = F.ln(F.when(positive, price)), F.ln(F.when(positive, units))
    return fuel_transmission(df).agg(
        safe_corr(price, units).alias("correlation"),
        F.regr_slope(units, price).alias("slope"),
        F.regr_slope(log_units, log_price).alias("log_slope"),
    )


def median_price_engine_fuel(df: DataFrame) -> DataFrame:
    """Median price by engine size and fuel, ranked within the engine size."""
    order = Window.partitionBy("engine_size").orderBy(F.desc("median"))
    return chart_box(df).select(
        "engine_size", "fuel_type", F.col("median").alias("median_price"), F.rank().over(order).alias("price_rank")
    )
