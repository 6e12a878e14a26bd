"""Aggregates, rankings, trends, market questions and chart tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from salescope_checks.catalog import add
from salescope_checks.load_queries import CELLS, CHART_CELLS, table_sink
from salescope_checks.tables import on_clean, on_dirty, on_sales
from salescope.functions import formats
from salescope.operators import aggregate, insights, rank, trends
from salescope.plans import charts
from salescope.sources.star import clean_fact, dirty_fact, sales_fact

UNITS = "CAST(coalesce(sum(sales_volume), 0) AS BIGINT)"


def fact(key, operator, sql, doubles="", **kwargs):
    """A query over the sales table."""
    add(key, lambda s, d: operator(sales_fact(s, d)), on_sales(sql), doubles, **kwargs)


# ---------------------------------------------------------------- aggregates

fact(
    "agg_totals",
    aggregate.totals,
    f"SELECT sum(sales_volume * price_usd) AS total_revenue, {UNITS} AS total_units, "
    "min(year) AS first_year, max(year) AS last_year FROM fact",
    "total_revenue",
    digits=2,
)
fact("agg_yearly", aggregate.yearly_units, f"SELECT year, {UNITS} AS units FROM fact GROUP BY year")
fact(
    "agg_yearly_region",
    aggregate.yearly_region_units,
    f"SELECT year, region, {UNITS} AS units FROM fact GROUP BY ALL",
)


def stats(column: str, by: str = "", order: str = "") -> str:
    """SQL of the statistics of a column, whole or grouped."""
    shared = (
        f"avg({column}) AS mean, median({column}) AS median, stddev_samp({column}) AS std, "
        f"CAST(min({column}) AS DOUBLE) AS min, CAST(max({column}) AS DOUBLE) AS max, count({column}) AS count"
    )
    if not by:
        return (
            f"SELECT {shared}, quantile_cont({column}, 0.25) AS q25, quantile_cont({column}, 0.5) AS q50, "
            f"quantile_cont({column}, 0.75) AS q75, count(*) - count({column}) AS missing FROM fact"
        )
    keys = f"{by}, {order}" if order else by
    return f"SELECT {keys}, {shared} FROM fact WHERE {by} IS NOT NULL GROUP BY {keys}"


STATS = "mean median std min max"
MEASURES = ["price_usd", "mileage_km", "engine_size_l"]
STATS_COLUMN = on_sales(
    " UNION ALL BY NAME ".join(f"SELECT '{c}' AS \"column\", * FROM ({stats(c)})" for c in MEASURES)
)
# The way of groups too large for one task, whatever the size of the data: buckets that
# are cut again and again until they hold few values.
SPLIT = {"group_rows": 0, "bucket_values": 50}
for key, way in (("stats_column", {}), ("stats_column_split", SPLIT)):
    add(
        key,
        lambda s, d, way=way: aggregate.stats_columns(sales_fact(s, d), MEASURES, **way),
        STATS_COLUMN,
        f"{STATS} q25 q50 q75",
    )
add(
    "stats_grouped",
    lambda s, d: aggregate.stats_grouped(sales_fact(s, d), "mileage_km", ["region", "fuel_type"]),
    on_sales(
        stats("mileage_km", "region").replace("SELECT region,", "SELECT region, fuel_type,").replace(
            "GROUP BY region", "GROUP BY region, fuel_type"
        )
    ),
    STATS,
)
for key, column, by, order in (
    ("stats_price_by_region", "price_usd", "region", ""),
    ("stats_price_by_model", "price_usd", "model", ""),
    ("stats_sales_by_model", "sales_volume", "model", ""),
    ("stats_price_by_transmission", "price_usd", "transmission", ""),
    ("stats_price_by_fuel", "price_usd", "fuel_type", ""),
    ("stats_price_by_mileage_bin", "price_usd", "mileage_bin", "mileage_bin_ord"),
):
    fact(
        key,
        lambda df, column=column, by=by, order=order: aggregate.stats_grouped(df, column, [by], order or None),
        stats(column, by, order),
        STATS,
    )

fact(
    "stats_price_by_model_split",
    lambda df: aggregate.stats_grouped(df, "price_usd", ["model"], **SPLIT),
    stats("price_usd", "model"),
    STATS,
)

fact("agg_fuel_trans", aggregate.fuel_transmission, CELLS, "avg_price_usd avg_engine_size")

TOP_MODEL_YEARS = f"""
SELECT f.year, f.model, f.fuel_type, {UNITS} AS units, t.model_order
FROM fact f JOIN (
  SELECT model, CAST(row_number() OVER (ORDER BY units DESC, model) AS INTEGER) AS model_order FROM (
    SELECT model, {UNITS} AS units FROM fact WHERE model IS NOT NULL GROUP BY model
    ORDER BY units DESC, model LIMIT 10)
) t ON f.model = t.model
WHERE f.year IS NOT NULL AND f.fuel_type IS NOT NULL GROUP BY ALL"""
fact("agg_model_fuel_year", rank.top_model_fuel_years, TOP_MODEL_YEARS)


def corr(x: str, y: str, where: str = "") -> str:
    return f"(CASE WHEN isnan(corr({x}, {y}){where}) THEN NULL ELSE corr({x}, {y}){where} END)"


PRICE_LABEL = "CASE WHEN correlation < -0.4 THEN 'negative' WHEN correlation > 0.4 THEN 'positive' ELSE 'neutral' END"
MILEAGE_LABEL = (
    "CASE WHEN correlation < -0.6 THEN 'strong negative' WHEN correlation < -0.2 THEN 'negative' ELSE 'neutral' END"
)
fact(
    "corr_price_sales",
    aggregate.corr_price_sales,
    f"SELECT *, {PRICE_LABEL} AS label FROM (SELECT {corr('price_usd', 'sales_volume')} AS correlation FROM fact)",
    "correlation",
    digits=6,
)
fact(
    "corr_mileage_price",
    aggregate.corr_mileage_price,
    f"SELECT *, {MILEAGE_LABEL} AS label FROM (SELECT {corr('mileage_km', 'price_usd')} AS correlation FROM fact)",
    "correlation",
    digits=6,
)
BOX = """
SELECT b.engine_size, b.fuel_type, any_value(b.count) AS count, any_value(b.min) AS min,
       any_value(b.q25) AS q25, any_value(b.median) AS median, any_value(b.q75) AS q75, any_value(b.max) AS max,
       min(f.price_usd) FILTER (WHERE f.price_usd >= b.q25 - 1.5 * (b.q75 - b.q25)) AS whisker_low,
       max(f.price_usd) FILTER (WHERE f.price_usd <= b.q75 + 1.5 * (b.q75 - b.q25)) AS whisker_high
FROM fact f JOIN (
  SELECT engine_size, fuel_type, count(price_usd) AS count, min(price_usd) AS min,
         quantile_cont(price_usd, 0.25) AS q25, median(price_usd) AS median,
         quantile_cont(price_usd, 0.75) AS q75, max(price_usd) AS max
  FROM fact WHERE engine_size_l IS NOT NULL AND price_usd IS NOT NULL AND fuel_type IS NOT NULL
  GROUP BY engine_size, fuel_type
) b ON f.engine_size = b.engine_size AND f.fuel_type = b.fuel_type
GROUP BY b.engine_size, b.fuel_type"""
BOX_DOUBLES = "min q25 median q75 max whisker_low whisker_high"
fact("agg_box", aggregate.chart_box, BOX, BOX_DOUBLES)
fact("agg_box_split", lambda df: aggregate.chart_box(df, **SPLIT), BOX, BOX_DOUBLES)

# ---------------------------------------------------------------- rankings


def top(column: str, n: int, metric: str = "sales_volume") -> str:
    return (
        f"SELECT {column}, CAST(sum({metric}) AS BIGINT) AS units FROM fact WHERE {column} IS NOT NULL "
        f"GROUP BY {column} ORDER BY units DESC, {column} LIMIT {n}"
    )


fact("top_n", lambda df: rank.top_n(df, "mileage_km", n=7), top("mileage_km", 7))
for key, column in (
    ("top_regions", "region"),
    ("top_models", "model"),
    ("top_engine_sizes", "engine_size_l"),
    ("top_fuel_types", "fuel_type"),
    ("top_colors", "color"),
):
    fact(key, lambda df, column=column: rank.top_n(df, column), top(column, 3))
fact("top_10_models", lambda df: rank.top_n(df, "model", n=10), top("model", 10))
fact(
    "top_dimensions",
    rank.top_dimensions,
    " UNION ALL ".join(
        f"SELECT '{c}' AS dimension, CAST({c} AS VARCHAR) AS item, units, "
        f"CAST(row_number() OVER (ORDER BY units DESC, {c}) AS INTEGER) AS position FROM ({top(c, 3)})"
        for c in rank.TOP_DIMENSIONS
    ),
)
fact("rank_regions", rank.rank_groups, f"SELECT region, {UNITS} AS units FROM fact WHERE region IS NOT NULL GROUP BY region")


def leaders(column: str) -> str:
    return (
        f"SELECT region, {column}, units, CAST(position AS INTEGER) AS position FROM ("
        f"SELECT *, row_number() OVER (PARTITION BY region ORDER BY units DESC, {column}) AS position FROM ("
        f"SELECT region, {column}, {UNITS} AS units FROM fact WHERE region IS NOT NULL AND {column} IS NOT NULL "
        "GROUP BY ALL)) WHERE position = 1"
    )


fact("top_per_group", lambda df: rank.top_per_group(df, "region", "model"), leaders("model"))
fact(
    "region_profile",
    rank.group_profile,
    f"SELECT g.region, g.total_units, g.avg_price, g.avg_mileage, m.model AS top_model, "
    "f.fuel_type AS top_fuel_type, t.transmission AS top_transmission FROM ("
    f"SELECT region, {UNITS} AS total_units, avg(price_usd) AS avg_price, avg(mileage_km) AS avg_mileage "
    f"FROM fact WHERE region IS NOT NULL GROUP BY region) g LEFT JOIN ({leaders('model')}) m USING (region) "
    f"LEFT JOIN ({leaders('fuel_type')}) f USING (region) LEFT JOIN ({leaders('transmission')}) t USING (region)",
    "avg_price avg_mileage",
)
fact(
    "sort_index",
    lambda df: trends.yearly_series(df, ["transmission"]).orderBy("transmission", "year"),
    f"SELECT transmission, year, {UNITS} AS units, avg(price_usd) AS avg_price FROM fact GROUP BY ALL",
    "avg_price",
)


def rollup(table: str, units: str = UNITS) -> str:
    return (
        f"SELECT year, region, {units} AS units, false AS is_global FROM {table} "
        f"WHERE year IS NOT NULL AND region IS NOT NULL GROUP BY year, region UNION ALL "
        f"SELECT year, 'Global' AS region, {units} AS units, true AS is_global FROM {table} "
        "WHERE year IS NOT NULL GROUP BY year"
    )


def ordered(table: str, units: str = UNITS) -> str:
    return (
        "SELECT region, is_global, CAST(row_number() OVER (ORDER BY is_global, first_year, region) AS INTEGER) "
        f"AS series_order FROM (SELECT region, is_global, min(year) AS first_year FROM ({rollup(table, units)}) "
        "GROUP BY ALL)"
    )


fact("category_order", lambda df: rank.category_order(aggregate.rollup_global(df)), ordered("fact"))

# ---------------------------------------------------------------- sets and joins

add("rollup_region_global", lambda s, d: aggregate.rollup_global(dirty_fact(s, d)), on_dirty(rollup("dirty")))
add(
    "union_global",
    lambda s, d: aggregate.union_global(dirty_fact(s, d)),
    on_dirty(f"SELECT year, region, units FROM ({rollup('dirty')})"),
)
add(
    "semi_join_top",
    lambda s, d: rank.semi_join_top(sales_fact(s, d)).select("model", "year", "price_usd", "sales_volume"),
    on_sales(
        "SELECT model, year, price_usd, sales_volume FROM fact WHERE model IN "
        f"(SELECT model FROM ({top('model', 10)}))"
    ),
)
fact(
    "label_rename",
    aggregate.global_series,
    f"SELECT year, {UNITS} AS units, 'Global' AS region FROM fact GROUP BY year",
)
TWO = "format('{{:,.2f}}', round({}, 6))"
fact(
    "fmt_mixed",
    lambda df: aggregate.stats_text(df, ["sales_volume", "price_usd"]),
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {TWO.format(f'avg({c})')} AS mean, {TWO.format(f'median({c})')} AS median, "
        f"{TWO.format(f'stddev_samp({c})')} AS std, {ends.format(f'min({c})')} AS min, {ends.format(f'max({c})')} AS max, "
        + "".join(f"{TWO.format(f'quantile_cont({c}, {q / 100})')} AS q{q}, " for q in (25, 50, 75))
        + f"CAST(count({c}) AS VARCHAR) AS count, CAST(count(*) - count({c}) AS VARCHAR) AS missing FROM fact"
        for c, ends in (("sales_volume", "CAST({} AS VARCHAR)"), ("price_usd", TWO))
    ),
)
fact(
    "arith",
    lambda df: aggregate.with_revenue(df)
    .groupBy("region", "year")
    .agg(F.sum("revenue").alias("revenue"), F.sum("sales_volume").alias("units"))
    .select("region", "year", F.try_divide("revenue", "units").alias("per_unit"), F.sqrt(F.col("units")).alias("root")),
    "SELECT region, year, sum(sales_volume * price_usd) / nullif(sum(sales_volume), 0) AS per_unit, "
    "sqrt(sum(sales_volume)) AS root FROM fact GROUP BY ALL",
    "per_unit root",
)
fact(
    "upper_label",
    lambda df: trends.cagr_global(df).select(F.upper("trend").alias("label")),
    "SELECT upper(trend) AS label FROM (SELECT CASE WHEN c > 0.05 THEN 'increasing' WHEN c < -0.05 THEN 'decreasing' "
    f"ELSE 'stable' END AS trend FROM (SELECT power(arg_max(units, year)::DOUBLE / arg_min(units, year), 1.0 / (count(*) - 1)) - 1 AS c "
    f"FROM (SELECT year, {UNITS} AS units FROM fact GROUP BY year)))",
)

# ---------------------------------------------------------------- trends

YEARLY = f"(SELECT year, {UNITS} AS units FROM fact WHERE year IS NOT NULL GROUP BY year)"
CAGR = (
    "CASE WHEN years > 1 AND first_units > 0 THEN "
    "power(last_units::DOUBLE / first_units, 1.0 / (years - 1)) - 1 ELSE 0.0 END"
)
GLOBAL = (
    f"SELECT first_units, last_units, years, CAST({CAGR} AS DOUBLE) AS cagr FROM (SELECT arg_min(units, year) AS first_units, "
    f"arg_max(units, year) AS last_units, count(year) AS years FROM {YEARLY})"
)
TREND = "CASE WHEN cagr > 0.05 THEN 'increasing' WHEN cagr < -0.05 THEN 'decreasing' ELSE 'stable' END AS trend"
fact("cagr_global", trends.cagr_global, f"SELECT *, {TREND} FROM ({GLOBAL})", "cagr", digits=6)
fact(
    "trend_label",
    lambda df: trends.cagr_global(df).select("trend"),
    f"SELECT trend FROM (SELECT {TREND} FROM ({GLOBAL}))",
)


def series(item: str, n: int) -> str:
    """Yearly rows of the top n items, with each item's total."""
    return (
        f"SELECT f.{item} AS {item}, f.year AS year, {UNITS} AS units, avg(price_usd) AS avg_price, "
        f"any_value(t.units) AS total_units FROM fact f JOIN ({top(item, n)}) t ON f.{item} = t.{item} "
        f"WHERE f.year IS NOT NULL GROUP BY f.{item}, f.year"
    )


def summary(item: str, n: int) -> str:
    return (
        f"SELECT {item}, total_units, CAST(CASE WHEN years > 1 AND first_units > 0 "
        "THEN last_units::DOUBLE / first_units - 1 ELSE 0.0 END AS DOUBLE) AS growth, first_price, last_price FROM ("
        f"SELECT {item}, any_value(total_units) AS total_units, count(*) AS years, arg_min(units, year) AS first_units, "
        "arg_max(units, year) AS last_units, arg_min(avg_price, year) AS first_price, "
        f"arg_max(avg_price, year) AS last_price FROM ({series(item, n)}) GROUP BY {item})"
    )


def breakdown(item: str, n: int) -> str:
    return (
        f"SELECT a.{item} AS {item}, 'Growth: ' || CASE WHEN growth >= 0 THEN '+' ELSE '' END || format('{{:.2f}}', round(growth * 100, 6)) || "
        "'% | Start_Year_Price: $' || format('{:,.0f}', round(first_price, 6)) || ' | End_Year_Price: $' || "
        "format('{:,.0f}', round(last_price, 6)) AS summary, b.breakdown AS breakdown "
        f"FROM ({summary(item, n)}) a JOIN (SELECT {item}, string_agg('Y' || year || ': S' || "
        "format('{:,.0f}', units::DOUBLE) || '/P$' || format('{:,.0f}', round(avg_price, 6)), ' | ' ORDER BY year) AS breakdown "
        f"FROM ({series(item, n)}) GROUP BY {item}) b ON a.{item} = b.{item}"
    )


fact(
    "trend_yearly",
    lambda df: trends.trend_yearly(df, "model"),
    f"SELECT model, year, units, avg_price FROM ({series('model', 3)})",
    "avg_price",
)
fact("trend_summary", lambda df: trends.trend_summary(df, "color"), summary("color", 3), "growth first_price last_price")
fact("trend_breakdown", lambda df: trends.trend_breakdown(df, "region"), breakdown("region", 3))
for key, item, n in (
    ("trend_model", "model", 3),
    ("trend_fuel", "fuel_type", 4),
    ("trend_transmission", "transmission", 2),
    ("trend_engine_size", "engine_size", 3),
):
    fact(key, lambda df, item=item, n=n: trends.trend_breakdown(df, item, n), breakdown(item, n))

# ---------------------------------------------------------------- formats

fact(
    "fmt_thousands",
    lambda df: aggregate.units_by(df, ["model"]).select("model", F.expr(formats.thousands("units")).alias("text")),
    f"SELECT model, format('{{:,.0f}}', {UNITS}::DOUBLE) AS text FROM fact GROUP BY model",
)
fact(
    "fmt_fixed",
    lambda df: trends.yearly_series(df, ["region"]).select("region", "year", F.expr(formats.fixed("avg_price", 2)).alias("text")),
    "SELECT region, year, format('{:,.2f}', round(avg(price_usd), 6)) AS text FROM fact GROUP BY ALL",
)
YOY = "units::DOUBLE / nullif(lag(units) OVER (ORDER BY year), 0) - 1"
fact(
    "fmt_percent",
    lambda df: insights.yoy_global(df).select(
        "year", F.expr(formats.percent("yoy", signed=True)).alias("text")
    ),
    "SELECT year, CASE WHEN yoy >= 0 THEN '+' ELSE '' END || format('{:.2f}', round(yoy * 100, 6)) || '%' AS text "
    f"FROM (SELECT year, {YOY} AS yoy FROM {YEARLY})",
)
fact(
    "str_join",
    lambda df: trends.item_series(df, "region").select(
        "region", F.expr(formats.joined("series", "CAST(x.year AS STRING)")).alias("years")
    ),
    "SELECT region, string_agg(CAST(year AS VARCHAR), ', ' ORDER BY year) AS years "
    "FROM (SELECT DISTINCT region, year FROM fact) GROUP BY region",
)

# ---------------------------------------------------------------- market questions

fact("yoy_global", insights.yoy_global, f"SELECT year, units, {YOY} AS yoy FROM {YEARLY}", "yoy", digits=6)
REGION_GROWTH = f"""
SELECT region, total_units, CAST({CAGR} AS DOUBLE) AS cagr, last_units::DOUBLE / nullif(before_last, 0) - 1 AS latest_yoy FROM (
  SELECT region, CAST(sum(units) AS BIGINT) AS total_units, count(*) AS years, arg_min(units, year) AS first_units,
         arg_max(units, year) AS last_units, arg_max(before, year) AS before_last FROM (
    SELECT *, lag(units) OVER (PARTITION BY region ORDER BY year) AS before FROM (
      SELECT region, year, {UNITS} AS units FROM fact WHERE region IS NOT NULL AND year IS NOT NULL GROUP BY ALL))
  GROUP BY region)"""


def side(name: str, direction: str) -> str:
    return (
        f"SELECT '{name}' AS side, CAST(row_number() OVER (ORDER BY total_units {direction}, region) AS INTEGER) "
        f"AS position, * FROM (SELECT * FROM ({REGION_GROWTH}) ORDER BY total_units {direction}, region LIMIT 3)"
    )


fact(
    "growth_region_top_bottom",
    insights.growth_top_bottom,
    f"{side('top', 'DESC')} UNION ALL {side('bottom', 'ASC')}",
    "cagr latest_yoy",
    digits=6,
)
fact("top_5_models", insights.top_5_models, top("model", 5))
fact(
    "top_asp_model_region",
    insights.top_price_pair,
    "SELECT model, region, avg(price_usd) AS avg_price FROM fact WHERE model IS NOT NULL AND region IS NOT NULL "
    "GROUP BY ALL ORDER BY avg_price DESC, model, region LIMIT 1",
    "avg_price",
)
fact(
    "segment_underperformer",
    lambda df: insights.segment_underperformer(df, n=3),
    "SELECT fuel_type, units_then, units_now, units_now::DOUBLE / nullif(units_then, 0) - 1 AS growth FROM ("
    "SELECT fuel_type, CAST(sum(sales_volume) FILTER (WHERE year = m.last - 2) AS BIGINT) AS units_then, "
    "CAST(sum(sales_volume) FILTER (WHERE year = m.last) AS BIGINT) AS units_now FROM fact, "
    "(SELECT max(year) AS last FROM fact) m GROUP BY fuel_type) ORDER BY growth, fuel_type LIMIT 3",
    "growth",
    digits=6,
)
fact(
    "corr_in_top_segment",
    insights.corr_in_top_segment,
    f"SELECT *, {PRICE_LABEL} AS label FROM (SELECT fuel_type, {UNITS} AS units, "
    f"{corr('price_usd', 'sales_volume')} AS correlation FROM fact WHERE fuel_type IS NOT NULL GROUP BY fuel_type "
    "ORDER BY units DESC, fuel_type LIMIT 1)",
    "correlation",
    digits=6,
)
fact(
    "fuel_distribution",
    insights.fuel_distribution,
    "SELECT fuel_type, units, units::DOUBLE / sum(units) OVER () AS share FROM "
    f"(SELECT fuel_type, {UNITS} AS units FROM fact GROUP BY fuel_type)",
    "share",
    digits=6,
)
FUEL_YOY = (
    "SELECT fuel_type, year, units, units::DOUBLE / nullif(lag(units) OVER (PARTITION BY fuel_type ORDER BY year), 0) - 1 "
    f"AS yoy FROM (SELECT fuel_type, year, {UNITS} AS units FROM fact GROUP BY ALL)"
)
fact(
    "fuel_momentum",
    insights.fuel_momentum,
    f"SELECT * FROM ({FUEL_YOY}) WHERE year = (SELECT max(year) FROM fact) AND yoy IS NOT NULL "
    "ORDER BY yoy DESC, fuel_type LIMIT 1",
    "yoy",
    digits=6,
)
fact(
    "transmission_growth",
    insights.transmission_growth,
    f"SELECT transmission, total_units, growth FROM ({summary('transmission', 2)})",
    "growth",
    digits=6,
)
fact(
    "region_price_premium",
    insights.region_price_premium,
    "SELECT region, avg_price, global_price, (avg_price / nullif(global_price, 0) - 1) * 100 AS premium_pct FROM ("
    "SELECT region, avg(price_usd) AS avg_price, (SELECT avg(price_usd) FROM fact) AS global_price FROM fact "
    "WHERE region IS NOT NULL GROUP BY region)",
    "avg_price global_price premium_pct",
)
fact(
    "niche_pricing_power",
    insights.niche_pricing_power,
    "SELECT model, region, units, avg_price, model_price, avg_price / model_price - 1 AS premium FROM ("
    f"SELECT model, region, {UNITS} AS units, avg(price_usd) AS avg_price FROM fact GROUP BY ALL) "
    "JOIN (SELECT model, avg(price_usd) AS model_price FROM fact GROUP BY model) USING (model) "
    f"WHERE avg_price > model_price AND units < (SELECT avg(units) FROM (SELECT {UNITS} AS units FROM fact GROUP BY model, region))",
    "avg_price model_price premium",
)
fact(
    "region_vs_global",
    insights.region_vs_global,
    "SELECT year, region, units, yoy, global_yoy, yoy - global_yoy AS lead FROM (SELECT year, region, units, "
    "units::DOUBLE / nullif(lag(units) OVER (PARTITION BY region ORDER BY year), 0) - 1 AS yoy FROM "
    f"(SELECT year, region, {UNITS} AS units FROM fact GROUP BY ALL)) "
    f"JOIN (SELECT year, {YOY} AS global_yoy FROM {YEARLY}) USING (year)",
    "yoy global_yoy lead",
    digits=6,
)
fact(
    "fuel_share_top_models",
    insights.fuel_share_top_models,
    "SELECT year, model, fuel_type, units, units::DOUBLE / sum(units) OVER (PARTITION BY year, model) AS share, "
    "row_number() OVER (PARTITION BY year, model ORDER BY units DESC, fuel_type) = 1 AS dominant "
    f"FROM ({TOP_MODEL_YEARS})",
    "share",
    digits=6,
)
fact(
    "elasticity_fit",
    insights.elasticity_fit,
    f"SELECT {corr('avg_price_usd', 'total_sales_volume')} AS correlation, "
    "regr_slope(total_sales_volume, avg_price_usd) AS slope, "
    "regr_slope(ln(total_sales_volume), ln(avg_price_usd)) AS log_slope "
    f"FROM ({CELLS})",
    "correlation slope log_slope",
    digits=5,
)
fact(
    "median_price_engine_fuel",
    insights.median_price_engine_fuel,
    "SELECT engine_size, fuel_type, median_price, CAST(rank() OVER (PARTITION BY engine_size ORDER BY median_price DESC) "
    "AS INTEGER) AS price_rank FROM (SELECT engine_size, fuel_type, median(price_usd) AS median_price FROM fact GROUP BY ALL)",
    "median_price",
)

# ---------------------------------------------------------------- chart tables

CHART_1 = f"SELECT r.*, o.series_order FROM ({rollup('fact')}) r JOIN ({ordered('fact')}) o USING (region, is_global)"
fact("chart_sales_trend", charts.sales_trend, CHART_1)
CLEAN_UNITS = "coalesce(sum(sales_volume), 0)"
add(
    "chart_sales_trend_clean",
    lambda s, d: charts.sales_trend(clean_fact(s, d)),
    on_clean(
        f"SELECT r.*, o.series_order FROM ({rollup('clean', CLEAN_UNITS)}) r "
        f"JOIN ({ordered('clean', CLEAN_UNITS)}) o USING (region, is_global)"
    ),
    "units",
)
fact("chart_top_models", charts.top_models, TOP_MODEL_YEARS)
fact("chart_price_elasticity", charts.price_elasticity, CELLS, "avg_price_usd avg_engine_size")
fact("chart_engine_price", charts.engine_price, BOX, BOX_DOUBLES)
CHART_SQL = dict(zip(CHART_CELLS, (CHART_1, TOP_MODEL_YEARS, CELLS, BOX)))
add(
    "table_sink",
    table_sink,
    on_sales(
        " UNION ALL ".join(
            f"SELECT '{name}' AS chart, CAST({one} AS VARCHAR) AS one, CAST({two} AS VARCHAR) AS two, "
            f"CAST({figure} AS DOUBLE) AS figure FROM ({CHART_SQL[name]})"
            for name, (one, two, figure) in CHART_CELLS.items()
        )
    ),
    "figure",
)
