from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from salescope.functions import stats
from salescope.operators import aggregate, insights, rank, trends
from salescope.operators.clean import derive_columns
from salescope.plans import charts
from tests.conftest import records


def test_ties_go_to_the_smaller_key(make):
    df = make(*[{"model": m} for m in "cab"])
    assert [r["model"] for r in rank.top_n(df, "model", n=2).collect()] == ["a", "b"]
    assert [r["model"] for r in rank.top_per_group(df, "region", "model").collect()] == ["a"]
    assert rank.group_profile(df).first()["top_model"] == "a"
    tops = {(r["dimension"], r["position"]): r["item"] for r in rank.top_dimensions(df, n=2).collect()}
    assert (tops["model", 1], tops["model", 2]) == ("a", "b")


def test_numeric_ties_sort_as_numbers(make):
    df = make({"engine_size_l": 10.0}, {"engine_size_l": 9.0})
    tops = rank.top_dimensions(df, ["engine_size_l"], n=1).collect()
    assert [r["item"] for r in tops] == ["9.0"]


def test_null_keys_form_no_group_and_empty_sums_are_zero(make):
    df = make({"region": None}, {"region": "South", "sales_volume": None})
    assert records(aggregate.units_by(df, ["region"])) == [{"region": "South", "units": 0.0}]
    row = aggregate.stats_grouped(df, "sales_volume", ["region"]).first()
    assert (row["mean"], row["count"]) == (None, 0)


def test_nan_is_no_group_key(make):
    df = make({"engine_size_l": float("nan")}, {"engine_size_l": 2.0})
    assert [r["engine_size_l"] for r in aggregate.units_by(df, ["engine_size_l"]).collect()] == [2.0]


def test_rollup_equals_union_and_sums_up(make):
    df = make({"region": "Global", "sales_volume": 1.0}, {"region": "South"}, {"region": None, "year": 2021.0}, {"region": "South", "year": 2021.0})
    pairs = lambda d: sorted((r["year"], r["region"], r["units"]) for r in d.collect())
    assert pairs(aggregate.rollup_global(df)) == pairs(aggregate.union_global(df))
    flags = {(r["year"], r["region"], r["is_global"]) for r in aggregate.rollup_global(df).collect()}
    assert (2020.0, "Global", True) in flags and (2020.0, "Global", False) in flags
    order = {(r["region"], r["is_global"]): r["series_order"] for r in charts.sales_trend(df).collect()}
    assert order == {("Global", False): 1, ("South", False): 2, ("Global", True): 3}


def test_regions_add_up_to_global(make):
    rng = np.random.default_rng(5)
    df = make(*[{"region": r, "year": float(y), "sales_volume": float(rng.integers(9))} for r in "NESW" for y in (2020, 2021) for _ in range(3)])
    sums = aggregate.rollup_global(df).groupBy("year", "is_global").agg(F.sum("units").alias("u")).collect()
    by = {(r["year"], r["is_global"]): r["u"] for r in sums}
    assert all(by[y, True] == by[y, False] for y in (2020.0, 2021.0))


@pytest.mark.parametrize(
    "years, want",
    [
        ({2020: 5}, 0.0),
        ({2020: 0, 2021: 5}, 0.0),
        ({2020: 100, 2021: 7, 2024: 121}, 0.1),  # two steps, whatever the span
    ],
)
def test_cagr_counts_present_years(make, years, want):
    df = make(*[{"year": float(y), "sales_volume": float(u)} for y, u in years.items()])
    row = trends.cagr_global(df).first()
    assert row["cagr"] == pytest.approx(want)
    assert row["trend"] == ("increasing" if want > 0.05 else "stable")


def test_trend_price_is_the_row_mean(make):
    df = make({"price_usd": 10.0, "sales_volume": 1.0}, {"price_usd": 20.0, "sales_volume": 99.0}, {"year": 2022.0, "price_usd": 7.0, "sales_volume": 150.0})
    row = trends.trend_breakdown(df.withColumn("year", F.col("year").cast("int")), "model").first()
    assert row["summary"] == "Growth: +50.00% | Start_Year_Price: $15 | End_Year_Price: $7"
    assert row["breakdown"] == "Y2020: S100/P$15 | Y2022: S150/P$7"


def test_trend_of_top_items_only(make):
    df = make(*[{"model": m, "sales_volume": u} for m, u in (("a", 1.0), ("b", 3.0), ("c", 2.0))])
    assert [r["model"] for r in trends.trend_summary(df, "model", 2).collect()] == ["b", "c"]


def test_yoy_compares_with_the_previous_present_year(make):
    df = make({"year": 2020.0}, {"year": 2023.0, "sales_volume": 15.0}, {"year": 2024.0, "sales_volume": 0.0}, {"year": 2025.0})
    assert [r["yoy"] for r in insights.yoy_global(df).orderBy("year").collect()] == [None, 0.5, -1.0, None]


@pytest.mark.parametrize(
    "ys, sales_label, mileage_label",
    [
        ([5, 5, 5, 5], "neutral", "neutral"),
        ([1, 2, 3, 4], "positive", "neutral"),
        ([4, 3, 2, 1], "negative", "strong negative"),
        ([2.0, 3.0, 1.0, 1.9], "neutral", "negative"),
    ],
)
def test_correlation_labels(spark, ys, sales_label, mileage_label):
    df = spark.createDataFrame([(float(x), float(y)) for x, y in enumerate(ys)], "x double, y double")
    row = df.agg(stats.safe_corr(F.col("x"), F.col("y")).alias("r")).select(
        "r", stats.price_sales_label(F.col("r")).alias("a"), stats.mileage_price_label(F.col("r")).alias("b")
    ).first()
    if len(set(ys)) == 1:
        assert row["r"] is None
    else:
        assert row["r"] == pytest.approx(np.corrcoef(range(4), ys)[0, 1])
    assert (row["a"], row["b"]) == (sales_label, mileage_label)


def test_correlation_uses_complete_pairs(spark):
    rows = [(1.0, 2.0), (2.0, None), (None, 9.0), (3.0, 1.0), (5.0, 7.0)]
    df = spark.createDataFrame(rows, "x double, y double")
    got = df.agg(stats.safe_corr(F.col("x"), F.col("y"))).first()[0]
    assert got == pytest.approx(np.corrcoef([1, 3, 5], [2, 1, 7])[0, 1])


@pytest.mark.parametrize("way", [{}, {"group_rows": 0}, {"group_rows": 0, "bucket_values": 1}])
def test_box_whiskers_end_at_data(make, way):
    prices = [1.0, 10.0, 11.0, 12.0, 13.0, 14.0, 100.0]
    df = make(*[{"price_usd": p} for p in prices])
    row = aggregate.box_stats(df, "price_usd", ["fuel_type"], **way).first()
    assert (row["q25"], row["median"], row["q75"]) == (10.5, 12.0, 13.5)
    assert (row["whisker_low"], row["whisker_high"]) == (10.0, 14.0)
    assert (row["min"], row["max"], row["count"]) == (1.0, 100.0, 7)


def test_growth_sides_overlap_when_groups_are_few(make):
    df = make({"region": "N", "sales_volume": 5.0}, {"region": "S"})
    rows = [(r["side"], r["position"], r["region"]) for r in insights.growth_top_bottom(df).collect()]
    assert rows == [("top", 1, "S"), ("top", 2, "N"), ("bottom", 1, "N"), ("bottom", 2, "S")]


def test_weakest_segment_over_two_years(make):
    rows = [{"fuel_type": f, "year": float(y), "sales_volume": u} for f, y, u in (("P", 2020, 9.0), ("P", 2022, 9.0), ("E", 2020, 4.0), ("E", 2022, 2.0), ("New", 2022, 5.0))]
    row = insights.segment_underperformer(make(*rows)).first()
    assert (row["fuel_type"], row["growth"]) == ("E", -0.5)


def test_top_models_keep_rows_without_fuel_in_the_ranking(make):
    df = derive_columns(make({"model": "x", "sales_volume": 9.0, "fuel_type": None}, {"model": "x", "sales_volume": 1.0}, {"model": "y", "sales_volume": 5.0}))
    rows = [(r["model"], r["units"], r["model_order"]) for r in charts.top_models(df, n=2).collect()]
    assert rows == [("x", 1.0, 1), ("y", 5.0, 2)]


def test_elasticity_of_one_cell_is_null(make):
    assert records(insights.elasticity_fit(make({}))) == [{"correlation": None, "slope": None, "log_slope": None}]


def test_cells_without_outliers_are_not_read_again(spark):
    i = F.col("id")
    table = spark.range(900).select((i % 3).cast("string").alias("fuel_type"), (i % 50 * 1.0).alias("price_usd"))
    plain = aggregate.box_stats(table, "price_usd", ["fuel_type"])
    assert [(r["whisker_low"], r["whisker_high"]) for r in plain.collect()] == [(0.0, 49.0)] * 3
    final = plain._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Range (0, 900" not in final
    far = table.unionByName(spark.createDataFrame([("0", 900.0), ("1", -900.0)], table.schema))
    got = {r["fuel_type"]: (r["whisker_low"], r["whisker_high"], r["max"]) for r in aggregate.box_stats(far, "price_usd", ["fuel_type"]).collect()}
    assert got == {"0": (0.0, 49.0, 900.0), "1": (0.0, 49.0, 49.0), "2": (0.0, 49.0, 49.0)}
