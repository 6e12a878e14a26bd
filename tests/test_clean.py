from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from pyspark.sql import functions as F

from salescope.operators import clean
from salescope.schema import IMPUTE_KEYS, NUMERIC_COLUMNS
from salescope.sources import staging
from tests.conftest import records

WAYS = {
    "small": {},
    "large, summaries broadcast": {"group_rows": 0},
    "large, summaries shuffled": {"group_rows": 0, "broadcast_rows": 0},
    "large, a few hot groups": {"group_rows": 12, "broadcast_rows": 30},
}


def random_sales(spark, n=600):
    rng = np.random.default_rng(11)

    def gaps(values, share):
        return [None if rng.random() < share else float(v) for v in values]

    frame = pd.DataFrame(
        {
            "model": rng.choice(["A", "B", None], n, p=[0.6, 0.3, 0.1]),
            "year": gaps(rng.choice([2020, 2021], n), 0.05),
            "engine_size_l": gaps(rng.choice([1.5, 2.0], n), 0.05),
            "mileage_km": gaps(rng.choice([1e4, 6e4, 2.5e5], n), 0.1),
            "transmission": rng.choice(["M", "T"], n),
            "price_usd": gaps(rng.normal(3e4, 1e4, n).round(2), 0.3),
            "sales_volume": gaps(rng.integers(1, 90, n), 0.3),
        }
    )
    rows = [tuple(None if pd.isna(v) else v for v in r) for r in frame.itertuples(index=False)]
    types = "model string, year double, engine_size_l double, mileage_km double, transmission string, price_usd double, sales_volume double"
    return frame, spark.createDataFrame(rows, types).repartition(4)


def brute_force_group_fill(frame):
    """The median of the rows that share all keys, row by row."""
    out = frame.copy()
    for target in ("price_usd", "sales_volume"):
        for i in frame.index[frame[target].isna()]:
            key = frame.loc[i, list(IMPUTE_KEYS)]
            if key.isna().any():
                continue
            same = frame[(frame[list(IMPUTE_KEYS)] == key).all(axis=1)][target].dropna()
            if len(same):
                out.loc[i, target] = np.median(same)
    return out


def multiset(rows):
    return sorted(tuple("" if v is None or v != v else repr(v) for v in r) for r in rows)


@pytest.mark.parametrize("way", WAYS)
def test_group_fill_matches_brute_force(spark, way):
    frame, df = random_sales(spark)
    got = clean.impute_group_median(df, **WAYS[way]).select(*frame.columns).collect()
    want = brute_force_group_fill(frame)
    assert multiset(got) == multiset(want.itertuples(index=False))


@pytest.mark.parametrize("group_rows", [10**6, 0])
def test_global_fill_uses_medians_after_the_group_fill(spark, group_rows):
    frame, df = random_sales(spark)
    want = brute_force_group_fill(frame)
    for c in NUMERIC_COLUMNS:
        want[c] = want[c].fillna(want[c].median())
    got = clean.impute(df, group_rows=group_rows).select(*frame.columns).collect()
    assert multiset(got) == multiset(want.itertuples(index=False))
    before = frame["price_usd"].median()
    assert before != brute_force_group_fill(frame)["price_usd"].median()


def test_fill_of_an_empty_table_and_of_unusual_columns(spark, make):
    empty = make({}).where("false")
    assert clean.impute(empty).collect() == []
    odd = make({"price_usd": None}, {"price_usd": 4.0}, {"price_usd": 4.0}).withColumn("extra", F.create_map(F.lit("a"), F.lit(1)))
    assert [(r["price_usd"], r["extra"]) for r in clean.impute(odd, broadcast_rows=2).collect()] == [(4.0, {"a": 1})] * 3
    without_keys = clean.impute(make({"price_usd": None}, {"price_usd": 6.0}).select("price_usd")).collect()
    assert [r["price_usd"] for r in without_keys] == [6.0, 6.0]


def test_imputation_reads_the_table_four_times_at_most(spark, monkeypatch):
    size, plans, write = 5431, [], staging.write_staged

    def noted(df, *rest):
        plans.append(df)
        return write(df, *rest)

    monkeypatch.setattr(staging, "write_staged", noted)
    # Columns of a range: each read of the table is one range in a plan.
    i = F.col("id")
    table = spark.range(size).select(
        F.when(i % 3 > 0, (i % 7).cast("string")).alias("model"),
        F.when(i % 50 > 0, 2000.0 + i % 5).alias("year"),
        F.when(i % 4 > 0, i % 97 * 1.5).alias("price_usd"),
    )
    plans.append(clean.impute(table, keys=("model", "year"), columns=("year", "price_usd")))
    reads = [p._jdf.queryExecution().optimizedPlan().toString().count(f"Range (0, {size}") for p in plans]
    assert sum(reads) == 4
    assert plans[-1].where("price_usd IS NULL OR year IS NULL").isEmpty()


def test_rows_of_large_groups_are_joined_once(spark, monkeypatch):
    plans, write = [], staging.write_staged

    def noted(df, *rest):
        plans.append(df)
        return write(df, *rest)

    monkeypatch.setattr(staging, "write_staged", noted)
    i = F.col("id")
    table = spark.range(3000).select(
        F.when(i < 2990, (i % 7).cast("string")).otherwise(F.concat(F.lit("k"), i)).alias("model"),
        F.when(i % 4 > 0, i % 97 * 1.5).alias("price_usd"),
        F.when(i % 7 != 3, i % 5 * 1.0).alias("sales_volume"),  # one large group without any value
    )
    filled = clean.impute_group_median(table, ("model",), ("price_usd", "sales_volume"), group_rows=5)
    plans = [p._jdf.queryExecution().optimizedPlan().toString() for p in plans]
    assert sum(p.count("LeftSemi") for p in plans) == 2  # rows of groups with gaps, those of large groups

    ordinary = clean.impute_group_median(table, ("model",), ("price_usd", "sales_volume"))
    assert filled.exceptAll(ordinary).isEmpty() and filled.count() == ordinary.count() == 3000
    assert filled.where("sales_volume IS NULL").count() == table.where("sales_volume IS NULL").count()


def test_a_hot_group_is_dealt_out(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 > 0, F.col("id")).otherwise(-1).alias("k"), F.col("id").alias("v"))
    sizes = staging.materialize(df.groupBy("k").agg(F.count("v").alias(clean.SIZE), F.max("v").alias("top")), "sizes")
    joined = clean.join_groups(df, sizes, ["k"], 9000, broadcast_rows=30)
    assert joined.columns == ["k", "v", clean.SIZE, "top"]
    assert joined.where("k = -1 AND top = 8997 OR k = v AND top = v").count() == 9000
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("xxhash64(k") == 1 and clean.PART in plan


def test_column_without_values_becomes_zero(make):
    rows = records(clean.impute(make({"price_usd": None}, {"price_usd": None})))
    assert [r["price_usd"] for r in rows] == [0.0, 0.0]


def test_cleaning_twice_changes_nothing(make):
    df = make({"price_usd": None}, {"price_usd": 10.0}, {"mileage_km": None}, {"sales_volume": None, "model": "B"})
    once = clean.clean_sales(df)
    twice = clean.clean_sales(once.drop("engine_size", "mileage_bin", "mileage_bin_ord"))
    assert multiset(once.collect()) == multiset(twice.select(*once.columns).collect())


def test_mileage_bins_are_right_closed(make):
    values = (-1, 0, 1, 50000, 50001, 200000, 200001)
    df = clean.bin_mileage(make(*[{"mileage_km": float(v)} for v in values]))
    got = {r["mileage_km"]: (r["mileage_bin"], r["mileage_bin_ord"]) for r in df.collect()}
    first, none = ("0-50k", 1), (None, None)
    assert [got[v] for v in values] == [none, none, first, first, ("50k-100k", 2), ("150k-200k", 4), none]


def test_bins_need_one_label_per_interval(make):
    with pytest.raises(ValueError):
        clean.bin_column(make({}), "price_usd", "band", (0, 1, 2), ("only one",))


def test_clean_frame_shape_and_types(make):
    df = clean.clean_sales(make({"engine_size_l": 2.7}, {"year": None}).withColumnRenamed("price_usd", "Price USD"))
    types = dict(df.dtypes)
    assert len(df.columns) == 13  # ten columns, engine size, bin label and bin number
    assert (types["year"], types["engine_size"], types["price_usd"]) == ("int", "int", "double")
    assert {r["engine_size"] for r in df.collect()} == {2}
    assert {r["year"] for r in df.collect()} == {2020}
    assert {r["mileage_bin"] for r in df.collect()} == {"0-50k"}


def test_text_that_is_no_number_becomes_null(spark):
    df = spark.createDataFrame([("1.5",), ("n/a",), ("NaN",), ("",)], "price_usd string")
    assert [r["price_usd"] for r in records(clean.coerce_numeric(df))] == [1.5, None, None, None]


def test_truncation_is_toward_zero(spark):
    df = spark.createDataFrame([(2.7,), (-2.7,)], "engine_size_l double")
    assert [r["engine_size"] for r in records(clean.truncate_engine(df))] == [2, -2]


def test_missing_column_is_named(make):
    with pytest.raises(ValueError, match="region"):
        clean.clean_sales(make({}).drop("region"))


@pytest.mark.parametrize("way", [{}, {"group_rows": 0}, {"group_rows": 0, "broadcast_rows": 0}])
def test_group_stat_joins_back_to_every_row(make, way):
    df = make({"price_usd": 1.0}, {"price_usd": 3.0}, {"model": "B", "price_usd": 9.0}, {"model": None})
    rows = records(clean.join_group_stat(df, ["model"], "price_usd", **way))
    assert sorted((r["model"] or "", r["median_price_usd"]) for r in rows if r["model"]) == [("A", 2.0), ("A", 2.0), ("B", 9.0)]
    assert len(rows) == 4


def test_open_groups_of_most_rows_are_gathered_without_a_join(spark, monkeypatch):
    """Every group has a gap; keys of -0.0 and 0.0 are one group, a NULL key is none."""
    plans, write = [], staging.write_staged

    def noted(df, *rest):
        plans.append(df)
        return write(df, *rest)

    monkeypatch.setattr(staging, "write_staged", noted)
    data = [("a", 0.0, 1.0), ("a", -0.0, 5.0), ("a", 0.0, None), ("b", 1.0, None), ("b", 1.0, 4.0), (None, 1.0, None)]
    data += [(f"m{i % 300}", float(i % 3), None if i < 300 else float(i)) for i in range(1200)]
    table = spark.createDataFrame(data, "model string, year double, price_usd double").repartition(3)
    filled = clean.impute_group_median(table, ("model", "year"), ("price_usd",)).collect()
    assert not any("LeftSemi" in p._jdf.queryExecution().optimizedPlan().toString() for p in plans)
    groups = pd.DataFrame(data, columns=["model", "year", "price_usd"])
    medians = groups.groupby(["model", "year"])["price_usd"].median()
    want = [(m, y + 0.0, float(medians[(m, y)]) if p is None and m else p) for m, y, p in data]
    assert multiset((m, y + 0.0, p) for m, y, p in filled) == multiset(want)


def test_few_open_groups_are_picked_before_rows_are_gathered(spark, monkeypatch):
    plans, write = {}, staging.write_staged

    def noted(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return write(df, name)

    monkeypatch.setattr(staging, "write_staged", noted)
    i = F.col("id")
    table = spark.range(1000).select((i % 10).cast("string").alias("model"), F.when(i != 500, i * 1.0).alias("price_usd"))
    filled = clean.impute_group_median(table, ("model",), ("price_usd",))
    assert "LeftSemi" in plans["group-medians"]
    kept = sorted(v for v in range(0, 1000, 10) if v != 500)
    assert filled.where("price_usd IS NULL").isEmpty()
    assert filled.agg(F.sum("price_usd")).first()[0] == sum(range(1000)) - 500 + float(np.median(kept))
    complete = clean.impute_group_median(table.where("price_usd IS NOT NULL"), ("model",), ("price_usd",))
    assert complete.count() == 999
