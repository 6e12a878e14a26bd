from __future__ import annotations

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from salescope.functions import quantiles as Q
from salescope.functions.quantiles import QUARTILES, describe
from salescope.sources import staging

WAYS = {
    "sorted": {},
    "bucketed": {"group_rows": 0},
    "bucketed and shuffled": {"group_rows": 0, "broadcast_rows": 0},
    "mixed": {"group_rows": 400},
    "mixed, many large groups": {"group_rows": 400, "broadcast_rows": 0},
    "buckets cut": {"group_rows": 0, "bucket_values": 20},
    "buckets cut to single values": {"group_rows": 0, "bucket_values": 1},
}


def check(df, data, **way):
    """Compare with numpy, per group; data maps a group to its values with None for gaps."""
    got = {r["k"]: r for r in describe(df, ["v"], by=["k"], **way).collect()}
    assert set(got) == set(data)
    for key, values in data.items():
        present = np.array([v for v in values if v is not None], dtype=float)
        row = got[key]
        assert (row["n"], row["missing"]) == (len(present), len(values) - len(present))
        if not len(present):
            assert row["mean"] is None and row["q50"] is None and row["max"] is None
            continue
        assert row["mean"] == pytest.approx(present.mean(), rel=1e-9, abs=1e-9)
        assert (row["min"], row["max"]) == (present.min(), present.max())
        if len(present) > 1:
            assert row["std"] == pytest.approx(present.std(ddof=1), rel=1e-7, abs=1e-7)
        else:
            assert row["std"] is None
        for name, p in QUARTILES.items():
            assert row[name] == pytest.approx(np.quantile(present, p), rel=1e-12, abs=1e-12), (key, name)


@pytest.mark.parametrize("way", WAYS)
def test_skewed_groups_match_numpy(spark, way):
    rng = np.random.default_rng(7)
    data = {
        # one group holds a third of all rows, half of them one value
        "hot": [5.0] * 500 + list(np.round(rng.lognormal(8, 2, 500), 2)),
        "signed": list(rng.normal(0, 1e6, 700)),
        "tiny": list(rng.random(300) * 1e-9),
        "huge": [1e308, -1e308, 1.0, 0.0, -0.0],
        "integers": [float(x) for x in rng.integers(-3, 4, 600)],
        "gaps": [None, 1.0, None, 4.0],
        "empty": [None, None],
        "single": [42.0],
    }
    rows = [(k, v if v is None else float(v)) for k, vs in data.items() for v in vs]
    df = spark.createDataFrame(rows + [(None, 1.0)], "k string, v double").repartition(5)
    huge = data.pop("huge")
    check(df.where("k != 'huge'"), data, **WAYS[way])
    row = describe(df.where("k = 'huge'"), ["v"], by=["k"], **WAYS[way]).first()
    assert (row["q50"], row["n"]) == (0.0, len(huge))


@pytest.mark.parametrize("way", WAYS)
def test_several_columns_without_groups(spark, way):
    rng = np.random.default_rng(3)
    a, b = rng.random(1000) * 100, rng.integers(0, 9, 1000)
    df = spark.createDataFrame([(float(x), int(y)) for x, y in zip(a, b)], "a double, b int")
    got = {r["column"]: r for r in describe(df, ["a", "b"], **WAYS[way]).collect()}
    for name, values in (("a", a), ("b", b)):
        for q, p in QUARTILES.items():
            assert got[name][q] == pytest.approx(np.quantile(values, p), rel=1e-12)


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,)], "v double")
    for way in ({}, {"group_rows": 0}, {"group_rows": 0, "bucket_values": 1}):
        row = describe(df, ["v"], **way).first()
        assert (row["n"], row["missing"], row["q50"]) == (2, 1, 2.0)


def test_unknown_or_text_column_fails_at_once(spark):
    df = spark.createDataFrame([("x", 1.0)], "k string, v double")
    with pytest.raises(ValueError, match="does not exist"):
        describe(df, ["nope"])
    with pytest.raises(ValueError, match="not numeric"):
        describe(df, ["k"])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.dictionaries(
        st.sampled_from("abc"),
        st.lists(st.none() | st.floats(-1e12, 1e12), min_size=1, max_size=12),
        min_size=1,
    )
)
def test_any_values(spark, data):
    rows = [(k, v) for k, vs in data.items() for v in vs]
    df = spark.createDataFrame(rows, "k string, v double")
    for way in ({}, {"group_rows": 0}, {"group_rows": 0, "bucket_values": 1}):
        got = {r["k"]: r["q50"] for r in describe(df, ["v"], by=["k"], **way).collect()}
        for key, values in data.items():
            present = [v for v in values if v is not None]
            want = np.quantile(present, 0.5) if present else None
            assert got[key] == (None if want is None else pytest.approx(want, rel=1e-9, abs=1e-9))


def test_crowded_values_spread_over_small_buckets(spark, monkeypatch):
    """100,000 different values within 0.006 %, and as many over 200 magnitudes."""
    rng = np.random.default_rng(9)
    close = 30_000 * (1 + 6e-5 * rng.random(100_000))
    far = 10.0 ** -rng.uniform(3, 200, 100_000)
    df = spark.createDataFrame([("close", float(v)) for v in close] + [("far", float(v)) for v in far], "k string, v double")
    largest = []
    found = Q.order_statistics

    def watch(points, keys, probs):
        cells = points.groupBy(*keys, "bucket_from").count()
        largest.extend(r["count"] for r in cells.collect())
        return found(points, keys, probs)

    monkeypatch.setattr(Q, "order_statistics", watch)
    got = {r["k"]: r for r in describe(df, ["v"], by=["k"], group_rows=0, bucket_values=5_000).collect()}
    for key, values in (("close", close), ("far", far)):
        for name, p in QUARTILES.items():
            assert got[key][name] == pytest.approx(np.quantile(values, p), rel=1e-12)
    assert largest and max(largest) <= 5_000


def test_buckets_of_one_value_are_not_read_again(spark, monkeypatch):
    plans, write = [], staging.write_staged

    def noted(df, *rest):
        plans.append(df)
        return write(df, *rest)

    monkeypatch.setattr(staging, "write_staged", noted)
    size, i = 4567, F.col("id")
    table = spark.range(size).select((i % 5 * 7.0).alias("few"), (i * 1.0).alias("many"))

    def reads(*columns):
        plans.clear()
        plans.append(describe(table, list(columns), rows=size, group_rows=0))
        got = {r["column"]: [r[q] for q in QUARTILES] for r in plans[-1].collect()}
        return got, sum(p._jdf.queryExecution().optimizedPlan().toString().count(f"Range (0, {size}") for p in plans)

    data = {"few": np.arange(size) % 5 * 7.0, "many": np.arange(size) * 1.0}
    want = {c: [pytest.approx(np.quantile(v, p)) for p in QUARTILES.values()] for c, v in data.items()}
    assert reads("few") == ({"few": want["few"]}, 1)
    assert reads("few", "many") == (want, 2)
