from __future__ import annotations

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from salescope.operators import clean, quality, rules
from tests.conftest import records


def findings(df):
    return {(r["check"], r["column"]): r for r in quality.quality_report(df).collect()}


def varied(make, n=6, **shared):
    """Rows that differ from each other, without any fault."""
    return [{"mileage_km": 10000.0 + i, "price_usd": 20000.0 + i, **shared} for i in range(n)]


def test_clean_table_passes(make):
    df = make(*varied(make))
    assert findings(df) == {}
    assert records(quality.quality_summary(quality.quality_report(df))) == [
        {"passed": True, "errors": 0, "warnings": 0}
    ]


def test_duplicates_count_repeats_and_gaps_are_equal(make):
    rows = varied(make, 3) + [{"region": None}] * 2 + [{"color": None}] * 3
    assert quality.duplicate_rows(make(*rows)).first()[0] == 3


def test_very_many_repeated_hashes(spark):
    df = spark.range(180_000).selectExpr("id div 3 AS a", "if(id % 7 = 0, null, 'x') AS b")
    want = df.count() - df.distinct().count()
    assert want > 50_000
    assert quality.duplicate_rows(df).first()[0] == want


@pytest.mark.parametrize("copied, join", [(10, True), (1900, False)])
def test_rows_without_a_copy_stay_where_they_are(spark, copied, join):
    """A few repeated hashes are broadcast, whatever Catalyst would do; if most rows
    repeat, copies combine before a shuffle instead of travelling to a join."""
    once = spark.range(2000).selectExpr("id AS a", "concat('x', id) AS b")
    df = once.unionByName(once.where(f"a < {copied}"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        counted = quality.duplicate_rows(df)
        plan = counted._jdf.queryExecution().executedPlan().toString()
        assert counted.first()[0] == copied
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert ("BroadcastHashJoin" in plan) == join and "SortMergeJoin" not in plan


def test_bin_numbers_are_no_data(make):
    """A gap in a binned column is one gap; its labels are not checked for typos."""
    df = clean.derive_columns(make(*[{"mileage_km": -1.0 - i} for i in range(10)]))
    stats = records(quality.table_stats(df))[0]
    assert (stats["total_columns"], stats["missing_values"]) == (12, 10)
    missing = [k for k in findings(df) if k[0] == "missing"]
    assert missing == [("missing", "mileage_bin")]
    assert "mileage_bin" not in {r["column"] for r in quality.cardinality(df).collect()}
    assert "mileage_bin_ord" not in {r["column"] for r in quality.missing_share(df).collect()}


def test_duplicate_is_a_warning(make):
    found = findings(make(*varied(make), varied(make)[0]))
    assert set(found) == {("duplicates", "*")}
    assert found["duplicates", "*"]["message"] == "Found 1 duplicate rows"


def test_negatives_are_errors_and_stop_the_run(make):
    bad = {"price_usd": -5.0, "sales_volume": -1.0, "mileage_km": -3.0}
    df = make(*varied(make), bad)
    errors = {k for k, r in findings(df).items() if r["severity"] == "error"}
    assert errors == {("negative", c) for c in ("price_usd", "sales_volume", "mileage_km")}
    with pytest.raises(quality.DataQualityError, match="sales_volume has 1 negative values"):
        quality.quality_gate(df)


def test_unrealistic_year_and_prices_are_warnings(make):
    rows = varied(make) + [{"year": 2035.0}, {"price_usd": 500.0}, {"price_usd": 950000.0}, {"price_usd": 700000.0}]
    found = findings(make(*rows))
    assert found["year_range", "year"]["observed"] == 1
    assert found["price_range", "price_usd"]["observed"] == 2
    assert {r["severity"] for r in found.values()} == {"warning"}
    assert quality.quality_gate(make(*rows)).count() == len(found)


def test_missing_share_is_strict(spark):
    df = spark.createDataFrame([(1, None, None), (2, 1.0, None), (3, None, None), (4, 2.0, 1.0)], "k int, half double, most double")
    got = {r["column"]: (r["missing"], r["missing_pct"], r["flagged"]) for r in quality.missing_share(df).collect()}
    assert got == {"k": (0, 0.0, False), "half": (2, 50.0, False), "most": (3, 75.0, True)}
    assert findings(df)["missing", "most"]["message"] == "most is 75.00% missing"


def test_cardinality_is_strict(spark):
    names = ["a", "b", "c", "d", "e", "f", "g", "a", "a", None]
    rows = [(n, i, "same", f"h{i % 5}") for i, n in enumerate(names)]
    df = spark.createDataFrame(rows, "unique_id string, seq int, category string, half string")
    got = {r["column"]: (r["distinct_values"], r["flagged"]) for r in quality.cardinality(df).collect()}
    assert got == {"unique_id": (7, True), "category": (1, False), "half": (5, False)}
    assert "check for typos" in findings(df)["cardinality", "unique_id"]["message"]


def test_empty_table_has_no_findings(make, spark):
    df = make({}).where("false")
    assert findings(df) == {}
    assert all(r["missing_pct"] == 0 and not r["flagged"] for r in quality.missing_share(df).collect())


def test_table_stats(make):
    df = make({"price_usd": None, "region": None}, {}, {})
    assert records(quality.table_stats(df)) == [
        {"total_rows": 3, "total_columns": 10, "missing_values": 2, "duplicate_rows": 1}
    ]


def test_rules_drop_bad_and_missing_rows(make):
    df = make({}, {"price_usd": -500.0}, {"price_usd": 0.0}, {"price_usd": None}, {"sales_volume": -10.0}, {"sales_volume": 0.0})
    assert rules.rule_price(df).count() == 3
    assert rules.rule_sales(df).count() == 5
    assert rules.enforce_rules(df).count() == 2


def test_year_rule_has_both_ends(make):
    df = make(*[{"year": float(y)} for y in (1979, 1980, 2024, 2025)])
    assert sorted(r["year"] for r in rules.rule_year(df, as_of_year=2024).collect()) == [1980.0, 2024.0]
    import datetime

    this_year = datetime.date.today().year
    now = make({"year": float(this_year)}, {"year": float(this_year + 1)})
    assert rules.enforce_rules(now).count() == 1


def test_absent_columns_are_skipped(spark):
    df = spark.createDataFrame([("x",)], "k string")
    assert rules.enforce_rules(df).count() == 1


def test_observation_counts_removed_rows(make):
    seen = Observation("rules")
    df = make({}, {"price_usd": -1.0}, {"year": 1950.0})
    rules.enforce_rules(df, observation=seen).collect()
    assert seen.get == {"rows_before": 3, "rows_after": 1}
    assert records(rules.removed_rows(df)) == [{"rows_before": 3, "rows_after": 1, "removed": 2}]


def test_own_columns_count_whatever_their_names(spark, make):
    df = clean.bin_mileage(make({}, {}))
    df = df.withColumns({"batch": F.lit("a"), "batch_ord": F.lit(None).cast("int")})
    share = {r["column"]: r for r in quality.missing_share(df).collect()}
    assert "batch_ord" in share and "mileage_bin" in share and "mileage_bin_ord" not in share
    assert "batch" in quality.free_texts(df) and "mileage_bin" not in quality.free_texts(df)
