from __future__ import annotations

import json

import pytest

from pyspark.sql import functions as F

from salescope.operators.aggregate import stats_text
from salescope.operators.clean import clean_sales, derive_columns
from salescope.operators.quality import DataQualityError
from salescope.plans import context, report
from salescope.sources import sinks, staging
from salescope.sources.readers import scan_sales, source_format
from salescope.sources.staging import staging_root


@pytest.fixture
def facts(make):
    return clean_sales(
        make(
            {"sales_volume": 1234.0},
            {"model": "B", "year": 2021.0, "price_usd": 50000.5, "region": "South", "mileage_km": 250000.0},
            {"model": "B", "year": 2022.0, "transmission": "Auto", "engine_size_l": 3.5, "fuel_type": None},
        )
    )


def text(df):
    return [r["line"] for r in df.collect()]


def test_context_lines(facts):
    lines = text(context.context_lines(facts))
    assert lines[0] == "***COMPREHENSIVE VEHICLE SALES DATA CONTEXT***"
    assert "* **Total Revenue:** $37,820,005.00" in lines
    assert "* **Total Sales Volume:** 1,254 units" in lines
    assert "* **Time Period:** Data spans from year **2020** to **2022**." in lines
    assert "    * *Yearly Sales Breakdown (Units):* 2020: 1,234, 2021: 10, 2022: 10" in lines
    assert "* **Top 3 Engine Sizes (L):** 2.0L (1,244), 3.5L (10)" in lines
    assert "* **Top 3 Fuel Types:** Petrol (1,244)" in lines
    assert "* **Region: North**" in lines and "    * Most Popular Model: **A**" in lines
    assert "* **0-50k**: Mean Price: $30,000 | Range: $30,000 - $30,000 | Count: 2" in lines
    assert "BREAKDOWN_A: Y2020: S1,234/P$30,000" in lines
    assert "ENGINE_SIZE: 2 | SUMMARY: Growth: -99.19% | Start_Year_Price: $30,000 | End_Year_Price: $50,000" in lines
    assert lines.index("* **Region: North**") < lines.index("* **Region: South**")
    assert not any("None" in line or line is None for line in lines)


def test_context_per_slice(facts):
    rows = context.context_lines(facts, "region").collect()
    assert {r["slice"] for r in rows} == {"North", "South"}
    south = [r["line"] for r in rows if r["slice"] == "South"]
    assert "* **Total Sales Volume:** 10 units" in south
    assert not any("Region: North" in line for line in south)
    assert [r["seq"] for r in rows if r["slice"] == "South" and r["section_no"] == 1] == list(range(1, 16))


def test_prompt_holds_context_and_chart(facts):
    row = context.prompt_rows(facts, directives="Be exact.", role="Analyst.").first()
    assert row["slice"] == "all"
    prompt = row["prompt"]
    for part in ("Be exact.", "--- END OF ANALYTICAL DIRECTIVES ---", "Analyst.", "DATA CONTEXT:\n***COMPREHENSIVE"):
        assert part in prompt
    cells = json.loads(prompt.split(context.JSON_NAME)[1])
    assert cells == [
        {"transmission": "Manual", "fuel_type": "Petrol", "avg_price_usd": 40000.25, "total_sales_volume": 1244.0, "avg_engine_size": 2.0}
    ]


def test_json_keeps_nulls_and_ten_decimals(spark):
    df = spark.createDataFrame([(1.0 / 3, None)], "a double, b string")
    assert json.loads(sinks.json_records(df).first()["record"]) == {"a": 0.3333333333, "b": None}


def test_text_sink_keeps_the_order(facts, spark, tmp_path):
    lines = context.context_lines(facts)
    sinks.write_text(lines, str(tmp_path / "context"), ["slice", "section_no", "seq"])
    parts = sorted((tmp_path / "context").glob("part-*"))
    written = "".join(p.read_text(encoding="utf-8") for p in parts).splitlines()
    assert written == text(lines)


def test_run_report_end_to_end(make, spark, tmp_path):
    raw = make({}, {"price_usd": None, "year": 2021.0}, {"sales_volume": 0.0}, {"year": 1950.0})
    names = [c.replace("_", " ").title() for c in reversed(raw.columns)]
    raw.select(*reversed(raw.columns)).toDF(*names).write.option("header", True).csv(str(tmp_path / "in.csv"))
    config = report.ReportConfig(str(tmp_path / "in.csv"), str(tmp_path / "out"), model_name="m")
    row = report.run_report(spark, config).first()
    assert (row["total_records"], row["validation_status"], row["model"]) == (3, "Passed", "m")
    assert (row["rows_read"], row["removed_records"], len(row["warnings"])) == (4, 1, 0)
    assert spark.read.parquet(str(tmp_path / "out/summary")).first() == row
    assert spark.read.parquet(str(tmp_path / "out/prompts")).count() == 1
    for name in ("combined_sales_trend", "top_models_sales", "price_elasticity", "engine_price_box"):
        assert spark.read.parquet(str(tmp_path / "out/charts" / name)).count() > 0


def test_gate_stops_the_run(make):
    with pytest.raises(DataQualityError):
        report.prepare(make({}, {"price_usd": -1.0}))
    assert report.prepare(make({}, {"price_usd": -1.0}), gate=False).count() == 1


def test_csv_columns_are_matched_by_name(make, spark, tmp_path):
    path = str(tmp_path / "sales.CSV")
    df = make({"model": "Z"}, {"price_usd": None})
    df.select("price_usd", *[c for c in df.columns if c != "price_usd"]).withColumnRenamed("model", "Model").selectExpr(
        "*", "'x' AS `Extra Column`"
    ).write.option("header", True).csv(path)
    got = scan_sales(spark, path)
    assert got.where("model = 'Z'").first()["price_usd"] == 30000.0
    assert dict(got.dtypes)["extra_column"] == "string"
    assert got.where("price_usd IS NULL").count() == 1
    assert dict(scan_sales(spark, path, infer=True).dtypes)["year"] == "double"


def test_unreadable_sources(spark, make, tmp_path):
    for path in ("book.xlsx", "book.XLS", "data.txt"):
        with pytest.raises(RuntimeError, match="cannot read"):
            source_format(path)
    make({}).drop("color").write.parquet(str(tmp_path / "x.parquet"))
    with pytest.raises(ValueError, match="color"):
        scan_sales(spark, str(tmp_path / "x.parquet"))


def test_staging_follows_the_session(spark):
    assert staging_root(spark) == spark.conf.get("spark.checkpoint.dir", staging_root(spark))


def test_warnings_of_the_gate_are_in_the_record(make, spark, tmp_path):
    path = str(tmp_path / "in.parquet")
    make({}, {}, {"price_usd": 5000.0, "year": 2021.0}, {"year": 2040.0}).write.parquet(path)
    row = report.run_report(spark, report.ReportConfig(path, str(tmp_path / "out"))).first()
    assert row["warnings"] == [
        "Found 1 duplicate rows",
        "Found 1 rows with unrealistic years",
        "Found 1 rows with unusual prices (< $10k or > $800k)",
    ]
    assert (row["rows_read"], row["total_records"], row["removed_records"]) == (4, 3, 1)
    assert spark.read.parquet(str(tmp_path / "out/warnings")).count() == 3


def test_prompts_of_built_lines_are_the_same_and_read_nothing_again(facts):
    built = context.build_context(facts, "region")
    assert built.rows == 3
    assert sorted(context.prompt_rows(facts, "region", built=built).collect()) == sorted(context.prompt_rows(facts, "region").collect())


@pytest.mark.parametrize("column", ["price_usd", "mileage_km", "engine_size_l"])
@pytest.mark.parametrize("as_text", [True, False])
def test_a_measure_that_is_no_number_is_not_available(facts, column, as_text):
    odd = facts.withColumn(column, facts[column].cast("string")) if as_text else facts.drop(column)
    lines = text(context.context_lines(odd))
    assert f"* *Error or data not available for {column} statistics.*" in lines
    assert "* **Total Sales Volume:** 1,254 units" in lines
    priced = any("Mean Price:" in line and "Count" in line for line in lines)
    assert priced == (column != "price_usd")
    noted = "* *Error or data not available for model price_usd statistics.*" in lines
    assert noted == (column == "price_usd")


def test_an_absent_group_is_not_available(facts):
    lines = text(context.context_lines(facts.drop("transmission", "color")))
    assert "* *Error or data not available for transmission price_usd statistics.*" in lines
    assert "* **Top 3 Colors:** N/A" in lines or "* **Top 3 Colors:** " in lines
    assert any(line.startswith("FUEL_TYPE: ") for line in lines)
    assert not any(line.startswith("TRANSMISSION: ") for line in lines)


def test_whole_numbers_are_shown_plainly(spark):
    df = spark.createDataFrame([(1234, 0.5), (5678, None)], "units long, price double")
    rows = {r["column"]: r for r in stats_text(df, ["units", "price"]).collect()}
    assert (rows["units"]["min"], rows["units"]["max"], rows["units"]["mean"]) == ("1234", "5678", "3,456.00")
    assert (rows["price"]["min"], rows["price"]["count"], rows["price"]["missing"]) == ("0.50", "1", "1")


def test_items_are_rolled_up_from_a_few_scanned_sets(make):
    """Every row enters four groups, not one per set of the report; gaps in keys stay apart."""
    rows = []
    for i in range(120):
        rows.append(
            {
                "model": ("A", "B", "C", None)[i % 4],
                "year": None if i % 17 == 0 else float(2018 + i % 3),
                "region": (None, "North", "South")[i % 3],
                "fuel_type": ("P", "D", None)[i // 7 % 3],
                "transmission": ("M", None)[i // 5 % 2],
                "color": ("red", "blue")[i % 2],
                "engine_size_l": (1.6, 2.0, None)[i // 2 % 3],
                "mileage_km": (1e4, 6e4, 3e5)[i % 3],
                "price_usd": None if i % 11 == 0 else 1000.0 + i,
                "sales_volume": None if i % 13 == 0 else float(i),
            }
        )
    facts = derive_columns(make(*rows)).withColumn("slice", F.lit(context.WHOLE))
    items = context.report_items(facts)
    nodes = items._jdf.queryExecution().optimizedPlan().toString().splitlines()
    expand = [x for x in nodes if "Expand" in x]
    # Projections and the output columns are lists with this between them.
    assert len(expand) == 1 and expand[0].count("], [") == len(context.SCANNED) == 4

    got = {(r["family"], r["item"], r["second"]): r for r in items.collect()}
    for family, column in (("region", "region"), ("model", "model"), ("color", "color"), ("mileage_bin", "mileage_bin"), ("engine_size_l", "engine_size_l")):
        for value in {r[column] for r in facts.collect()} - {None}:
            of = [r for r in facts.collect() if r[column] == value]
            item = got.pop((family, str(value), None))
            assert item["rows_n"] == len(of)
            assert item["units"] == sum(r["sales_volume"] or 0 for r in of)
            priced = [r["price_usd"] for r in of if r["price_usd"] is not None]
            assert (item["price"], item["price_n"], item["min_price"], item["max_price"]) == (sum(priced), len(priced), min(priced), max(priced))
            if family in ("region", "model"):
                years = sorted({r["year"] for r in of} - {None})
                shown = [(e["year"], e["units"]) for e in item["series"]] if family == "model" else None
                assert shown in (None, [(y, sum(r["sales_volume"] or 0 for r in of if r["year"] == y)) for y in years])
    cells = {(r["transmission"], r["fuel_type"]) for r in facts.collect()}
    assert {k[1:] for k in got if k[0] == "cell"} == {c for c in cells if None not in c}
    assert got[("total", None, None)]["rows_n"] == 120
    assert not [k for k in got if k[0] in ("region", "model", "color", "mileage_bin", "engine_size_l")]


def test_written_tables_are_cut_into_files_of_bounded_rows(spark, monkeypatch):
    monkeypatch.setattr(staging, "FILE_ROWS", 10)
    table = staging.materialize(spark.range(0, 95, 1, 1), "cut")
    assert len(table.inputFiles()) == 10 and table.count() == 95
