"""Sources, sinks, projections, cleaning, quality checks and rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope_checks.catalog import add
from salescope_checks.tables import COLUMNS, on_clean, on_clean_sales, on_dirty, on_sales
from salescope.operators import aggregate, clean, quality, rules
from salescope.plans import charts, report
from salescope.schema import (
    NUMERIC_COLUMNS,
    REQUIRED_COLUMNS,
    normalize_headers,
    numeric_columns,
    require_columns,
    string_columns,
)
from salescope.sources import sinks
from salescope.sources.readers import scan_sales
from salescope.sources.staging import FILE_ROWS, drop_staged, materialize, new_path
from salescope.sources.star import clean_fact, dirty_fact, sales_fact

# ---------------------------------------------------------------- sources


def _plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_fact(spark, sf_dir).select(*REQUIRED_COLUMNS)


def _scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "scan") + ".csv"
    _plain(spark, sf_dir).write.option("header", True).csv(path)
    return scan_sales(spark, path)


AS_DOUBLE = "* REPLACE (CAST(year AS DOUBLE) AS year, CAST(sales_volume AS DOUBLE) AS sales_volume)"
add("scan_sales", _scan_csv, on_sales(f"SELECT {AS_DOUBLE} FROM sales"))


# Plain text takes six (csv) and eighteen (json) times the room of the table, so it is packed.
# A packed file is read by one task: its rows are bounded.
PACKED = {"compression": "lz4", "maxRecordsPerFile": FILE_ROWS}
COPIES = {"csv": {"header": True, **PACKED}, "json": PACKED, "parquet": {}}


def _dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures of each copy, which goes when they are written: one copy at a time takes room."""
    out = None
    for fmt, options in COPIES.items():
        path = new_path(spark, "dispatch") + f".{fmt.upper()}"
        try:
            _plain(spark, sf_dir).write.options(**options).format(fmt).save(path)
            counted = scan_sales(spark, path).agg(
                F.lit(fmt).alias("fmt"),
                F.count("model").alias("n"),
                F.sum("sales_volume").cast("bigint").alias("units"),
            )
            counted = materialize(counted, "dispatched")
        finally:
            drop_staged(spark, path)
        out = counted if out is None else out.unionByName(counted)
    return out


add(
    "source_dispatch",
    _dispatch,
    on_sales(
        "SELECT fmt, n, units FROM (SELECT count(*) AS n, CAST(sum(sales_volume) AS BIGINT) AS units "
        "FROM sales), (VALUES ('csv'), ('json'), ('parquet')) f(fmt)"
    ),
)


def _headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    plain = _plain(spark, sf_dir)
    raw = plain.toDF(*[c.replace("_", " ").title() for c in plain.columns])
    return normalize_headers(raw)


add("normalize_headers", _headers, on_sales("SELECT * FROM sales"))
add(
    "require_columns",
    lambda s, d: require_columns(sales_fact(s, d)).select(*REQUIRED_COLUMNS),
    on_sales("SELECT * FROM sales"),
)

CELLS = """
SELECT transmission, fuel_type, avg(price_usd) AS avg_price_usd,
       CAST(sum(sales_volume) AS BIGINT) AS total_sales_volume, avg(engine_size_l) AS avg_engine_size
FROM fact WHERE transmission IS NOT NULL AND fuel_type IS NOT NULL GROUP BY ALL"""


def _json_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "chart-json")
    chart = charts.price_elasticity(sales_fact(spark, sf_dir))
    sinks.write_json_records(chart, path)
    return spark.read.schema(chart.schema).json(path)


add("chart_json_sink", _json_sink, on_sales(CELLS), "avg_price_usd avg_engine_size")
add(
    "json_records",
    lambda s, d: sinks.json_records(
        aggregate.units_by(sales_fact(s, d), ["year", "region"]), ["year", "region", "units"]
    ),
    on_sales(
        "SELECT '{\"year\":' || year || ',\"region\":\"' || region || '\",\"units\":' || "
        "CAST(sum(sales_volume) AS BIGINT) || '}' AS record FROM fact GROUP BY year, region"
    ),
)


# Written chart -> two keys and a figure that its query compares.
CHART_CELLS = {
    "combined_sales_trend": ("year", "region", "units"),
    "top_models_sales": ("model || ' ' || fuel_type", "year", "units"),
    "price_elasticity": ("transmission", "fuel_type", "avg_price_usd"),
    "engine_price_box": ("engine_size", "fuel_type", "median"),
}


def table_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four written tables, read back: their keys and one figure of each."""
    out = None
    for path in charts.write_charts(sales_fact(spark, sf_dir), new_path(spark, "charts")):
        name = path.rsplit("/", 1)[1]
        one, two, figure = CHART_CELLS[name]
        cells = spark.read.parquet(path).selectExpr(
            f"'{name}' AS chart", f"CAST({one} AS STRING) AS one", f"CAST({two} AS STRING) AS two", f"CAST({figure} AS DOUBLE) AS figure"
        )
        out = cells if out is None else out.unionByName(cells)
    return out


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = rules.enforce_rules(sales_fact(spark, sf_dir))
    return report.run_summary(facts, "sales", "any-model", generated_at="2024-01-01 00:00:00")


add(
    "run_summary",
    _summary,
    on_sales(
        "SELECT '2024-01-01 00:00:00' AS generation_time, 'any-model' AS model, 'sales' AS data_source, "
        "count(*) AS total_records, 'Passed' AS validation_status FROM fact "
        "WHERE price_usd > 0 AND sales_volume >= 0 AND year BETWEEN 1980 AND year(current_date)"
    ),
)

# ---------------------------------------------------------------- projections and filters


def _by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = dirty_fact(spark, sf_dir)
    kinds = {c: "number" for c in numeric_columns(df)} | {c: "string" for c in string_columns(df)}
    counts = df.agg(*[F.count(c).alias(c) for c in kinds])
    cells = [
        F.struct(F.lit(c).alias("column"), F.lit(k).alias("kind"), F.col(c).alias("present"))
        for c, k in kinds.items()
    ]
    return counts.select(F.inline(F.array(*cells)))


add(
    "select_by_type",
    _by_type,
    on_dirty(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", '{'number' if c in NUMERIC_COLUMNS else 'string'}' AS kind, "
            f"count({c}) AS present FROM dirty"
            for c in REQUIRED_COLUMNS
        )
    ),
)


def _dirty_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dirty table as a text file would hold it: numbers as text, gaps as n/a."""
    df = dirty_fact(spark, sf_dir)
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("n/a")) for c in NUMERIC_COLUMNS})


add(
    "coerce_numeric",
    lambda s, d: clean.coerce_numeric(_dirty_text(s, d)),
    on_dirty(f"SELECT {AS_DOUBLE} FROM dirty"),
)
add(
    "truncate_engine",
    lambda s, d: clean.truncate_engine(_plain(s, d)).groupBy("engine_size_l", "engine_size").agg(F.count("*").alias("n")),
    on_sales("SELECT engine_size_l, CAST(trunc(engine_size_l) AS INTEGER) AS engine_size, count(*) AS n FROM sales GROUP BY ALL"),
)
add(
    "cast_year",
    lambda s, d: clean.cast_year(clean.coerce_numeric(dirty_fact(s, d))).groupBy("year").agg(F.count("*").alias("n")),
    on_dirty("SELECT year, count(*) AS n FROM dirty GROUP BY year"),
)
add(
    "bin_mileage",
    lambda s, d: clean.bin_mileage(_plain(s, d)).groupBy("mileage_km", "mileage_bin", "mileage_bin_ord").agg(F.count("*").alias("n")),
    on_sales("SELECT mileage_km, mileage_bin, mileage_bin_ord, count(*) AS n FROM fact GROUP BY ALL"),
)
add(
    "bin_column",
    lambda s, d: clean.bin_column(
        _plain(s, d), "price_usd", "band", (0, 25000, 50000, 100000), ("low", "middle", "high")
    ).select("price_usd", "band", "band_ord"),
    on_sales(
        "SELECT price_usd, CASE WHEN price_usd <= 0 THEN NULL WHEN price_usd <= 25000 THEN 'low' "
        "WHEN price_usd <= 50000 THEN 'middle' WHEN price_usd <= 100000 THEN 'high' END AS band, "
        "CAST(CASE WHEN price_usd <= 0 THEN NULL WHEN price_usd <= 25000 THEN 1 "
        "WHEN price_usd <= 50000 THEN 2 WHEN price_usd <= 100000 THEN 3 END AS INTEGER) AS band_ord FROM sales"
    ),
)
add(
    "revenue",
    lambda s, d: aggregate.with_revenue(_plain(s, d)).groupBy("model").agg(F.sum("revenue").alias("revenue")),
    on_sales("SELECT model, sum(sales_volume * price_usd) AS revenue FROM sales GROUP BY model"),
    "revenue",
    digits=2,
)
add("rule_price", lambda s, d: rules.rule_price(dirty_fact(s, d)), on_dirty("SELECT * FROM dirty WHERE price_usd > 0"))
add("rule_sales", lambda s, d: rules.rule_sales(dirty_fact(s, d)), on_dirty("SELECT * FROM dirty WHERE sales_volume >= 0"))
YEAR_RULE = "year >= 1980 AND year <= year(current_date)"
RULES = f"price_usd > 0 AND sales_volume >= 0 AND {YEAR_RULE}"
add("rule_year", lambda s, d: rules.rule_year(dirty_fact(s, d)), on_dirty(f"SELECT * FROM dirty WHERE {YEAR_RULE}"))
add("enforce_rules", lambda s, d: rules.enforce_rules(dirty_fact(s, d)), on_dirty(f"SELECT * FROM dirty WHERE {RULES}"))
add(
    "removed_rows",
    lambda s, d: rules.removed_rows(clean_fact(s, d)),
    on_clean(
        f"SELECT count(*) AS rows_before, count(*) FILTER (WHERE {RULES}) AS rows_after, "
        f"count(*) - count(*) FILTER (WHERE {RULES}) AS removed FROM clean"
    ),
)
add(
    "current_year",
    lambda s, d: _plain(s, d).agg(F.max("year").alias("last_year")).withColumn("current_year", rules.current_year()),
    on_sales("SELECT max(year) AS last_year, CAST(year(current_date) AS INTEGER) AS current_year FROM sales"),
)
add(
    "filter_equals",
    lambda s, d: _plain(s, d).where(F.col("region") == "ASIA"),
    on_sales("SELECT * FROM sales WHERE region = 'ASIA'"),
)
add(
    "dropna_subset",
    lambda s, d: aggregate.box_points(dirty_fact(s, d)),
    on_dirty("SELECT * FROM dirty WHERE engine_size_l IS NOT NULL AND price_usd IS NOT NULL AND fuel_type IS NOT NULL"),
)
add(
    "dropna_any",
    # Without prices in one fuel, its cells have a gap and go.
    lambda s, d: aggregate.fuel_transmission(
        dirty_fact(s, d).withColumn("price_usd", F.when(F.col("fuel_type") != "MACHINERY", F.col("price_usd")))
    ),
    on_dirty(
        "SELECT transmission, fuel_type, avg(price_usd) AS avg_price_usd, CAST(sum(sales_volume) AS BIGINT) "
        "AS total_sales_volume, avg(engine_size_l) AS avg_engine_size FROM dirty "
        "WHERE transmission IS NOT NULL AND fuel_type <> 'MACHINERY' GROUP BY ALL"
    ),
    "avg_price_usd avg_engine_size",
)
add(
    "null_fn",
    lambda s, d: dirty_fact(s, d).select(
        "model", F.coalesce("region", F.lit("unknown")).alias("region"), F.col("price_usd").isNull().alias("no_price")
    ).groupBy("model", "region", "no_price").agg(F.count("*").alias("n")),
    on_dirty(
        "SELECT model, coalesce(region, 'unknown') AS region, price_usd IS NULL AS no_price, count(*) AS n "
        "FROM dirty GROUP BY ALL"
    ),
)

# ---------------------------------------------------------------- imputation


def _numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.coerce_numeric(dirty_fact(spark, sf_dir))


GROUPED = f"SELECT {COLUMNS} FROM grouped"
add("impute_group_median", lambda s, d: clean.impute_group_median(_numbers(s, d)), on_clean(GROUPED), "price_usd sales_volume")
add(
    "impute_group_median_split",  # every group of over five rows counts as large, a few as hot
    lambda s, d: clean.impute_group_median(_numbers(s, d), group_rows=5, broadcast_rows=200),
    on_clean(GROUPED),
    "price_usd sales_volume",
)
add(
    "impute_global_median",
    lambda s, d: clean.impute_global_median(clean.impute_group_median(_numbers(s, d))),
    on_clean("SELECT * FROM filled_global"),
    "price_usd sales_volume",
)


def _no_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column without any value in part of its rows' table: all of it is missing."""
    return _numbers(spark, sf_dir).withColumn("price_usd", F.lit(None).cast("double"))


add(
    "impute_zero",
    lambda s, d: clean.impute(_no_price(s, d)).groupBy("model").agg(
        F.count("*").alias("n"), F.sum("price_usd").alias("price_usd")
    ),
    on_dirty("SELECT model, count(*) AS n, CAST(0 AS DOUBLE) AS price_usd FROM dirty GROUP BY model"),
)
add("clean_sales", lambda s, d: clean.clean_sales(dirty_fact(s, d)), on_clean("SELECT * FROM clean"), "price_usd sales_volume")
add(
    "join_group_stat",
    lambda s, d: clean.join_group_stat(_plain(s, d), ["model", "year"], "price_usd").select(
        "model", "year", "price_usd", "median_price_usd"
    ),
    on_sales(
        "SELECT model, year, price_usd, median(price_usd) OVER (PARTITION BY model, year) AS median_price_usd FROM sales"
    ),
    "median_price_usd",
)

# ---------------------------------------------------------------- quality

add(
    "dq_duplicates",
    lambda s, d: quality.duplicate_rows(clean_fact(s, d)),
    on_clean("SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM clean)) AS duplicate_rows FROM clean"),
)
NEGATIVE = ("price_usd", "sales_volume", "mileage_km")
add(
    "dq_negative",
    lambda s, d: quality.negative_values(clean_fact(s, d)),
    on_clean(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} < 0) AS negatives FROM clean" for c in NEGATIVE
        )
    ),
)
add(
    "dq_year_range",
    lambda s, d: quality.year_range(clean_fact(s, d)),
    on_clean("SELECT count(*) FILTER (WHERE year < 1900 OR year > 2030) AS unrealistic_years FROM clean"),
)
add(
    "dq_price_range",
    lambda s, d: quality.price_range(clean_fact(s, d)),
    on_clean("SELECT count(*) FILTER (WHERE price_usd < 10000 OR price_usd > 800000) AS unusual_prices FROM clean"),
)
DATA_COLUMNS = (*REQUIRED_COLUMNS, "engine_size", "mileage_bin")
add(
    "dq_missing_pct",
    lambda s, d: quality.missing_share(dirty_fact(s, d)),
    on_dirty(
        "SELECT *, coalesce(missing_pct > 50, false) AS flagged FROM ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing, "
            f"(count(*) - count({c})) * 100.0::DOUBLE / count(*) AS missing_pct FROM dirty"
            for c in REQUIRED_COLUMNS
        )
        + ")"
    ),
    "missing_pct",
)
TEXTS = ("model", "region", "color", "fuel_type", "transmission")
add(
    "dq_cardinality",
    lambda s, d: quality.cardinality(clean_fact(s, d)),
    on_clean(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS distinct_values, "
            f"count(DISTINCT {c}) > count(*) * 0.5 AS flagged FROM clean"
            for c in TEXTS
        )
    ),
)
add(
    "dq_stats",
    lambda s, d: quality.table_stats(clean_fact(s, d)),
    on_clean(
        f"SELECT count(*) AS total_rows, CAST({len(DATA_COLUMNS)} AS BIGINT) AS total_columns, "
        + " + ".join(f"(count(*) - count({c}))" for c in DATA_COLUMNS)
        + " AS missing_values, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM clean)) AS duplicate_rows "
        "FROM clean"
    ),
)


def quality_sql(table: str) -> str:
    checks = [
        ("duplicates", "*", "warning", f"count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {table}))",
         "'Found ' || n || ' duplicate rows'"),
        *[("negative", c, "error", f"count(*) FILTER (WHERE {c} < 0)", f"'{c} has ' || n || ' negative values'")
          for c in NEGATIVE],
        ("year_range", "year", "warning", "count(*) FILTER (WHERE year < 1900 OR year > 2030)",
         "'Found ' || n || ' rows with unrealistic years'"),
        ("price_range", "price_usd", "warning", "count(*) FILTER (WHERE price_usd < 10000 OR price_usd > 800000)",
         "'Found ' || n || ' rows with unusual prices (< $10k or > $800k)'"),
    ]
    parts = [
        f"SELECT '{check}' AS \"check\", '{column}' AS \"column\", '{severity}' AS severity, "
        f"CAST(n AS DOUBLE) AS observed, {message} AS message FROM (SELECT {count} AS n FROM {table}) WHERE n > 0"
        for check, column, severity, count, message in checks
    ]
    return " UNION ALL ".join(parts)


add("dq_report", lambda s, d: quality.quality_report(clean_fact(s, d)), on_clean(quality_sql("clean")))
add(
    "dq_summary",
    lambda s, d: quality.quality_summary(quality.quality_report(clean_fact(s, d))),
    on_clean(
        "SELECT count(*) FILTER (WHERE severity = 'error') = 0 AS passed, "
        "count(*) FILTER (WHERE severity = 'error') AS errors, "
        f"count(*) FILTER (WHERE severity = 'warning') AS warnings FROM ({quality_sql('clean')})"
    ),
)
add(
    "dq_gate",
    lambda s, d: quality.quality_gate(clean.clean_sales(_plain(s, d))),
    on_clean_sales(quality_sql("clean")),
)
