"""Data-quality checks as tables, and the gate that stops on errors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from salescope.functions.formats import fixed
from salescope.schema import (
    BINS_OF,
    CARDINALITY_SHARE_LIMIT,
    MISSING_PERCENT_LIMIT,
    NON_NEGATIVE_COLUMNS,
    PLAUSIBLE_PRICES,
    PLAUSIBLE_YEARS,
    numeric_columns,
    string_columns,
)
from salescope.sources.staging import materialize

# So many row hashes may be broadcast: 8 MB of them.
BROADCAST_HASHES = 1_000_000
# The messages of the quality report.
DUPLICATES_MESSAGE = "Found %s duplicate rows"
NEGATIVE_MESSAGE = "%s has %s negative values"
YEARS_MESSAGE = "Found %s rows with unrealistic years"
PRICES_MESSAGE = "Found %s rows with unusual prices (< $10k or > $800k)"
MISSING_MESSAGE = "%s is %s%% missing"
CARDINALITY_MESSAGE = "%s has high cardinality (%s unique values) - check for typos"


class DataQualityError(ValueError):
    """The table has errors, as opposed to warnings."""


def _outside(column: str, bounds: tuple[float, float]) -> Column:
    return (F.col(column) < bounds[0]) | (F.col(column) > bounds[1])


def data_columns(df: DataFrame) -> list[str]:
    """The columns without the helpers that number a binned column's bins, known by
    their metadata: a table's own columns count, whatever their names."""
    return [f.name for f in df.schema.fields if BINS_OF not in (f.metadata or {})]


def free_texts(df: DataFrame) -> list[str]:
    """The text columns that are read, not derived: a binned column's labels are fixed."""
    binned = {(f.metadata or {}).get(BINS_OF) for f in df.schema.fields}
    return [c for c in string_columns(df) if c not in binned]


def duplicate_rows(df: DataFrame) -> DataFrame:
    """How many rows repeat an earlier one in all columns (gaps equal gaps).

    Only 8-byte row hashes are shuffled at first. Rows whose hash occurs more than
    once are then compared in full, so colliding hashes do no harm; copies of a row
    combine map-side, however many there are. A bounded number of repeated hashes is
    broadcast, so that the other rows stay where they are. Where there are more, or most
    rows repeat, all rows are compared without a join, whose shuffle would carry each copy.
    """
    hashed, seen = df.withColumn("row_hash", F.xxhash64(*df.columns)), Observation()
    repeats = F.col("count") > 1
    counted = hashed.groupBy("row_hash").count()
    counted = counted.observe(
        seen,
        F.count_if(repeats).alias("hashes"),
        F.coalesce(F.sum(F.when(repeats, F.col("count"))), F.lit(0)).alias("suspects"),
        F.coalesce(F.sum("count"), F.lit(0)).alias("rows"),
    )
    repeated = materialize(counted.where(repeats).select("row_hash"), "repeated-hashes")
    found = seen.get
    if found["hashes"] == 0:  # the usual case: the table is not read again
        return df.sparkSession.range(0, 1, 1, 1).select(F.lit(0).cast("bigint").alias("duplicate_rows"))
    suspects = df
    if found["hashes"] <= BROADCAST_HASHES and 2 * found["suspects"] <= found["rows"]:
        suspects = hashed.join(F.broadcast(repeated), "row_hash", "left_semi")
    return (
        suspects.groupBy(*df.columns)
        .agg(F.count(F.lit(1)).alias("copies"))
        .agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"))
    )


def _long(counts: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """A one-row table of counts as rows (column, count)."""
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).alias(name)) for c in columns]
    return counts.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")


def negative_values(df: DataFrame, columns: Sequence[str] = NON_NEGATIVE_COLUMNS) -> DataFrame:
    present = [c for c in columns if c in numeric_columns(df)]
    counts = df.agg(*[F.count_if(F.col(c) < 0).alias(c) for c in present])
    return _long(counts, present, "negatives")


def year_range(df: DataFrame, column: str = "year") -> DataFrame:
    return df.agg(F.count_if(_outside(column, PLAUSIBLE_YEARS)).alias("unrealistic_years"))


def price_range(df: DataFrame, column: str = "price_usd") -> DataFrame:
    return df.agg(F.count_if(_outside(column, PLAUSIBLE_PRICES)).alias("unusual_prices"))


def _missing_percent(missing: Column, rows: Column) -> Column:
    return F.coalesce(F.try_divide(missing * 100.0, rows), F.lit(0.0))


def missing_share(df: DataFrame) -> DataFrame:
    """Per column the missing cells, their percentage, and whether it is over the limit."""
    total = "__rows"
    counts = df.agg(
        F.count(F.lit(1)).alias(total), *[F.count_if(F.col(c).isNull()).alias(c) for c in data_columns(df)]
    )
    cells = [
        F.struct(F.lit(c).alias("column"), F.col(c).alias("missing"), F.col(total).alias("rows"))
        for c in data_columns(df)
    ]
    share = _missing_percent(F.col("missing"), F.col("rows"))
    return (
        counts.select(F.explode(F.array(*cells)).alias("cell"))
        .select("cell.*")
        .select(
            "column",
            "missing",
            share.alias("missing_pct"),
            (share > MISSING_PERCENT_LIMIT).alias("flagged"),
        )
    )


def cardinality(df: DataFrame) -> DataFrame:
    """Per text column its distinct values, flagged above half the rows.

    One pass counts (column, value) pairs; the second grouping sees only
    distinct values, so no task gathers all values of a column at once.
    """
    columns = free_texts(df)
    pairs = df.select(*columns).unpivot([], columns, "column", "value")
    counted = pairs.groupBy("column", "value").agg(F.count(F.lit(1)).alias("rows"))
    per_column = counted.groupBy("column").agg(
        F.count("value").alias("distinct_values"), F.sum("rows").alias("rows")
    )
    return per_column.select(
        "column",
        "distinct_values",
        (F.col("distinct_values") > F.col("rows") * CARDINALITY_SHARE_LIMIT).alias("flagged"),
    )


def table_stats(df: DataFrame) -> DataFrame:
    """Rows, columns, missing cells and duplicate rows; bin numbers are no data."""
    missing = F.lit(0).cast("bigint")
    columns = data_columns(df)
    for c in columns:
        missing = missing + F.count_if(F.col(c).isNull())
    sizes = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.lit(len(columns)).cast("bigint").alias("total_columns"),
        missing.alias("missing_values"),
    )
    return sizes.withColumn("duplicate_rows", duplicate_rows(df).scalar())


def _row_counts(df: DataFrame) -> DataFrame:
    """All row-local checks in one aggregate, as rows of the report."""
    total = F.count(F.lit(1))
    numeric = numeric_columns(df)
    checks: list[tuple[str, str, str, Column, str]] = []
    for c in NON_NEGATIVE_COLUMNS:
        if c in numeric:
            checks.append(("negative", c, "error", F.count_if(F.col(c) < 0), NEGATIVE_MESSAGE))
    if "year" in numeric:
        out = F.count_if(_outside("year", PLAUSIBLE_YEARS))
        checks.append(("year_range", "year", "warning", out, YEARS_MESSAGE))
    if "price_usd" in numeric:
        out = F.count_if(_outside("price_usd", PLAUSIBLE_PRICES))
        checks.append(("price_range", "price_usd", "warning", out, PRICES_MESSAGE))
    for c in data_columns(df):
        share = _missing_percent(F.count_if(F.col(c).isNull()), total)
        over = F.when(share > MISSING_PERCENT_LIMIT, share).otherwise(0.0)
        checks.append(("missing", c, "warning", over, MISSING_MESSAGE))

    counts = df.agg(*[value.cast("double").alias(f"check_{i}") for i, (*_, value, _m) in enumerate(checks)])
    cells = []
    for i, (check, column, severity, _value, message) in enumerate(checks):
        observed = F.col(f"check_{i}")
        if check == "missing":
            text = F.expr(fixed(f"check_{i}", 2, grouped=False))
        else:
            text = observed.cast("bigint").cast("string")
        args = [F.lit(column), text] if message.startswith("%s") else [text]
        cells.append(
            F.struct(
                F.lit(check).alias("check"),
                F.lit(column).alias("column"),
                F.lit(severity).alias("severity"),
                observed.alias("observed"),
                F.format_string(message, *args).alias("message"),
            )
        )
    return counts.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")


def quality_report(df: DataFrame) -> DataFrame:
    """One row per finding: check, column, severity, observed, message."""
    duplicates = duplicate_rows(df).select(
        F.lit("duplicates").alias("check"),
        F.lit("*").alias("column"),
        F.lit("warning").alias("severity"),
        F.col("duplicate_rows").cast("double").alias("observed"),
        F.format_string(DUPLICATES_MESSAGE, F.col("duplicate_rows").cast("string")).alias("message"),
    )
    findings = duplicates.unionByName(_row_counts(df)).where("observed > 0")
    if free_texts(df):
        crowded = cardinality(df).where("flagged")
        findings = findings.unionByName(
            crowded.select(
                F.lit("cardinality").alias("check"),
                "column",
                F.lit("warning").alias("severity"),
                F.col("distinct_values").cast("double").alias("observed"),
                F.format_string(
                    CARDINALITY_MESSAGE, F.col("column"), F.col("distinct_values").cast("string")
                ).alias("message"),
            )
        )
    return findings


def quality_summary(report: DataFrame) -> DataFrame:
    """Passed is the absence of errors; warnings do not count against it."""
    errors = F.count_if(F.col("severity") == "error")
    return report.agg(
        (errors == 0).alias("passed"),
        errors.alias("errors"),
        F.count_if(F.col("severity") == "warning").alias("warnings"),
    )


def quality_gate(df: DataFrame) -> DataFrame:
    """Return the table's report, or raise when it holds errors.

    The report has a few rows per column, whatever the size of the table.
    """
    report = materialize(quality_report(df), "quality-report")
    errors = [r["message"] for r in report.where("severity = 'error'").collect()]
    if errors:
        raise DataQualityError("; ".join(errors))
    return report
