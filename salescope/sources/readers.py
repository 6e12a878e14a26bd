"""Load a sales table from files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from salescope.schema import (
    REQUIRED_COLUMNS,
    SALES_SCHEMA,
    nan_to_null,
    normalize_headers,
    normalize_name,
    require_columns,
)

READABLE = ("csv", "json", "orc", "parquet")
SPREADSHEETS = ("xlsx", "xls")


def source_format(path: str) -> str:
    """The format named by the extension, in any case."""
    extension = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if extension in SPREADSHEETS:
        raise RuntimeError(f"cannot read {path}: save the workbook as csv or parquet first")
    if extension not in READABLE:
        raise RuntimeError(f"cannot read {path}: unknown extension '{extension}'")
    return extension


def _declared(names: Sequence[str], schema: StructType) -> StructType:
    """Types by normalised name, in the order of the file; unlisted columns are text."""
    types = {f.name: f.dataType for f in schema.fields}
    return StructType([StructField(n, types.get(normalize_name(n), StringType())) for n in names])


def _json_keys(spark: SparkSession, path: str) -> list[str]:
    """The top-level keys of JSON lines, counted map-side in one pass."""
    keys = F.explode(F.json_object_keys("value")).alias("key")
    return sorted(r.key for r in spark.read.text(path).select(keys).distinct().collect())


# What a cell is read as, the first that all filled cells of a column allow: whole numbers
# of up to 18 and up to 38 digits keep every digit. Leading zeros make a code, not a number.
WHOLE = r"^[+-]?[0-9]{{1,{0}}}$"
CODE = r"^[+-]?0[0-9]"
EXTRA_TYPES = {"bigint": WHOLE.format(18), "decimal(38,0)": WHOLE.format(38), "double": None}


def _numeric_extras(df: DataFrame, schema: StructType) -> DataFrame:
    """Text columns outside ``schema`` whose every filled cell is a number, as numbers."""
    extras = [c for c in df.columns if normalize_name(c) not in schema.names]
    if not extras:
        return df
    cells = {c: F.nullif(F.trim(F.col(f"`{c}`")), F.lit("")) for c in extras}
    counts = []
    for i, c in enumerate(extras):
        counts.append(F.count(cells[c]).alias(f"cells{i}"))
        for kind, pattern in EXTRA_TYPES.items():
            fits = cells[c].try_cast(kind).isNotNull() & ~cells[c].rlike(CODE)
            fits = fits & cells[c].rlike(pattern) if pattern else fits
            counts.append(F.count_if(fits).alias(f"{kind}{i}"))
    seen = df.agg(*counts).first()
    found = {}
    for i, c in enumerate(extras):
        kinds = [k for k in EXTRA_TYPES if 0 < seen[f"cells{i}"] == seen[f"{k}{i}"]]
        if kinds:
            found[c] = cells[c].try_cast(kinds[0])
    return df.withColumns(found) if found else df


def scan_sales(
    spark: SparkSession,
    path: str,
    fmt: str | None = None,
    schema: StructType = SALES_SCHEMA,
    required: Sequence[str] = REQUIRED_COLUMNS,
    infer: bool = False,
) -> DataFrame:
    """Read a sales table with normalised headers, typed numbers and NULL gaps.

    Text formats get declared types by the real names: the header of a csv, the keys of
    JSON lines (one pass over them). Cells that do not parse become NULL. A csv folder
    whose files order their columns differently is refused when it is read. Columns that
    are not declared are numbers if every filled cell is one (one more pass over those
    columns, only if there are any), else text; whole numbers keep every digit, and cells
    with leading zeros stay text. ``infer=True`` lets Spark infer instead.
    """
    fmt = fmt or source_format(path)
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
        if infer:
            reader = reader.option("inferSchema", True)
        else:
            header = spark.read.option("header", True).csv(path).columns
            reader = reader.schema(_declared(header, schema)).option("enforceSchema", False)
    elif fmt == "json" and not infer:
        reader = reader.schema(_declared(_json_keys(spark, path), schema))
    df = require_columns(normalize_headers(reader.load(path)), required)
    if fmt in ("csv", "json") and not infer:
        df = _numeric_extras(df, schema)
    return nan_to_null(df)
