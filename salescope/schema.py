"""Column contract of a sales table and plan-time checks on it."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    FloatType,
    IntegralType,
    NumericType,
    StringType,
    StructField,
    StructType,
)

# The required columns, the keys of the group fill, the mileage
# bins and the bounds of the quality checks and business rules.
REQUIRED_COLUMNS = (
    "model",
    "year",
    "region",
    "color",
    "fuel_type",
    "transmission",
    "engine_size_l",
    "mileage_km",
    "price_usd",
    "sales_volume",
)
IMPUTE_KEYS = ("model", "year", "engine_size_l", "mileage_km", "transmission")
MILEAGE_EDGES = (0, 50000, 100000, 150000, 200000)
MILEAGE_LABELS = ("0-50k", "50k-100k", "100k-150k", "150k-200k")
NON_NEGATIVE_COLUMNS = ("price_usd", "sales_volume", "mileage_km")
PLAUSIBLE_YEARS = (1900, 2030)
PLAUSIBLE_PRICES = (10000, 800000)
MISSING_PERCENT_LIMIT = 50
CARDINALITY_SHARE_LIMIT = 0.5
FIRST_SALES_YEAR = 1980

TEXT_COLUMNS = ("model", "region", "color", "fuel_type", "transmission")
NUMERIC_COLUMNS = ("year", "engine_size_l", "mileage_km", "price_usd", "sales_volume")

# Numbers are read as double so that "2020", "2020.0" and gaps all load;
# cleaning turns the year into an integer after its gaps are filled.
SALES_SCHEMA = StructType(
    [
        StructField(name, StringType() if name in TEXT_COLUMNS else DoubleType())
        for name in REQUIRED_COLUMNS
    ]
)


# The metadata key of a column that numbers the bins of another one.
BINS_OF = "bins_of"


def normalize_name(name: str) -> str:
    return name.lower().replace(" ", "_")


def normalize_headers(df: DataFrame) -> DataFrame:
    """Lower-case the column names and turn spaces into underscores."""
    return df.toDF(*[normalize_name(c) for c in df.columns])


def require_columns(df: DataFrame, required: Iterable[str] = REQUIRED_COLUMNS) -> DataFrame:
    """Fail before any job runs when required columns are absent; extras may stay."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"input is missing required columns: {missing}")
    return df


def numeric_columns(df: DataFrame) -> list[str]:
    """Columns of a numeric type (booleans are not numbers)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def whole_columns(df: DataFrame) -> list[str]:
    """Columns of a type without fractions."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, IntegralType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def require_numeric(df: DataFrame, *columns: str) -> None:
    """Fail before any job runs when a column is unknown or not numeric."""
    for column in columns:
        if column not in df.columns:
            raise ValueError(f"column '{column}' does not exist")
        if column not in numeric_columns(df):
            raise ValueError(f"column '{column}' is not numeric")


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing is NULL everywhere: NaN would poison sums and pass every `>` test."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows without a group key belong to no group. IS NOT NULL reaches the file scan."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))}
    for key in keys:
        df = df.where(F.col(key).isNotNull())
        if key in floats:
            df = df.where(~F.isnan(key))
    return df
