"""Write results: tables, JSON records and text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

# Fixed value: decimals kept in JSON numbers.
JSON_DECIMALS = 10


def json_record(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """One JSON object per row; gaps stay as explicit nulls."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cells = [
        F.round(c, JSON_DECIMALS).alias(c) if isinstance(types[c], (DoubleType, FloatType)) else F.col(c)
        for c in (columns or df.columns)
    ]
    return F.to_json(F.struct(*cells), {"ignoreNullFields": "false"})


def json_records(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The table as one text column ``record`` of JSON objects."""
    return df.select(json_record(df, columns).alias("record"))


def write_json_records(df: DataFrame, path: str) -> None:
    """One JSON object per line, written in parallel."""
    json_records(df).write.mode("overwrite").text(path)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_text(lines: DataFrame, path: str, order_by: Sequence[str], column: str = "line") -> None:
    """Ordered UTF-8 text. The sort is a range sort, so file order is line order."""
    lines.orderBy(*order_by).select(F.coalesce(column, F.lit("")).alias(column)).write.mode(
        "overwrite"
    ).text(path)
