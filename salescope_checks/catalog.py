"""Every registered query with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Check:
    query: Query
    sql: str | None


CATALOG: dict[str, Check] = {}
DIGITS = 4


def nudge(digits: int) -> float:
    """Far above the noise of a sum and far below a digit: a mean that lies exactly
    half-way between two rounded values must go the same way in both engines."""
    return 10.0 ** -(digits + 3)


def rounded(df: DataFrame, digits: int) -> DataFrame:
    """Doubles rounded, since sums depend on the order of their terms."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, DoubleType)]
    if not doubles:
        return df
    return df.withColumns({c: F.round(F.col(c) + nudge(digits), digits) for c in doubles})


def add(
    key: str, query: Query, sql: str | None = None, doubles: str = "", digits: int = DIGITS
) -> None:
    """Register a query; ``doubles`` names the columns of its SQL that need rounding."""
    if sql is not None and doubles:
        head, _, body = sql.partition("--body--")
        if not body:
            raise ValueError(f"{key}: SQL needs a --body-- mark")
        cells = ", ".join(
            f"round({c} + {nudge(digits):.{digits + 3}f}::DOUBLE, {digits}) AS {c}" for c in doubles.split()
        )
        sql = f"{head} SELECT * REPLACE ({cells}) FROM ({body})"
    elif sql is not None:
        sql = sql.replace("--body--", "")
    if key in CATALOG:
        raise ValueError(f"{key} is registered twice")
    CATALOG[key] = Check(lambda spark, sf_dir: rounded(query(spark, sf_dir), digits), sql)
