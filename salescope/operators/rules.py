"""Business rules: row-local filters, each applied where its column exists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from salescope.schema import FIRST_SALES_YEAR


def current_year() -> Column:
    return F.year(F.current_date())


def _price_rule(column: str) -> Column:
    return F.col(column) > 0


def _sales_rule(column: str) -> Column:
    return F.col(column) >= 0


def _year_rule(column: str, as_of_year: int | None) -> Column:
    last = current_year() if as_of_year is None else F.lit(as_of_year)
    return F.col(column).between(F.lit(FIRST_SALES_YEAR), last)


def rule_price(df: DataFrame, column: str = "price_usd") -> DataFrame:
    """Keep positive prices."""
    return df.where(_price_rule(column)) if column in df.columns else df


def rule_sales(df: DataFrame, column: str = "sales_volume") -> DataFrame:
    """Keep units of zero or more."""
    return df.where(_sales_rule(column)) if column in df.columns else df


def rule_year(df: DataFrame, column: str = "year", as_of_year: int | None = None) -> DataFrame:
    """Keep years from 1980 up to this year (or the given one)."""
    return df.where(_year_rule(column, as_of_year)) if column in df.columns else df


def _keep(df: DataFrame, as_of_year: int | None) -> Column:
    keep = F.lit(True)
    if "price_usd" in df.columns:
        keep = keep & _price_rule("price_usd")
    if "sales_volume" in df.columns:
        keep = keep & _sales_rule("sales_volume")
    if "year" in df.columns:
        keep = keep & _year_rule("year", as_of_year)
    return keep


def enforce_rules(
    df: DataFrame, as_of_year: int | None = None, observation: Observation | None = None
) -> DataFrame:
    """All three rules in one filter.

    An ``observation`` collects ``rows_before`` and ``rows_after`` while the
    result is computed, without a pass of its own.
    """
    keep = _keep(df, as_of_year)
    if observation is not None:
        df = df.observe(
            observation,
            F.count(F.lit(1)).alias("rows_before"),
            F.count_if(keep).alias("rows_after"),
        )
    return df.where(keep)


def removed_rows(df: DataFrame, as_of_year: int | None = None) -> DataFrame:
    """How many rows the rules remove, from one aggregate."""
    before, after = F.count(F.lit(1)), F.count_if(_keep(df, as_of_year))
    return df.agg(
        before.alias("rows_before"), after.alias("rows_after"), (before - after).alias("removed")
    )
