"""A sales table from a star schema of orders, parts, customers and regions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from salescope.operators.clean import clean_sales, derive_columns
from salescope.schema import REQUIRED_COLUMNS
from salescope.sources.staging import read_staged, shuffles_go, write_staged

_staged: dict[tuple[str, str, str], tuple[str, StructType]] = {}


def _joined(spark: SparkSession, sf_dir: str, of_line: dict[str, Column], of_order: dict[str, Column]) -> DataFrame:
    """Line items with parts and orders, with what is made of their columns alone.

    No join hints: file sizes decide what is broadcast and what is shuffled. Columns are
    made before the joins, so that a line item travels with its own figures to the parts
    and with theirs to the orders, which come last: lines of an order end up side by side.
    """

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    buyers = (
        table("customer")
        .join(table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", F.col("c_mktsegment").alias("fuel_type"), F.col("r_name").alias("region"))
    )
    orders = (
        table("orders")
        .select("o_orderkey", "o_custkey", *[c.alias(n) for n, c in of_order.items()])
        .join(buyers, F.col("o_custkey") == F.col("c_custkey"))
        .drop("o_custkey", "c_custkey")
    )
    parts = table("part").select(
        "p_partkey",
        F.col("p_brand").alias("model"),
        F.col("p_type").alias("color"),
        (F.lit(1.5) + (F.col("p_size") % 6) * F.lit(0.5)).alias("engine_size_l"),
    )
    lines = table("lineitem").select(
        "l_orderkey", "l_partkey", F.col("l_linestatus").alias("transmission"), *[c.alias(n) for n, c in of_line.items()]
    )
    return (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .drop("l_partkey", "p_partkey")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    )


def _order_columns() -> dict[str, Column]:
    return {
        "year": F.year("o_orderdate"),
        "mileage_km": (F.floor(F.col("o_totalprice") / 10000) * 5000).cast("double"),
    }


def _line_columns() -> dict[str, Column]:
    return {"price_usd": F.col("l_extendedprice"), "sales_volume": F.col("l_quantity").cast("bigint")}


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sales record per line item."""
    return _joined(spark, sf_dir, _line_columns(), _order_columns()).select(*REQUIRED_COLUMNS)


def dirty_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``sales`` with repeated rows, gaps, negative prices and impossible years."""
    order, customer = F.col("o_orderkey"), F.col("o_custkey")
    line = F.col("l_partkey") + F.col("l_linenumber")
    of_line, of_order = _line_columns(), _order_columns()
    of_line["price_usd"] = F.when(line % 11 != 0, of_line["price_usd"])
    of_line["sales_volume"] = F.when(line % 13 != 0, of_line["sales_volume"])
    of_order["year"] = F.when(order % 307 == 0, 1975).when(order % 401 == 0, 2035).otherwise(of_order["year"])
    of_order["mileage_km"] = F.when(customer % 29 != 0, of_order["mileage_km"])
    copies = F.when(order % 503 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (
        _joined(spark, sf_dir, of_line, of_order)
        .withColumn("copy", F.explode(copies))
        .withColumns(
            {
                "region": F.when(order % 101 != 0, F.col("region")),
                "price_usd": F.when(order % 211 == 0, -F.col("price_usd")).otherwise(F.col("price_usd")),
            }
        )
        .select(*REQUIRED_COLUMNS)
    )


def _stage(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """Write a derived table once per application and scan it afterwards."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _staged:
        df = build(spark, sf_dir)
        with shuffles_go(spark):
            _staged[key] = (write_staged(df, name), df.schema)
    return read_staged(spark, *_staged[key])


def sales_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined table with its derived columns, written once."""
    return _stage(spark, sf_dir, "sales", lambda s, d: derive_columns(sales(s, d)))


def dirty_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stage(spark, sf_dir, "dirty_sales", dirty_sales)


def dirty_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``dirty_fact`` for a single reader: its table if that is written, else
    the joins themselves, so that no table is written only to be copied."""
    if (spark.sparkContext.applicationId, sf_dir, "dirty_sales") in _staged:
        return dirty_fact(spark, sf_dir)
    return dirty_sales(spark, sf_dir)


def clean_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned dirty table."""
    return _stage(spark, sf_dir, "clean_sales", lambda s, d: clean_sales(dirty_fact(s, d)))
