from __future__ import annotations

import datetime
import os
import re
import time

import pytest

from salescope.sources import star
from salescope.sources.staging import SHUFFLES_GO

ORDERS = (1, 101, 211, 307, 401, 503)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A star schema of six orders, each with a line on either of two parts, and rows without keys."""
    folder = str(tmp_path_factory.mktemp("star"))
    day = datetime.datetime(2020, 5, 17, 12)
    rows = {
        "region": ([(0, "ASIA")], "r_regionkey int, r_name string"),
        "nation": ([(0, 0)], "n_nationkey int, n_regionkey int"),
        "customer": ([(1, 0, "BUILDING"), (29, 0, "MACHINERY")], "c_custkey long, c_nationkey int, c_mktsegment string"),
        "part": (
            [(1, "Brand#1", "SMALL", 7), (10, "Brand#2", None, None), (None, "Brand#3", "LARGE", 1)],
            "p_partkey long, p_brand string, p_type string, p_size int",
        ),
        "orders": (
            [(o, 29 if o == 503 else 1, 123456.0, day) for o in ORDERS] + [(None, 1, 1.0, day), (2, None, 1.0, day)],
            "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp",
        ),
        "lineitem": (
            [(o, p, n, 5.0, 100.0 + o, "F") for o in ORDERS for p, n in ((1, 1), (10, 1), (10, 3))]
            + [(1, None, 1, 1.0, 1.0, "F"), (None, 1, 1, 1.0, 1.0, "F"), (2, 1, 1, 1.0, 1.0, "F")],
            "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_linestatus string",
        ),
    }
    for name, (data, schema) in rows.items():
        spark.createDataFrame(data, schema).write.parquet(f"{folder}/{name}.parquet")
    return folder


PARTS = {1: ("Brand#1", "SMALL", 2.0), 10: ("Brand#2", None, None)}


def expected(dirty: bool):
    for o in ORDERS:
        for p, n in ((1, 1), (10, 1), (10, 3)):
            model, color, engine = PARTS[p]
            year = {307: 1975, 401: 2035}.get(o, 2020) if dirty else 2020
            region = None if dirty and o == 101 else "ASIA"
            mileage = None if dirty and o == 503 else 60000.0
            price = -100.0 - o if dirty and o == 211 else 100.0 + o
            price = None if dirty and (p + n) % 11 == 0 else price
            volume = None if dirty and (p + n) % 13 == 0 else 5
            fuel = "MACHINERY" if o == 503 else "BUILDING"
            row = (model, year, region, color, fuel, "F", engine, mileage, price, volume)
            yield from [row] * (2 if dirty and o == 503 else 1)


@pytest.mark.parametrize("dirty", [False, True])
def test_sales_of_the_star_schema(spark, tables, dirty):
    rows = (star.dirty_sales if dirty else star.sales)(spark, tables).collect()
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, expected(dirty)))


@pytest.mark.parametrize("table", [star.sales, star.dirty_sales])
def test_columns_are_made_before_the_joins(spark, tables, table):
    """What only serves to make a column is not shuffled; a line item travels twice."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = table(spark, tables)._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    sent = [child for line, child in zip(plan, plan[1:]) if "Exchange hashpartitioning" in line]
    assert sum("transmission" in child for child in sent) == 2
    raw = r"[\[ ](o_totalprice|o_orderdate|p_size|l_linenumber)#\d+[,\]]"
    assert sent and not [child for child in sent if re.search(raw, child)]


def test_staged_rows_are_written_where_they_are(spark, tables):
    """No shuffle and no sort by year comes before the write."""
    assert star.dirty_fact(spark, tables).count() == len(list(expected(True)))
    path, _schema = star._staged[spark.sparkContext.applicationId, tables, "dirty_sales"]
    assert not [name for name in os.listdir(path.removeprefix("file:")) if name.startswith("year=")]


def test_staging_leaves_no_shuffle_files(spark, tables, monkeypatch):
    """The joins' shuffles, several times the written table, go when it is written."""
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = manager.getAllFiles()
        return {n for i in range(files.length()) if (n := files.apply(i).getName()).startswith("shuffle_")}

    monkeypatch.setattr(star, "_staged", {})
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    before, cleanup = shuffled(), spark.conf.get(SHUFFLES_GO)
    try:
        fact = star.sales_fact(spark, tables)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    until = time.time() + 5
    while (left := shuffled() - before) and time.time() < until:
        time.sleep(0.1)
    assert not left and spark.conf.get(SHUFFLES_GO) == cleanup
    assert fact.count() == len(list(expected(False)))


def test_dirty_rows_are_read_once_without_a_table_of_their_own(spark, tables, monkeypatch):
    monkeypatch.setattr(star, "_staged", {})
    assert sorted(map(repr, star.dirty_rows(spark, tables).collect())) == sorted(map(repr, star.dirty_sales(spark, tables).collect()))
    assert star._staged == {}
    written = star.dirty_fact(spark, tables).inputFiles()
    assert written and star.dirty_rows(spark, tables).inputFiles() == written
