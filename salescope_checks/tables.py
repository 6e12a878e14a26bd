"""SQL definitions of the input tables, the counterpart of ``salescope.sources.star``."""

BASE = """
base AS (
  SELECT p_brand AS model, CAST(year(o_orderdate) AS INTEGER) AS year, r_name AS region,
         p_type AS color, c_mktsegment AS fuel_type, l_linestatus AS transmission,
         CAST(1.5 + (p_size % 6) * 0.5 AS DOUBLE) AS engine_size_l,
         CAST(floor(o_totalprice / 10000) * 5000 AS DOUBLE) AS mileage_km,
         l_extendedprice AS price_usd, CAST(l_quantity AS BIGINT) AS sales_volume,
         o_orderkey, o_custkey, l_partkey, l_linenumber
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
)"""

COLUMNS = (
    "model, year, region, color, fuel_type, transmission, engine_size_l, mileage_km, "
    "price_usd, sales_volume"
)

MILEAGE_BIN = """
CASE WHEN mileage_km <= 0 THEN NULL WHEN mileage_km <= 50000 THEN '0-50k'
     WHEN mileage_km <= 100000 THEN '50k-100k' WHEN mileage_km <= 150000 THEN '100k-150k'
     WHEN mileage_km <= 200000 THEN '150k-200k' END"""
MILEAGE_BIN_ORD = """
CAST(CASE WHEN mileage_km <= 0 THEN NULL WHEN mileage_km <= 50000 THEN 1
     WHEN mileage_km <= 100000 THEN 2 WHEN mileage_km <= 150000 THEN 3
     WHEN mileage_km <= 200000 THEN 4 END AS INTEGER)"""
DERIVED = (
    f"CAST(trunc(engine_size_l) AS INTEGER) AS engine_size, {MILEAGE_BIN} AS mileage_bin, "
    f"{MILEAGE_BIN_ORD} AS mileage_bin_ord"
)

SALES = f"""
sales AS (SELECT {COLUMNS} FROM base),
fact AS MATERIALIZED (SELECT *, {DERIVED} FROM sales)"""

DIRTY = """
doubled AS (
  SELECT * FROM base UNION ALL SELECT * FROM base WHERE o_orderkey % 503 = 0
),
dirty AS MATERIALIZED (
  SELECT model,
         CAST(CASE WHEN o_orderkey % 307 = 0 THEN 1975 WHEN o_orderkey % 401 = 0 THEN 2035
              ELSE year END AS INTEGER) AS year,
         CASE WHEN o_orderkey % 101 <> 0 THEN region END AS region,
         color, fuel_type, transmission, engine_size_l,
         CASE WHEN o_custkey % 29 <> 0 THEN mileage_km END AS mileage_km,
         CASE WHEN (l_partkey + l_linenumber) % 11 <> 0
              THEN CASE WHEN o_orderkey % 211 = 0 THEN -price_usd ELSE price_usd END END AS price_usd,
         CASE WHEN (l_partkey + l_linenumber) % 13 <> 0 THEN sales_volume END AS sales_volume
  FROM doubled
)"""

KEYED = (
    "model IS NOT NULL AND year IS NOT NULL AND engine_size_l IS NOT NULL "
    "AND mileage_km IS NOT NULL AND transmission IS NOT NULL"
)
GROUP = "PARTITION BY model, year, engine_size_l, mileage_km, transmission"


def cleaning(source: str) -> str:
    """CTEs numbers, grouped (group fill), filled (global fill) and clean."""
    return f"""
numbers AS (
  SELECT * REPLACE (CAST(year AS DOUBLE) AS year, CAST(sales_volume AS DOUBLE) AS sales_volume)
  FROM {source}
),
grouped AS MATERIALIZED (
  SELECT * REPLACE (
    CASE WHEN {KEYED} THEN coalesce(price_usd, median(price_usd) OVER ({GROUP})) ELSE price_usd END
      AS price_usd,
    CASE WHEN {KEYED} THEN coalesce(sales_volume, median(sales_volume) OVER ({GROUP}))
      ELSE sales_volume END AS sales_volume)
  FROM numbers
),
medians AS MATERIALIZED (
  SELECT median(year) AS m_year, median(engine_size_l) AS m_engine, median(mileage_km) AS m_mileage,
         median(price_usd) AS m_price, median(sales_volume) AS m_volume FROM grouped
),
filled_global AS (
  SELECT {COLUMNS} FROM (
    SELECT * REPLACE (
      coalesce(year, m_year) AS year, coalesce(engine_size_l, m_engine) AS engine_size_l,
      coalesce(mileage_km, m_mileage) AS mileage_km, coalesce(price_usd, m_price) AS price_usd,
      coalesce(sales_volume, m_volume) AS sales_volume)
    FROM grouped, medians)
),
clean AS MATERIALIZED (
  SELECT * REPLACE (CAST(trunc(coalesce(year, 0)) AS INTEGER) AS year), {DERIVED}
  FROM filled_global
)"""


def with_tables(sql: str, *tables: str) -> str:
    """The statement after its tables; the mark lets ``salescope_checks.catalog`` wrap it."""
    return f"WITH {', '.join((BASE, *tables))} --body-- {sql}"


def on_sales(sql: str) -> str:
    return with_tables(sql, SALES)


def on_dirty(sql: str) -> str:
    return with_tables(sql, DIRTY)


def on_clean(sql: str) -> str:
    """Over the cleaned dirty table."""
    return with_tables(sql, DIRTY, cleaning("dirty"))


def on_clean_sales(sql: str) -> str:
    return with_tables(sql, SALES, cleaning("sales"))
