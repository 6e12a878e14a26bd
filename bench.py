"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the local cores. The input
tables are joined into the sales table once (``stage_sales``), as a deployment
would do; every query then reads that table. Each query is computed in full, with
its result thrown away, once cold and once warm; the headline is the warm sum.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame

from salescope.operators import aggregate, clean, insights, quality, rank, rules, trends
from salescope.plans import charts, context
from salescope.session import build_session
from salescope.sources.star import clean_fact, dirty_fact, sales_fact

QUERIES = {
    "clean_sales": (dirty_fact, clean.clean_sales),
    "enforce_rules": (dirty_fact, rules.enforce_rules),
    "dq_report": (clean_fact, quality.quality_report),
    "chart_sales_trend": (sales_fact, charts.sales_trend),
    "chart_top_models": (sales_fact, charts.top_models),
    "chart_price_elasticity": (sales_fact, charts.price_elasticity),
    "chart_engine_price": (sales_fact, charts.engine_price),
    "stats_column": (
        sales_fact,
        lambda df: aggregate.stats_columns(df, ["price_usd", "mileage_km", "engine_size_l"]),
    ),
    "stats_price_by_model": (sales_fact, lambda df: aggregate.stats_grouped(df, "price_usd", ["model"])),
    "corr_price_sales": (sales_fact, aggregate.corr_price_sales),
    "top_dimensions": (sales_fact, rank.top_dimensions),
    "region_profile": (sales_fact, rank.group_profile),
    "trend_model": (sales_fact, lambda df: trends.trend_breakdown(df, "model")),
    "growth_region_top_bottom": (sales_fact, insights.growth_top_bottom),
    "niche_pricing_power": (sales_fact, insights.niche_pricing_power),
    "context_lines": (sales_fact, context.context_lines),
}


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def compute(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    cold = {"stage_sales": timed(lambda: sales_fact(spark, sf_dir))}
    dirty_fact(spark, sf_dir)
    clean_fact(spark, sf_dir)
    warm = {}
    for key, (table, query) in QUERIES.items():
        source = table(spark, sf_dir)
        cold[key] = timed(lambda: compute(query(source)))
        warm[key] = timed(lambda: compute(query(source)))
    print(
        json.dumps(
            {
                "metric": "sales report queries, warm total",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": {k: round(v, 3) for k, v in warm.items()},
                "cold": {k: round(v, 3) for k, v in cold.items()},
                "sf": sf_dir.rsplit("sf", 1)[-1],
                "cpus": int(cpus),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
