"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from salescope.llm.bm25_leaks import find_leaks
from salescope.llm.exact_dedup import ORACLE_SQL as EXACT_SQL
from salescope.llm.exact_dedup import exact_groups
from salescope.llm.four_russians import ORACLE_SQL as NEGATIVES_SQL
from salescope.llm.four_russians import mine_negatives
from salescope.llm.jaccard_join import ORACLE_SQL as JACCARD_SQL
from salescope.llm.jaccard_join import similar_components
from salescope.llm.kmeans_tree import nearest_neighbours
from salescope.llm.language_crf import identify
from salescope.llm.license_rules import scan_licenses
from salescope.llm.line_chunks import drop_repeated_chunks
from salescope.llm.packing import pack
from salescope.llm.secret_tokens import find_secrets
from salescope.llm.sharding import balanced_shards
from salescope.llm.token_alignment import align_tokens
from salescope.llm.toxicity_kn import score_toxicity


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(operator: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: operator(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_crf": documents(identify),
    "op2_exact_dedup": documents(exact_groups),
    "op3_line_chunks": documents(drop_repeated_chunks),
    "op4_secret_scan": documents(find_secrets),
    "op5_toxicity_kn": lambda spark, sf_dir: score_toxicity(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    ),
    "op6_packing": documents(pack),
    "op7_sharding": documents(balanced_shards),
    "op8_license_scan": documents(scan_licenses),
    "op9_benchmark_leaks": lambda spark, sf_dir: find_leaks(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    ),
    "op10_jaccard_join": documents(similar_components),
    "op11_kmeans_tree": lambda spark, sf_dir: nearest_neighbours(table(spark, sf_dir, "embeddings")),
    "op12_four_russians": lambda spark, sf_dir: mine_negatives(table(spark, sf_dir, "embeddings")),
    "op13_token_alignment": documents(align_tokens),
}
SQL: dict[str, str] = {
    "op2_exact_dedup": EXACT_SQL,
    "op10_jaccard_join": JACCARD_SQL,
    "op12_four_russians": NEGATIVES_SQL,
}
