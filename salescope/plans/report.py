"""The whole run: clean, validate, filter, then context, charts and summary."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from salescope.operators.clean import clean_sales
from salescope.operators.quality import quality_gate
from salescope.operators.rules import enforce_rules
from salescope.plans.charts import write_charts
from salescope.plans.context import build_context, prompt_rows
from salescope.schema import REQUIRED_COLUMNS
from salescope.sources.readers import scan_sales
from salescope.sources.sinks import write_table, write_text
from salescope.sources.staging import materialize


@dataclass(frozen=True)
class ReportConfig:
    """What a run needs to know, as plain arguments."""

    input_path: str
    output_path: str
    columns: Sequence[str] = REQUIRED_COLUMNS
    fmt: str | None = None
    model_name: str = ""
    slice_col: str | None = None
    as_of_year: int | None = None


class Prepared(NamedTuple):
    """The valid rows, the same with an observation of the rules, and the quality report."""

    facts: DataFrame
    observed: DataFrame
    observation: Observation
    report: DataFrame | None


def prepared(
    raw: DataFrame,
    required: Sequence[str] = REQUIRED_COLUMNS,
    gate: bool = True,
    as_of_year: int | None = None,
) -> Prepared:
    """Clean once into a written table, stop on errors, keep valid rows.

    ``rows_before`` and ``rows_after`` are observed by the first job over ``observed``.
    """
    cleaned = materialize(clean_sales(raw, required), "clean-sales")
    report = quality_gate(cleaned) if gate else None
    observation = Observation("business rules")
    observed = enforce_rules(cleaned, as_of_year, observation)
    return Prepared(enforce_rules(cleaned, as_of_year), observed, observation, report)


def prepare(
    raw: DataFrame,
    required: Sequence[str] = REQUIRED_COLUMNS,
    gate: bool = True,
    as_of_year: int | None = None,
) -> DataFrame:
    """The valid rows of the cleaned table."""
    return prepared(raw, required, gate, as_of_year).facts


def _record(df: DataFrame, source: str, model_name: str, generated_at: str | None) -> DataFrame:
    """``df``'s one row of counts as the row about a run."""
    now = F.lit(generated_at) if generated_at else F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
    return df.select(
        now.alias("generation_time"),
        F.lit(model_name).alias("model"),
        F.lit(source).alias("data_source"),
        "total_records",
        F.lit("Passed").alias("validation_status"),
        *[c for c in df.columns if c != "total_records"],
    )


def run_summary(df: DataFrame, source: str, model_name: str = "", generated_at: str | None = None) -> DataFrame:
    """One row about the run; reaching it means that validation passed."""
    return _record(df.agg(F.count(F.lit(1)).alias("total_records")), source, model_name, generated_at)


def run_report(spark: SparkSession, config: ReportConfig) -> DataFrame:
    """Write context, prompts, chart tables, quality warnings and the run's record under
    the output path; return the record.

    Context and prompts come from the same items. The record's counts are observed while
    these are computed, and its warnings are those of the quality gate: no pass is its own.
    """
    raw = scan_sales(spark, config.input_path, config.fmt, required=config.columns)
    ready = prepared(raw, config.columns, as_of_year=config.as_of_year)
    out = config.output_path.rstrip("/")
    built = build_context(ready.facts, config.slice_col, ready.observed)
    built = built._replace(lines=materialize(built.lines, "context-lines"))
    write_text(built.lines, f"{out}/context", ["slice", "section_no", "seq"])
    prompt_rows(ready.facts, config.slice_col, built=built).write.mode("overwrite").parquet(f"{out}/prompts")
    write_charts(ready.facts, f"{out}/charts")
    write_table(ready.report, f"{out}/warnings")
    before, after = (ready.observation.get[f"rows_{at}"] for at in ("before", "after"))
    counts = ready.report.agg(
        F.lit(after).cast("bigint").alias("total_records"),
        F.lit(before).cast("bigint").alias("rows_read"),
        F.lit(before - after).cast("bigint").alias("removed_records"),
        F.sort_array(F.collect_list("message")).alias("warnings"),
    )
    write_table(_record(counts, config.input_path, config.model_name, None), f"{out}/summary")
    return spark.read.parquet(f"{out}/summary")
