"""Coerce, impute, bin and cast: from raw rows to an analysable table."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from salescope.functions.quantiles import GROUP_ROWS, counted_quantiles, describe, group_quantiles, value_counts
from salescope.functions.stats import bin_right_closed
from salescope.schema import (
    BINS_OF,
    IMPUTE_KEYS,
    MILEAGE_EDGES,
    MILEAGE_LABELS,
    NUMERIC_COLUMNS,
    REQUIRED_COLUMNS,
    drop_null_keys,
    nan_to_null,
    normalize_headers,
    numeric_columns,
    require_columns,
)
from salescope.sources.staging import BROADCAST_ROWS, materialize

MEDIAN = {"median": 0.5}
SIZE, PARTS, PART, HASH = "__group_size", "__parts", "__part", "__hash"


def coerce_numeric(df: DataFrame, columns: Sequence[str] = NUMERIC_COLUMNS) -> DataFrame:
    """Numbers as double; what does not parse, and NaN, becomes NULL."""
    present = [c for c in columns if c in df.columns]
    return nan_to_null(df.withColumns({c: F.col(c).try_cast("double") for c in present}))


def _complete(columns: Sequence[str]) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & F.col(c).isNotNull()
    return out


def join_groups(
    df: DataFrame, summary: DataFrame, keys: Sequence[str], rows: int, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """``df`` left joined to the one row that a written summary has for its group.

    ``rows`` is at least the sum of the summary's sizes, so fewer than ``broadcast_rows``
    groups hold more than that part of them. These hot groups' names are broadcast, their
    rows dealt out by a hash of the row, and their summary rows copied as often.
    """
    parts = F.greatest(F.ceil(F.col(SIZE) * broadcast_rows / max(rows, 1)), F.lit(1)).cast("int")
    summary = summary.withColumn(PARTS, parts)
    hot = summary.where(F.col(PARTS) > 1).select(*keys, PARTS)
    plain = [f.name for f in df.schema if isinstance(f.dataType, AtomicType)]
    part = F.coalesce(F.pmod(F.xxhash64(*plain), F.col(PARTS)).cast("int"), F.lit(0))
    dealt = df.join(F.broadcast(hot), list(keys), "left").withColumn(PART, part).drop(PARTS)
    copies = summary.withColumn(PART, F.explode(F.sequence(F.lit(0), F.col(PARTS) - 1)))
    return dealt.join(copies.drop(PARTS), [*keys, PART], "left").drop(PART)


def _sizes(targets: Sequence[str]) -> list[Column]:
    """The size of a group and its gaps, as aggregates."""
    gaps = [F.count_if(F.col(t).isNull()).alias(f"{t}__gaps") for t in targets]
    return [F.count(F.lit(1)).alias(SIZE), *gaps]


def _any_gap(targets: Sequence[str]) -> Column:
    """Whether a group's row of sizes counts a gap."""
    out = F.lit(False)
    for t in targets:
        out = out | (F.col(f"{t}__gaps") > 0)
    return out


def _medians(rows: DataFrame, keys: Sequence[str], targets: Sequence[str]) -> DataFrame:
    """One row per group of ordinary size, from a sorted array per target.

    Rows are sorted by a hash that leads the keys first, a cheap sort of numbers: gathering
    many groups sorts its rows by all keys, which then finds them almost in order.
    """
    values = {t: F.col(t).cast("double") for t in targets}
    arrays = [F.sort_array(F.collect_list(F.when(~F.isnan(v), v))).alias(t) for t, v in values.items()]
    hashed = rows.withColumn(HASH, F.xxhash64(*keys)).sortWithinPartitions(HASH)
    grouped = hashed.groupBy(HASH, *keys).agg(*_sizes(targets), *arrays)

    def middle(t: str) -> Column:
        n = F.size(t)
        return ((F.get(t, F.floor((n - 1) / 2).cast("int")) + F.get(t, F.floor(n / 2).cast("int"))) / 2).alias(f"{t}__median")

    return grouped.select(*keys, SIZE, *[f"{t}__gaps" for t in targets], *[middle(t) for t in targets])


def _large_medians(rows: DataFrame, large: DataFrame, keys: Sequence[str], targets: Sequence[str]) -> DataFrame:
    """The same of the written groups too large for one task, selected from their
    histograms. Their rows are written first: two scans read them, and none joins again."""
    rows = materialize(drop_null_keys(rows.join(large.select(*keys), list(keys), "left_semi"), keys), "rows-of-large-groups")
    long = group_quantiles(rows, targets, keys, MEDIAN)
    of = {t: F.col("column") == t for t in targets}
    found = long.groupBy(*keys).agg(*[F.max(F.when(of[t], F.col("median"))).alias(f"{t}__median") for t in targets])
    return large.join(found, list(keys), "left").select(
        *keys, SIZE, *[f"{t}__gaps" for t in targets], *[f"{t}__median" for t in targets]
    )


def group_medians(rows: DataFrame, keys: Sequence[str], targets: Sequence[str], group_rows: int = GROUP_ROWS) -> DataFrame:
    """Size, gaps and median of each target for the groups with gaps, from written rows of
    keys and targets.

    Sizes combine map-side and tell which groups are open or large. Where no group is large
    and most rows are in open groups, all rows are gathered without a join; otherwise those
    of the open groups are picked first.
    """
    seen = Observation()
    sizes = rows.groupBy(*keys).agg(*_sizes(targets))
    total, most = F.coalesce(F.sum(SIZE), F.lit(0)), F.coalesce(F.max(SIZE), F.lit(0))
    sizes = sizes.observe(seen, total.alias("rows"), most.alias("largest"))
    open_groups = materialize(sizes.where(_any_gap(targets)), "open-groups")
    open_rows = open_groups.agg(F.coalesce(F.sum(SIZE), F.lit(0))).first()[0]
    if seen.get["largest"] <= group_rows and 2 * open_rows >= seen.get["rows"]:
        return materialize(_medians(rows, keys, targets).where(_any_gap(targets)), "group-medians")
    large = materialize(open_groups.where(F.col(SIZE) > group_rows), "large-groups")
    ordinary = open_groups.where(F.col(SIZE) <= group_rows).select(*keys)
    medians = _medians(rows.join(ordinary, list(keys), "left_semi"), keys, targets)
    if not large.isEmpty():
        medians = medians.unionByName(_large_medians(rows, large, keys, targets))
    return materialize(medians, "group-medians")


def join_group_stat(
    df: DataFrame,
    keys: Sequence[str],
    column: str,
    group_rows: int = GROUP_ROWS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Each row with the median of its group as ``median_<column>``."""
    rows = df.count()
    medians = describe(df, [column], keys, MEDIAN, rows=rows, group_rows=group_rows)
    size = (F.col("n") + F.col("missing")).alias(SIZE)
    medians = materialize(medians.select(*keys, size, F.col("median").alias(f"median_{column}")), "group-medians")
    return join_groups(df, medians, keys, rows, broadcast_rows).drop(SIZE)


class _GroupFill(NamedTuple):
    filled: DataFrame
    medians: DataFrame | None  # size, gaps and medians of the groups with gaps
    targets: list[str]  # none if there was no gap to fill
    gaps: dict[str, int]  # missing values before the fill, by column, and all rows as SIZE


def _fill_groups(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], group_rows: int, broadcast_rows: int
) -> _GroupFill:
    """The group fill with what its writing pass observed.

    Keys and targets of the rows whose keys are complete are written, and sizes and medians
    come from that table. Only rows with a gap that may be filled travel to the medians; the
    other rows stay where they are read. Observed counts may be too high after a lost
    executor, never too low, so they serve as bounds only.
    """
    keys = [k for k in keys if k in df.columns]
    present = [c for c in columns if c in df.columns]
    targets = [c for c in present if c not in keys]
    counts = [F.count_if(F.col(c).isNull()).alias(c) for c in present]
    if not keys or not targets:
        return _GroupFill(df, None, [], df.agg(F.count(F.lit(1)).alias(SIZE), *counts).first().asDict())
    seen = Observation()
    rows = df.observe(seen, F.count(F.lit(1)).alias(SIZE), *counts).where(_complete(keys))
    rows = materialize(rows.select(*keys, *targets), "rows-of-groups")
    gaps = seen.get
    as_double = {t: F.col(t).cast("double") for t in targets}
    if not any(gaps[t] for t in targets):
        return _GroupFill(df.withColumns(as_double), None, [], gaps)
    fillable = _complete(keys) & ~_complete(targets)
    medians = group_medians(rows, keys, targets, group_rows)
    joined = join_groups(df.where(fillable), medians, keys, gaps[SIZE], broadcast_rows)
    fills = {t: F.coalesce(F.col(t).cast("double"), F.col(f"{t}__median")) for t in targets}
    joined = joined.withColumns(fills).select(*df.columns)
    others = df.where(~fillable).withColumns(as_double)
    return _GroupFill(others.unionByName(joined), medians, targets, gaps)


def impute_group_median(
    df: DataFrame,
    keys: Sequence[str] = IMPUTE_KEYS,
    columns: Sequence[str] = NUMERIC_COLUMNS,
    group_rows: int = GROUP_ROWS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Fill gaps with the median of the row's group; rows with a NULL key stay as they are.

    A key column never changes here: within its group it is constant, and
    without a value there is no group.
    """
    if not set(keys) & set(df.columns) or not (set(columns) - set(keys)) & set(df.columns):
        return df
    return _fill_groups(df, keys, columns, group_rows, broadcast_rows).filled


def _fill_with(df: DataFrame, medians: dict[str, float | None]) -> DataFrame:
    fills = {
        c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in medians.items() if m is not None
    }
    return df.withColumns(fills) if fills else df


def global_medians(
    df: DataFrame, columns: Sequence[str] = NUMERIC_COLUMNS, more: DataFrame | None = None
) -> dict[str, float]:
    """Exact medians of whole columns, by one scan that leaves a histogram of their values.

    ``more`` adds (column, value, copies) rows to it. A column without values has none.
    """
    counted = value_counts(df, columns)
    counted = materialize(counted if more is None else counted.unionByName(more), "value-counts")
    return {r["column"]: r["median"] for r in counted_quantiles(counted, ["column"], MEDIAN).collect()}


def impute_global_median(df: DataFrame, columns: Sequence[str] = NUMERIC_COLUMNS) -> DataFrame:
    """Fill the remaining gaps with the column's median, taken from ``df`` as it is."""
    present = [c for c in columns if c in df.columns]
    return _fill_with(df, global_medians(df, present)) if present else df


def impute_zero(df: DataFrame, columns: Sequence[str] = NUMERIC_COLUMNS) -> DataFrame:
    """What is still missing (a column without any value) becomes 0."""
    return df.fillna(0.0, subset=[c for c in columns if c in df.columns])


def impute(
    df: DataFrame,
    keys: Sequence[str] = IMPUTE_KEYS,
    columns: Sequence[str] = NUMERIC_COLUMNS,
    group_rows: int = GROUP_ROWS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Group median, then global median of the result, then 0.

    The values that the group fill puts in are known from its summary, so the global
    medians need the table's own values only: the fill is not run for them. Reads ``df``
    four times at most (keys and values, values, result in two parts).
    """
    fill = _fill_groups(df, keys, columns, group_rows, broadcast_rows)
    left, more = {c: fill.gaps[c] for c in columns if c in df.columns}, None
    if fill.targets:
        closed = [F.sum(F.when(F.col(f"{t}__median").isNotNull(), F.col(f"{t}__gaps"))).alias(t) for t in fill.targets]
        closed = fill.medians.agg(*closed).first()
        left |= {t: fill.gaps[t] - (closed[t] or 0) for t in fill.targets}
    open_columns = [c for c, n in left.items() if n > 0]
    for t in set(open_columns) & set(fill.targets):
        filled = fill.medians.where(F.col(f"{t}__median").isNotNull() & (F.col(f"{t}__gaps") > 0))
        filled = filled.select(F.lit(t).alias("column"), F.col(f"{t}__median").alias("value"), F.col(f"{t}__gaps").alias("copies"))
        more = filled if more is None else more.unionByName(filled)
    medians = global_medians(df, open_columns, more) if open_columns else {}
    return impute_zero(_fill_with(fill.filled, medians), columns)


def truncate_engine(df: DataFrame, source: str = "engine_size_l", target: str = "engine_size") -> DataFrame:
    """Whole litres, cut toward zero."""
    return df.withColumn(target, F.col(source).cast("int"))


def bin_column(
    df: DataFrame, source: str, target: str, edges: Sequence[float], labels: Sequence[str]
) -> DataFrame:
    """Right-closed bins with a label and, for ordering, the bin's number, which its
    column's metadata mark as a helper."""
    value = F.col(source)
    number = f"{target}_ord"
    return df.withColumns(
        {
            target: bin_right_closed(value, edges, list(labels)),
            number: bin_right_closed(value, edges, list(range(1, len(labels) + 1))),
        }
    ).withMetadata(number, {BINS_OF: target})


def bin_mileage(df: DataFrame, source: str = "mileage_km", target: str = "mileage_bin") -> DataFrame:
    return bin_column(df, source, target, MILEAGE_EDGES, MILEAGE_LABELS)


def cast_year(df: DataFrame, column: str = "year") -> DataFrame:
    return df.withColumn(column, F.col(column).cast("int"))


def derive_columns(df: DataFrame) -> DataFrame:
    """The row-local columns: whole engine size, mileage bin, integer year."""
    df = bin_mileage(truncate_engine(df))
    return cast_year(df) if "year" in df.columns else df


def clean_sales(
    df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """Headers, required columns, numbers, gaps, derived columns."""
    numbers = coerce_numeric(require_columns(normalize_headers(df), required))
    return derive_columns(impute(numbers, columns=numeric_columns(numbers), group_rows=group_rows))
