"""Exact statistics and quantiles of groups of any size.

A group counted to be of ordinary size is sorted by one task, among many others.
A larger group is selected from: its values are first counted in coarse buckets, which
combines map-side and leaves a small histogram with the moments and the range of every
bucket; it tells which bucket holds each wanted rank, and a second scan reads the values
of those buckets only. A bucket whose ends are equal holds one value, which needs no
second scan. A bucket with too many different values for one task is cut again,
at splitters taken from its observed range, until every wanted rank lies in a small one.
Both ways give the same exact order statistics.
"""

from __future__ import annotations

import sys
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from salescope.schema import drop_null_keys, require_numeric
from salescope.sources.staging import BROADCAST_ROWS, materialize

# Buckets per factor e of magnitude: a bucket spans 0.4 % of its value, so prices within
# a factor of four fall into some 350 buckets.
BUCKETS_PER_E = 256
# A bucket with more different values than this is cut into so many parts.
BUCKET_VALUES = 50_000
PARTS = 1024
# So many wanted buckets are named in the second scan's filter, before the join.
NAMED_BUCKETS = 1000
QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
# A group of at most this many rows is sorted by one task: 8 MB of doubles, some
# 25 MB while it is gathered.
GROUP_ROWS = 1_000_000
STATISTICS = ("n", "missing", "mean", "std", "min", "max")


def value_bucket(value: Column) -> Column:
    """A bucket number that never decreases as the value grows."""
    magnitude = F.least(F.abs(value), F.lit(sys.float_info.max))
    return F.floor(F.signum(value) * F.log1p(magnitude) * BUCKETS_PER_E)


def long_values(df: DataFrame, values: Sequence[str], by: Sequence[str]) -> DataFrame:
    """One row per (row, value column) with its bucket; gaps are kept as NULL."""
    doubles = df.select(*by, *[F.col(v).cast("double").alias(v) for v in values])
    if len(values) == 1:
        long = doubles.select(*by, F.lit(values[0]).alias("column"), F.col(values[0]).alias("value"))
    else:
        long = doubles.unpivot(list(by), list(values), "column", "value")
    long = long.withColumn("value", F.when(~F.isnan("value"), F.col("value")))
    return long.withColumn("bucket", value_bucket(F.col("value")))


def histogram(long: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per group and bucket (NULL for gaps): rows, moments and range."""
    return long.groupBy(*keys, "bucket").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("value").alias("total"),
        F.var_pop("value").alias("spread"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
    )


def summary(counted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The statistics of each group, merged from its buckets' moments."""
    valid = F.col("bucket").isNotNull()
    totals = counted.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(valid, F.col("rows"))), F.lit(0)).alias("n"),
        F.coalesce(F.sum(F.when(~valid, F.col("rows"))), F.lit(0)).alias("missing"),
        F.try_divide(F.sum("total"), F.sum(F.when(valid, F.col("rows")))).alias("mean"),
        F.min("low").alias("min"),
        F.max("high").alias("max"),
    )
    offset = F.try_divide(F.col("total"), F.col("rows")) - F.col("mean")
    squares = (
        counted.where(valid)
        .join(totals.select(*keys, "mean"), list(keys))
        .groupBy(*keys)
        .agg(F.sum(F.col("rows") * (F.col("spread") + offset * offset)).alias("squares"))
    )
    std = F.when(F.col("n") > 1, F.sqrt(F.try_divide(F.col("squares"), F.col("n") - 1)))
    return totals.join(squares, list(keys), "left").withColumn("std", std).select(*keys, *STATISTICS)


def _position(prob: float) -> Column:
    """Where the quantile lies among the sorted values, counted from 0."""
    return (F.col("n") - 1) * F.lit(float(prob))


def _holds(position: Column) -> Column:
    """Whether a run of equal values (or a bucket) covers this rank."""
    return (F.col("rank_from") <= position) & (position < F.col("rank_to"))


def _wanted(probs: Mapping[str, float]) -> Column:
    wanted = F.lit(False)
    for prob in probs.values():
        wanted = wanted | _holds(F.floor(_position(prob))) | _holds(F.ceil(_position(prob)))
    return wanted


def _ranked(df: DataFrame, keys: Sequence[str], order: str, rows: str, start: Column) -> DataFrame:
    """Adds the ranks ``rank_from`` to ``rank_to`` - 1 that a row covers in its group."""
    over = Window.partitionBy(*keys).orderBy(order)
    upto = F.sum(rows).over(over.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumn("rank_to", start + upto).withColumn("rank_from", F.col("rank_to") - F.col(rows))


def _ends() -> list[Column]:
    """The range of a bucket's values, as aggregates."""
    return [F.min("value").alias("low"), F.max("value").alias("high")]


def wanted_buckets(counted: DataFrame, keys: Sequence[str], probs: Mapping[str, float]) -> DataFrame:
    """(keys, bucket, bucket_from, n, rows, low, high) of the buckets that hold a wanted rank."""
    valued = counted.where(F.col("bucket").isNotNull())
    sizes = valued.withColumn("n", F.sum("rows").over(Window.partitionBy(*keys)))
    ranked = _ranked(sizes, keys, "bucket", "rows", F.lit(0)).where(_wanted(probs))
    return ranked.select(*keys, "bucket", F.col("rank_from").alias("bucket_from"), "n", "rows", "low", "high")


def cut_buckets(
    points: DataFrame, keys: Sequence[str], probs: Mapping[str, float], bucket_values: int, parts: int = PARTS
) -> DataFrame:
    """Points (keys, bucket_from, n, value, copies) of smaller buckets, written.

    A bucket is known by its group and the rank it starts at. One of more than
    ``bucket_values`` different values is cut into parts of its own range, of equal width
    and, in every other round, of widths that grow from its low end (values may crowd
    there over many magnitudes); only parts that hold a wanted rank stay.
    """
    cell, wide = [*keys, "bucket_from", "n"], True
    while True:
        points = materialize(points, "bucket-values")
        cells = points.groupBy(*cell).agg(
            F.count(F.lit(1)).alias("different"), F.min("value").alias("low"), F.max("value").alias("high")
        )
        cells = materialize(cells.where(F.col("different") > bucket_values).drop("different"), "large-buckets")
        if cells.isEmpty():
            return points
        share = (F.col("value") - F.col("low")) / (F.col("high") - F.col("low"))
        part = F.least(F.floor((share if wide else F.pow(share, F.lit(1 / 16))) * parts), F.lit(parts - 1))
        cut = points.join(cells, cell).withColumn("part", part)
        sizes = cut.groupBy(*cell, "part").agg(F.sum("copies").alias("rows"))
        kept = _ranked(sizes, cell, "part", "rows", F.col("bucket_from")).where(_wanted(probs))
        kept = kept.select(*cell, "part", F.col("rank_from").alias("starts"))
        smaller = cut.join(kept, [*cell, "part"]).withColumn("bucket_from", F.col("starts"))
        whole = points.join(cells, cell, "left_anti")
        points, wide = whole.unionByName(smaller.select(*points.columns)), not wide


def order_statistics(points: DataFrame, keys: Sequence[str], probs: Mapping[str, float]) -> DataFrame:
    """The quantiles, from the values of the buckets that hold their ranks."""
    runs = _ranked(points, [*keys, "bucket_from"], "value", "copies", F.col("bucket_from"))
    found = []
    for name, prob in probs.items():
        position = _position(prob)
        lower = F.max(F.when(_holds(F.floor(position)), F.col("value")))
        upper = F.max(F.when(_holds(F.ceil(position)), F.col("value")))
        share = F.max(position - F.floor(position))
        found.append((lower + (upper - lower) * share).alias(name))
    return runs.groupBy(*keys).agg(*found)


def cut_quantiles(
    long: DataFrame,
    counted: DataFrame,
    keys: Sequence[str],
    probs: Mapping[str, float],
    bucket_values: int = BUCKET_VALUES,
) -> DataFrame:
    """(keys, quantiles) of the groups with values, of any size. ``counted`` is their
    written histogram; ``long`` may count equal values as ``copies``. Joins carry no hint:
    written tables have a real size.

    Buckets of one value are points already (-0.0 is 0.0). The others, if they are few, are named in a
    filter on ``long``, so that only rows of their numbers are looked up in the join.
    """
    seen, single = Observation(), F.col("low") == F.col("high")
    open_rows = F.coalesce(F.max(F.when(~single, F.col("rows"))), F.lit(0)).alias("rows")
    counts = [open_rows, F.count_if(~single).alias("buckets")]
    targets = materialize(wanted_buckets(counted, keys, probs).observe(seen, *counts), "wanted-buckets")
    match, cell = [*keys, "bucket"], [*keys, "bucket_from", "n", "value"]
    points = targets.where(single).select(*cell[:-1], (F.col("low") + F.lit(0.0)).alias("value"), F.col("rows").alias("copies"))
    found = seen.get
    if found["buckets"] > 0:
        wanted = targets.where(~single).select(*match, "bucket_from", "n")
        if found["buckets"] <= NAMED_BUCKETS:
            long = long.where(_named(wanted))
        copies = F.sum("copies") if "copies" in long.columns else F.count(F.lit(1))
        points = points.unionByName(long.join(wanted, match).groupBy(*cell).agg(copies.alias("copies")))
    # Rows are at least as many as different values: nothing to cut if they are few.
    if found["rows"] > bucket_values:
        points = cut_buckets(points, keys, probs, bucket_values)
    return order_statistics(points, keys, probs)


def _named(wanted: DataFrame) -> Column:
    """Whether a row of values has a column and bucket number among a few wanted ones."""
    numbers: dict[str, list[int]] = {}
    for row in wanted.select("column", "bucket").distinct().collect():
        numbers.setdefault(row["column"], []).append(row["bucket"])
    named = F.lit(False)
    for column, buckets in numbers.items():
        named = named | ((F.col("column") == column) & F.col("bucket").isin(sorted(buckets)))
    return named


def value_counts(df: DataFrame, values: Sequence[str]) -> DataFrame:
    """(column, value, copies) of the values that are there: histograms that merge by union."""
    long = long_values(df, values, []).where(F.col("value").isNotNull())
    return long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("copies"))


def counted_quantiles(
    counted: DataFrame, keys: Sequence[str], probs: Mapping[str, float], bucket_values: int = BUCKET_VALUES
) -> DataFrame:
    """(keys, quantiles) of a written table (keys, value, copies); values may repeat."""
    long = counted.withColumn("bucket", value_bucket(F.col("value")))
    sizes = long.groupBy(*keys, "bucket").agg(F.sum("copies").alias("rows"), *_ends())
    return cut_quantiles(long, sizes, keys, probs, bucket_values)


def group_quantiles(
    df: DataFrame, values: Sequence[str], by: Sequence[str], probs: Mapping[str, float], bucket_values: int = BUCKET_VALUES
) -> DataFrame:
    """(by, column, quantiles) of groups of any size that have values, from the counts of
    their buckets. Reads ``df`` twice; the first scan runs at once."""
    keys = [*by, "column"]
    long = long_values(df, values, by)
    counted = long.groupBy(*keys, "bucket").agg(F.count(F.lit(1)).alias("rows"), *_ends())
    return cut_quantiles(long, materialize(counted, "histogram"), keys, probs, bucket_values)


def describe(
    df: DataFrame,
    values: Sequence[str],
    by: Sequence[str] = (),
    probs: Mapping[str, float] = QUARTILES,
    rows: int | None = None,
    group_rows: int = GROUP_ROWS,
    broadcast_rows: int = BROADCAST_ROWS,
    bucket_values: int = BUCKET_VALUES,
) -> DataFrame:
    """Per group and value column: n, missing, mean, std, min, max and quantiles.

    Quantiles interpolate linearly between neighbours. Rows with a NULL group
    key are left out. ``rows`` is an upper bound of the row count where the
    caller has one; otherwise the rows are counted here. If they are more than
    one task should sort, the group sizes are computed to find the large groups.
    """
    require_numeric(df, *values)
    by = list(by)
    keyed = drop_null_keys(df, by)
    if rows is None:
        rows = keyed.count()
    if rows <= group_rows:
        return _describe_sorted(keyed, values, by, probs)
    if not by:
        return _describe_bucketed(keyed, values, by, probs, bucket_values)

    sizes = keyed.groupBy(*by).agg(F.count(F.lit(1)).alias("size"))
    large = materialize(sizes.where(F.col("size") > group_rows), "large-groups")
    found = large.agg(F.count("size").alias("groups"), F.sum("size").alias("rows")).first()
    if found["groups"] == 0:
        return _describe_sorted(keyed, values, by, probs)
    # Where large groups hold most rows, the others are not split off: that reads all twice more.
    if found["groups"] > broadcast_rows or 2 * found["rows"] >= rows:
        return _describe_bucketed(keyed, values, by, probs, bucket_values)
    keys = F.broadcast(large.select(*by))
    return _describe_sorted(keyed.join(keys, by, "left_anti"), values, by, probs).unionByName(
        _describe_bucketed(keyed.join(keys, by, "left_semi"), values, by, probs, bucket_values)
    )


def _describe_sorted(
    df: DataFrame, values: Sequence[str], by: Sequence[str], probs: Mapping[str, float]
) -> DataFrame:
    """One shuffle by group, for groups of at most ``GROUP_ROWS`` rows.

    Sorting a bounded array of doubles is several times faster than the
    hash map of ``percentile`` or a window over the rows.
    """
    keys, value = [*by, "column"], F.col("value")
    gathered = (
        long_values(df, values, by)
        .groupBy(*keys)
        .agg(
            F.count(value).alias("n"),
            F.count_if(value.isNull()).alias("missing"),
            F.avg(value).alias("mean"),
            F.stddev_samp(value).alias("std"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
            F.sort_array(F.collect_list(value)).alias("sorted"),
        )
    )
    found = []
    for name, prob in probs.items():
        position = _position(prob)
        lower = F.get("sorted", F.floor(position).cast("int"))
        upper = F.get("sorted", F.ceil(position).cast("int"))
        found.append((lower + (upper - lower) * (position - F.floor(position))).alias(name))
    return gathered.select(*keys, *STATISTICS, *found)


def _describe_bucketed(
    df: DataFrame, values: Sequence[str], by: Sequence[str], probs: Mapping[str, float], bucket_values: int
) -> DataFrame:
    """Two scans and small shuffles; the first scan runs at once."""
    keys = [*by, "column"]
    long = long_values(df, values, by)
    counted = materialize(histogram(long, keys), "histogram")
    statistics = summary(counted, keys)
    if not probs:
        return statistics
    found = cut_quantiles(long, counted, keys, probs, bucket_values)
    return statistics.join(found, keys, "left").select(*keys, *STATISTICS, *probs)
