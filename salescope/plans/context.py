"""The report's text context as an ordered table of lines, per slice.

One grouping-sets pass over the fact table, by a few sets of columns, yields every
additive figure of the report; rolled up to one small row per item they are written
once and all sections are built from them. Only the quantiles and correlations read the fact table again. A measure
that is absent or not numeric, and an absent group, are reported as not available.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salescope.functions.formats import (
    fixed,
    joined,
    literal,
    mixed,
    money,
    percent,
    text,
    thousands,
)
from salescope.functions.quantiles import describe
from salescope.functions.stats import (
    cagr,
    mileage_price_label,
    price_sales_label,
    safe_corr,
    trend_label,
)
from salescope.operators.trends import trend_text
from salescope.schema import drop_null_keys, numeric_columns, whole_columns
from salescope.sources.sinks import json_record
from salescope.sources.staging import materialize

WHOLE = "all"

# Headings and line formats of the context.
TITLE = "***COMPREHENSIVE VEHICLE SALES DATA CONTEXT***"
RULE = "---"
SUMMARY_HEADING = "## Global Performance Summary"
REVENUE_LINE = "* **Total Revenue:** %s"
UNITS_LINE = "* **Total Sales Volume:** %s units"
PERIOD_LINE = "* **Time Period:** Data spans from year **%s** to **%s**."
TREND_LINE = "* **Sales Trend:** The overall sales trend is **%s** (CAGR: %s)."
YEARLY_LINE = "    * *Yearly Sales Breakdown (Units):* %s"
TOP_HEADING = "### Top Performers (By Sales Volume)"
TOP_LINE = "* **Top 3 %s:** %s"
DYNAMICS_HEADING = "## Price & Mileage Dynamics"
STATS_HEADING = "### Overall Numerical Variable Statistics"
PRICE_LINE = "* **Price (USD) Stats:** Mean: $%s, Median: $%s, Min: $%s, Max: $%s, IQR: $%s - $%s"
MILEAGE_LINE = "* **Mileage (KM) Stats:** Mean: %skm, Median: %skm, Max: %skm."
ENGINE_LINE = "* **Engine Size (L) Stats:** Mean: %sL, Median: %sL."
CORRELATION_HEADING = "### Correlation Insights"
PRICE_SALES_LINE = "* **Price vs. Sales Volume:** A **%s** correlation (%s)."
MILEAGE_PRICE_LINE = "* **Mileage vs. Price:** A **%s** correlation (%s)."
PROFILE_HEADING = "## 🌍 Regional Demand & Pricing Profile"
PROFILE_LINES = (
    "* **Region: %s**",
    "    * Total Sales: **%s units**",
    "    * Average Price: **%s**",
    "    * Average Mileage: **%skm**",
    "    * Most Popular Model: **%s**",
    "    * Preferred Fuel Type: **%s**",
    "    * Preferred Transmission: **%s**",
)
VARIATION_HEADING = "### Detailed Regional Price Variation (Mean Price USD)"
VARIATION_LINE = "* %s: Mean: %s, Max: %s, Min: %s"
SECTION_LINE = "SECTION: %s"
GROUP_LINE = "* **%s**: Mean %s: %s | Range: %s - %s | Count: %s"
SUMMARY_LINE = "%s: %s | SUMMARY: %s"
BREAKDOWN_LINE = "BREAKDOWN_%s: %s"
NOT_AVAILABLE = "* *Error or data not available for %s statistics.*"
JSON_HEADING = "--- JSON DATA FOR CHART ANALYSIS ---"
JSON_NAME = "price_elasticity_scatter_json:"

# The grouping sets of the report: name -> (family, item column, second column).
# The rows of a family describe the same items and are merged into one per item.
SETS = {
    "region_model": ("region", "region", "model"),
    "region_fuel_type": ("region", "region", "fuel_type"),
    "region_transmission": ("region", "region", "transmission"),
    "model_year": ("model", "model", "year"),
    "fuel_type_year": ("fuel_type", "fuel_type", "year"),
    "transmission_year": ("transmission", "transmission", "year"),
    "engine_size_year": ("engine_size", "engine_size", "year"),
    "engine_size_l": ("engine_size_l", "engine_size_l", None),
    "color": ("color", "color", None),
    "mileage_bin": ("mileage_bin", "mileage_bin", None),
    "year": ("total", None, "year"),
    "transmission_fuel_type": ("cell", "transmission", "fuel_type"),
}
# The sets that the rows are grouped by: columns of few values each, so that a task's map
# stays small. Every set of the report rolls up one of them.
SCANNED = {
    "market": (("region", "model", "year"), ("region_model", "model_year", "year")),
    "drive": (
        ("region", "fuel_type", "transmission", "year"),
        ("region_fuel_type", "region_transmission", "fuel_type_year", "transmission_year", "transmission_fuel_type"),
    ),
    "engine": (
        ("engine_size", "engine_size_l", "mileage_bin", "mileage_bin_ord", "year"),
        ("engine_size_year", "engine_size_l", "mileage_bin"),
    ),
    "paint": (("color",), ("color",)),
}
LEADERS = ("region_model", "region_fuel_type", "region_transmission")
# Sets whose rows are left out of their family's figures: each family takes them
# from one set, whose second key is summed up.
NOT_SUMMED = ("region_fuel_type", "region_transmission")
# How an item of a family sorts as a number; the others sort by their text.
ITEM_ORDER = {
    "engine_size_l": "engine_size_l",
    "engine_size": "engine_size",
    "mileage_bin": "mileage_bin_ord",
}
KEYS = (
    "year",
    "region",
    "model",
    "engine_size_l",
    "fuel_type",
    "color",
    "transmission",
    "mileage_bin",
    "mileage_bin_ord",
    "engine_size",
)
TOP_LABELS = {
    "region": "Regions",
    "model": "Models",
    "engine_size_l": "Engine Sizes (L)",
    "fuel_type": "Fuel Types",
    "color": "Colors",
}
# Section name -> (label of an item, its family, number of items).
TREND_SECTIONS = {
    "TEMPORAL_MODEL_TRENDS": ("MODEL", "model", 3),
    "TEMPORAL_FUEL_TRENDS": ("FUEL_TYPE", "fuel_type", 4),
    "TEMPORAL_TRANSMISSION_TRENDS": ("TRANSMISSION", "transmission", 2),
    "TEMPORAL_ENGINE_SIZE_TRENDS": ("ENGINE_SIZE", "engine_size", 3),
}
# Heading, family and figures of each part of the categorical section.
CATEGORICAL = "CATEGORICAL_ANALYSIS"
CATEGORIES = (
    ("### Model Pricing and Sales Volume Summary", "model", ("price", "units")),
    ("### Transmission Price Summary", "transmission", ("price",)),
    ("### Fuel Type Price Summary", "fuel_type", ("price",)),
    ("### Mileage Bin Price Summary (Depreciation Profile)", "mileage_bin", ("price",)),
)
SUMMARY, DYNAMICS = "GLOBAL_PERFORMANCE_SUMMARY", "PRICE_AND_MILEAGE_DYNAMICS"
PROFILE, VARIATION = "REGIONAL_PROFILE", "REGIONAL_PRICE_VARIATION"
FIRST_CATEGORY_NO, FIRST_TREND_NO = 5, 5 + len(CATEGORIES)
# The measures by the names of their figures, and the columns that are not text.
MEASURES = {"price": "price_usd", "units": "sales_volume", "mileage": "mileage_km", "engine": "engine_size_l"}
KEY_TYPES = {"year": "int", "mileage_bin_ord": "int", "engine_size": "int", "engine_size_l": "double"}
# Items of a family that a list or trend shows; no more are ranked.
TOP_N = 3
MOST_SHOWN = max(TOP_N, *[n for _l, _f, n in TREND_SECTIONS.values()])
RANKED = {*TOP_LABELS, *[f for _l, f, _n in TREND_SECTIONS.values()]}


def _guarded(df: DataFrame) -> tuple[DataFrame, frozenset[str]]:
    """The table with empty columns in place of absent ones and of measures that are
    not numeric, and the names of these columns."""
    gaps = {c: F.lit(None).cast(KEY_TYPES.get(c, "string")) for c in KEYS if c not in df.columns}
    gaps |= {c: F.lit(None).cast("double") for c in MEASURES.values() if c not in numeric_columns(df)}
    return (df.withColumns(gaps) if gaps else df), frozenset(gaps)


def _sliced(df: DataFrame, slice_col: str | None) -> DataFrame:
    """The fact table with its slice; without a slice column there is one slice."""
    if slice_col is None:
        return df.withColumn("slice", F.lit(WHOLE))
    return drop_null_keys(df, [slice_col]).withColumn("slice", F.col(slice_col).cast("string"))


def _set_columns(name: str) -> list[str]:
    columns = [c for c in SETS[name][1:] if c]
    return [*columns, "mileage_bin_ord"] if "mileage_bin" in columns else columns


def _grouping_id(columns: Sequence[str]) -> int:
    """One bit per key column, 1 where it is rolled up."""
    return int("".join("0" if c in columns else "1" for c in KEYS), 2)


def _by_set(values: dict[str, str]) -> Column:
    """The expression that belongs to the row's set."""
    cases = " ".join(f"WHEN {literal(name)} THEN {value}" for name, value in values.items())
    return F.expr(f"CASE `set` {cases} END")


# Figures that combine by sum, by minimum or by maximum.
SUMMED = {
    "rows_n": "count(1)",
    "units": "CAST(coalesce(sum(sales_volume), 0) AS DOUBLE)",
    "units_n": "count(sales_volume)",
    "revenue": "sum(sales_volume * price_usd)",
    "price": "sum(price_usd)",
    "price_n": "count(price_usd)",
    "mileage": "sum(mileage_km)",
    "mileage_n": "count(mileage_km)",
    "engine": "sum(engine_size_l)",
    "engine_n": "count(engine_size_l)",
}
LEAST = {"min_price": "min(price_usd)", "min_units": "CAST(min(sales_volume) AS DOUBLE)"}
GREATEST = {"max_price": "max(price_usd)", "max_units": "CAST(max(sales_volume) AS DOUBLE)"}


def _scanned_rows(facts: DataFrame) -> DataFrame:
    """The figures by the scanned sets, and the report's sets that each row counts in."""
    sets = [["slice", *columns] for columns, _names in SCANNED.values()]
    cases = " ".join(
        f"WHEN {_grouping_id(columns)} THEN array({', '.join(literal(n) for n in names)})"
        for columns, names in SCANNED.values()
    )
    figures = [F.expr(e).alias(n) for n, e in (SUMMED | LEAST | GREATEST).items()]
    sums = facts.groupingSets(sets, "slice", *KEYS).agg(F.grouping_id().alias("scanned"), *figures)
    # The slice is a column of every set, so its bit is 0.
    return sums.withColumn("set", F.explode(F.expr(f"CASE scanned {cases} END")))


def _set_rows(facts: DataFrame) -> DataFrame:
    """The grouping sets in long form: family, item, second key and figures."""
    of_set = {c: F.col("set").isin(*[n for n in SETS if c in _set_columns(n)]) for c in KEYS}
    sums = (
        _scanned_rows(facts)
        .withColumns({c: F.when(here, F.col(c)) for c, here in of_set.items()})
        .groupBy("slice", "set", *KEYS)
        .agg(
            *[F.sum(f).alias(f) for f in SUMMED],
            *[F.min(f).alias(f) for f in LEAST],
            *[F.max(f).alias(f) for f in GREATEST],
        )
    )
    keyed = sums.withColumns(
        {
            "family": _by_set({n: literal(f) for n, (f, _i, _s) in SETS.items()}),
            "item": _by_set({n: f"CAST({i} AS STRING)" for n, (_f, i, _s) in SETS.items() if i}),
            "sub": _by_set({n: f"CAST({s} AS STRING)" for n, (_f, _i, s) in SETS.items() if s}),
            "item_order": _by_set(
                {
                    n: f"CAST({ITEM_ORDER[f]} AS DOUBLE)"
                    for n, (f, _i, _s) in SETS.items()
                    if f in ITEM_ORDER
                }
            ),
        }
    )
    # A row without its item belongs to no group.
    return keyed.where("item IS NOT NULL OR family = 'total'")


def report_items(facts: DataFrame) -> DataFrame:
    """One row per (slice, family, item): figures, yearly series and leaders.

    A series has one entry per year, and a leader is a minimum over
    (-units, name), so no group is gathered beyond its years. Rows without the
    second key count in the figures only.
    """
    by_year = F.col("sub").isNotNull() & F.col("set").isin(*[n for n, v in SETS.items() if v[2] == "year"])
    summed = ~F.col("set").isin(*NOT_SUMMED)
    entry = F.struct("year", "units", F.try_divide("price", "price_n").alias("avg_price"))
    ranked = F.when(F.col("sub").isNotNull(), F.struct((-F.col("units")).alias("less"), "sub"))
    second = F.when(F.col("family") == "cell", F.col("sub")).alias("second")
    return (
        _set_rows(facts)
        .where("family != 'cell' OR sub IS NOT NULL")
        .groupBy("slice", "family", "item", "item_order", second)
        .agg(
            *[F.sum(F.when(summed, F.col(f))).alias(f) for f in SUMMED],
            *[F.min(F.when(summed, F.col(f))).alias(f) for f in LEAST],
            *[F.max(F.when(summed, F.col(f))).alias(f) for f in GREATEST],
            F.sort_array(F.collect_list(F.when(by_year, entry))).alias("series"),
            *[F.min(F.when(F.col("set") == s, ranked))["sub"].alias(f"top_{s}") for s in LEADERS],
        )
        .withColumns(
            {
                "avg_price": F.try_divide("price", "price_n"),
                "avg_units": F.when(F.col("units_n") > 0, F.try_divide("units", "units_n")),
                "avg_mileage": F.try_divide("mileage", "mileage_n"),
                "avg_engine_size": F.try_divide("engine", "engine_n"),
            }
        )
    )


def _entries(
    number: int, section: str, lines: Sequence[str], order_1: str = "0.0D", order_2: str = "''"
) -> list[str]:
    """Line expressions with their place: section, then order_1, order_2 and line number."""
    return [
        f"struct({number} AS section_no, {literal(section)} AS section, "
        f"CAST({order_1} AS DOUBLE) AS order_1, {order_2} AS order_2, {i} AS line_no, {line} AS line)"
        for i, line in enumerate(lines)
    ]


def _array(entries: Sequence[str]) -> str:
    return f"array({', '.join(entries)})"


def _top_lists(items: DataFrame, n: int = TOP_N) -> DataFrame:
    """Per slice one text column per dimension with its top n items."""
    shown = (
        "concat(item, if(family = 'engine_size_l', 'L', ''), ' (', " + thousands("units") + ", ')')"
    )
    best = items.where(F.col("family").isin(*TOP_LABELS) & (F.col("position") <= n))
    return best.groupBy("slice").agg(
        *[
            F.expr(
                joined(
                    f"sort_array(collect_list(CASE WHEN family = '{d}' "
                    f"THEN struct(position, {shown} AS label) END))",
                    "x.label",
                )
            ).alias(f"top_{d}")
            for d in TOP_LABELS
        ]
    )


def _dynamics(facts: DataFrame, rows: int) -> DataFrame:
    """Quantiles and correlations per slice: the figures that are not sums."""
    measures = {m: c for m, c in MEASURES.items() if m != "units"}
    stats = describe(facts, list(measures.values()), by=["slice"], rows=rows)
    # The ends of a column of whole numbers are whole; all other figures are fractions.
    plain = {(c, f) for c in whole_columns(facts) for f in ("min", "max")}
    wide = stats.groupBy("slice").agg(
        *[
            F.expr(f"max(CASE WHEN column = '{c}' THEN {mixed(f'`{f}`', (c, f) in plain)} END) AS {m}_{f}")
            for m, c in measures.items()
            for f in ("mean", "q25", "q50", "q75", "min", "max")
        ]
    )
    price, units, mileage = F.col("price_usd"), F.col("sales_volume"), F.col("mileage_km")
    related = facts.groupBy("slice").agg(
        safe_corr(price, units).alias("price_sales"), safe_corr(mileage, price).alias("mileage_price")
    )
    return wide.join(related, "slice").withColumns(
        {
            "price_sales_label": F.upper(price_sales_label(F.col("price_sales"))),
            "mileage_price_label": F.upper(mileage_price_label(F.col("mileage_price"))),
        }
    )


def _slice_entries(absent: frozenset[str]) -> list[str]:
    """The lines that appear once per slice: figures of the whole and headings."""

    def overall(measure: str, template: str, *figures: str) -> str:
        if MEASURES[measure] in absent:
            return literal(NOT_AVAILABLE % MEASURES[measure])
        return text(template, *[f"{measure}_{f}" for f in figures])

    yearly = joined("series", f"concat(CAST(x.year AS STRING), ': ', {thousands('x.units')})")
    summary = [
        literal(TITLE),
        literal(""),
        literal(SUMMARY_HEADING),
        literal(RULE),
        text(REVENUE_LINE, money("revenue", 2)),
        text(UNITS_LINE, thousands("units")),
        text(PERIOD_LINE, "CAST(first_year AS STRING)", "CAST(last_year AS STRING)"),
        text(TREND_LINE, "trend", percent("cagr")),
        text(YEARLY_LINE, yearly),
        literal(TOP_HEADING),
        *[text(TOP_LINE, literal(label), f"top_{d}") for d, label in TOP_LABELS.items()],
    ]
    dynamics = [
        literal(RULE),
        literal(DYNAMICS_HEADING),
        literal(RULE),
        literal(STATS_HEADING),
        overall("price", PRICE_LINE, "mean", "q50", "min", "max", "q25", "q75"),
        overall("mileage", MILEAGE_LINE, "mean", "q50", "max"),
        overall("engine", ENGINE_LINE, "mean", "q50"),
        literal(CORRELATION_HEADING),
        text(PRICE_SALES_LINE, "price_sales_label", fixed("price_sales", 2)),
        text(MILEAGE_PRICE_LINE, "mileage_price_label", fixed("mileage_price", 2)),
    ]

    def heading(number: int, section: str, *lines: str) -> list[str]:
        return _entries(number, section, [literal(x) for x in lines], order_1="-1e300D")

    entries = _entries(1, SUMMARY, summary) + _entries(2, DYNAMICS, dynamics)
    entries += heading(3, PROFILE, RULE, PROFILE_HEADING, RULE)
    entries += heading(4, VARIATION, VARIATION_HEADING)
    for i, (title, family, figures) in enumerate(CATEGORIES):
        opening = ["", SECTION_LINE % CATEGORICAL, RULE] if i == 0 else [""]
        missing = [MEASURES[f] for f in figures if {family, MEASURES[f]} & absent]
        notes = [NOT_AVAILABLE % f"{family} {measure}" for measure in missing]
        entries += heading(FIRST_CATEGORY_NO + i, CATEGORICAL, *opening, title, *notes)
    for i, section in enumerate(TREND_SECTIONS):
        entries += heading(FIRST_TREND_NO + i, section, "", SECTION_LINE % section, RULE)
    return entries


def _region_entries() -> list[str]:
    pieces = (
        "item",
        thousands("units"),
        money("avg_price", 2, grouped=False),
        fixed("avg_mileage", 0, grouped=False),
        *[f"top_{s}" for s in LEADERS],
    )
    profile = [text(template, piece) for template, piece in zip(PROFILE_LINES, pieces)]
    prices = [money(c, 2, grouped=False) for c in ("avg_price", "max_price", "min_price")]
    variation = text(VARIATION_LINE, "item", *prices)
    return _entries(3, PROFILE, profile, order_1="-units", order_2="item") + _entries(
        4, VARIATION, [variation], order_2="item"
    )


def _category_entries(number: int, figures: Sequence[str]) -> list[str]:
    """One statistics line per figure; the lines of a figure stay together."""
    entries = []
    for place, figure in enumerate(figures):
        number_text = money if figure == "price" else fixed
        line = text(
            GROUP_LINE,
            "item",
            literal("Price" if figure == "price" else "Sales Volume"),
            *[number_text(f"{f}_{figure}", 0) for f in ("avg", "min", "max")],
            f"CAST({figure}_n AS STRING)",
        )
        order = f"{place} * 1e9D + coalesce(item_order, 0)"
        entries += _entries(number, CATEGORICAL, [line], order, "item")
    return entries


def _trend_entries(number: int, section: str, label: str) -> list[str]:
    lines = [
        text(SUMMARY_LINE, literal(label), "item", "summary"),
        text(BREAKDOWN_LINE, "item", "breakdown"),
    ]
    return _entries(number, section, lines, order_1="position")


def _all_lines(facts: DataFrame, items: DataFrame, rows: int, absent: frozenset[str]) -> DataFrame:
    """Every row of the item table turns into the lines it stands for.

    Only items that a list or trend shows are ranked: the limit on the position runs
    before the shuffle, so no task holds all items of a family. The other sections
    are ordered by their items' own figures.
    """
    order = Window.partitionBy("slice", "family").orderBy(F.desc("units"), "item_order", "item")
    ranked = items.where(F.col("family").isin(*sorted(RANKED))).withColumn("position", F.row_number().over(order))
    ranked = trend_text(ranked.where(F.col("position") <= MOST_SHOWN))
    first, last, years = F.get("series", F.lit(0)), F.get("series", F.size("series") - 1), F.size("series")
    whole = (
        items.where("family = 'total'")
        .join(_top_lists(ranked), "slice", "left")
        .join(_dynamics(facts, rows), "slice", "left")
        .withColumns(
            {
                "first_year": first["year"],
                "last_year": last["year"],
                "cagr": cagr(first["units"], last["units"], years),
            }
        )
        .withColumn("trend", F.upper(trend_label(F.col("cagr"))))
        .select("slice", F.expr(f"inline({_array(_slice_entries(absent))})"))
    )

    # The lines of an item depend on its family; a trend shows its top items only.
    parts = [f"IF(family = 'region', {_array(_region_entries())}, NULL)"]
    for i, (_title, name, figures) in enumerate(CATEGORIES):
        shown = [f for f in figures if MEASURES[f] not in absent]
        if shown:
            lines = _array(_category_entries(FIRST_CATEGORY_NO + i, shown))
            parts.append(f"IF(family = '{name}', {lines}, NULL)")
    trends = [
        f"IF(family = '{name}' AND position <= {n}, {_array(_trend_entries(FIRST_TREND_NO + i, section, label))}, NULL)"
        for i, (section, (label, name, n)) in enumerate(TREND_SECTIONS.items())
    ]
    families = ["region", *[name for _t, name, _f in CATEGORIES]]
    details = items.where(F.col("family").isin(*families)).select(
        "slice", F.expr(f"inline(flatten(array_compact({_array(parts)})))")
    )
    details = details.unionByName(
        ranked.select("slice", F.expr(f"inline(flatten(array_compact({_array(trends)})))"))
    )

    # One section of one slice per partition: as many lines as it has items.
    reading = Window.partitionBy("slice", "section_no").orderBy("order_1", "order_2", "line_no")
    return whole.unionByName(details).select(
        "slice", "section_no", "section", F.row_number().over(reading).alias("seq"), "line"
    )


class Context(NamedTuple):
    """The lines in no order, the written item table behind them, and the table's rows."""

    lines: DataFrame
    items: DataFrame
    rows: int


def build_context(df: DataFrame, slice_col: str | None = None, observed: DataFrame | None = None) -> Context:
    """What lines and prompts are made of, from one pass over the items.

    ``observed`` is the same table with an observation on it: it is read in its place
    by that first pass, and only there. Its rows are counted on the way.
    """
    facts, absent = _guarded(_sliced(df, slice_col))
    first = facts if observed is None else _guarded(_sliced(observed, slice_col))[0]
    items = materialize(report_items(first), "report-items")
    rows = items.where("family = 'total'").agg(F.sum("rows_n")).first()[0] or 0
    return Context(_all_lines(facts, items, rows, absent), items, rows)


def context_lines(df: DataFrame, slice_col: str | None = None) -> DataFrame:
    """The context as (slice, section_no, section, seq, line), in reading order."""
    return build_context(df, slice_col).lines.orderBy("slice", "section_no", "seq")


def _chart_json(items: DataFrame) -> DataFrame:
    """Per slice the price-elasticity chart as one JSON array."""
    cells = (
        items.where("family = 'cell'")
        .select(
            "slice",
            F.col("item").alias("transmission"),
            F.col("second").alias("fuel_type"),
            F.col("avg_price").alias("avg_price_usd"),
            F.col("units").alias("total_sales_volume"),
            "avg_engine_size",
        )
        .dropna("any")
    )
    columns = [c for c in cells.columns if c != "slice"]
    record = F.struct("transmission", "fuel_type", json_record(cells, columns).alias("json"))
    ordered = F.transform(F.sort_array(F.collect_list(record)), lambda r: r["json"])
    return cells.groupBy("slice").agg(
        F.concat(F.lit("["), F.array_join(ordered, ","), F.lit("]")).alias("chart_json")
    )


# The marks between the parts of a prompt.
DIRECTIVES_END = "--- END OF ANALYTICAL DIRECTIVES ---"
ROLE_LABEL = "**Analyst Role & Required Report Structure:** "
DATA_LABEL = "DATA CONTEXT:"

DEFAULT_DIRECTIVES = "Reason step by step, state uncertainty, and support every claim with a figure."
DEFAULT_ROLE = "You analyse sales data and report trends, models, markets and drivers of sales."
DEFAULT_TASK = "Write the report now, in Markdown, from the data below and the charts drawn from it."


def prompt_rows(
    df: DataFrame,
    slice_col: str | None = None,
    directives: str = DEFAULT_DIRECTIVES,
    role: str = DEFAULT_ROLE,
    task: str = DEFAULT_TASK,
    built: Context | None = None,
) -> DataFrame:
    """One prompt per slice, for any batch inference job.

    A prompt gathers its slice's lines into one text; their number follows the
    distinct groups shown in a report, not the rows of the table. With ``built`` the
    table is not read again.
    """
    lines, items, _ = build_context(df, slice_col) if built is None else built
    line = F.struct("section_no", "seq", "line")
    texts = (
        lines.groupBy("slice")
        .agg(
            F.array_join(
                F.transform(F.sort_array(F.collect_list(line)), lambda x: x["line"]), "\n"
            ).alias("context")
        )
        .join(_chart_json(items), "slice", "left")
    )
    opening = "\n\n".join([directives, DIRECTIVES_END, ROLE_LABEL + role, task])
    prompt = F.concat(
        F.lit(f"{opening}\n\n{DATA_LABEL}\n"),
        F.col("context"),
        F.lit(f"\n\n{JSON_HEADING}\n{JSON_NAME}\n"),
        F.coalesce("chart_json", F.lit("[]")),
        F.lit("\n"),
    )
    return texts.select("slice", prompt.alias("prompt"))
