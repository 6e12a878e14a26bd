"""The text context, the prompts and the end-to-end run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope_checks.catalog import add
from salescope_checks.load_queries import quality_sql
from salescope_checks.tables import DIRTY, cleaning, on_clean, on_sales, with_tables
from salescope.operators import rules
from salescope.plans import charts, context, report
from salescope.sources import sinks
from salescope.sources.staging import materialize, new_path, write_files
from salescope.sources.star import clean_fact, dirty_rows, sales_fact


def number(value: str, decimals: int = 0, grouped: bool = True) -> str:
    comma = "," if grouped else ""
    return f"format('{{:{comma}.{decimals}f}}', round(CAST({value} AS DOUBLE), 6))"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def filled(template: str, *pieces: str) -> str:
    """The template with its %s filled in, as a SQL concatenation."""
    parts = template.replace("%%", "%").split("%s")
    out = [quoted(parts[0])]
    for piece, part in zip(pieces, parts[1:]):
        out += [f"({piece})", quoted(part)]
    return " || ".join(out)


def _constant(no: int, order: float, lines) -> str:
    """Fixed lines of a section, once per slice."""
    return " UNION ALL ".join(
        f"SELECT slice, {no} AS no, {order}::DOUBLE AS o1, '' AS o2, {i} AS o3, {line if raw else quoted(line)} AS line "
        f"FROM slices"
        for i, (line, raw) in enumerate(lines)
    )


def _top(column: str, suffix: str = "") -> str:
    return (
        f"(SELECT string_agg(item || '{suffix} (' || {number('units')} || ')', ', ' ORDER BY units DESC, k) FROM ("
        f"SELECT CAST({column} AS VARCHAR) AS item, {column} AS k, sum(sales_volume) AS units FROM facts f "
        f"WHERE f.slice = s.slice AND {column} IS NOT NULL GROUP BY {column} ORDER BY units DESC, k LIMIT 3))"
    )


def _profile() -> str:
    def best(column: str) -> str:
        return (
            f"(SELECT {column} FROM facts f WHERE f.slice = g.slice AND f.region = g.region AND {column} IS NOT NULL "
            f"GROUP BY {column} ORDER BY sum(sales_volume) DESC, {column} LIMIT 1)"
        )

    pieces = (
        "region",
        number("units"),
        "'$' || " + number("avg_price", 2, False),
        number("avg_mileage", 0, False),
        best("model"),
        best("fuel_type"),
        best("transmission"),
    )
    lines = " UNION ALL ".join(
        f"SELECT slice, 3 AS no, -units::DOUBLE AS o1, region AS o2, {i} AS o3, {filled(t, p)} AS line FROM g"
        for i, (t, p) in enumerate(zip(context.PROFILE_LINES, pieces))
    )
    return (
        f"SELECT * FROM (WITH g AS MATERIALIZED (SELECT slice, region, sum(sales_volume) AS units, avg(price_usd) AS avg_price, "
        f"avg(mileage_km) AS avg_mileage FROM facts WHERE region IS NOT NULL GROUP BY slice, region) {lines})"
    )


def _variation() -> str:
    pieces = [f"'$' || {number(f'{f}(price_usd)', 2, False)}" for f in ("avg", "max", "min")]
    return (
        f"SELECT slice, 4 AS no, 0::DOUBLE AS o1, region AS o2, 0 AS o3, {filled(context.VARIATION_LINE, 'region', *pieces)} AS line "
        "FROM facts WHERE region IS NOT NULL GROUP BY slice, region"
    )


def _category(no: int, column: str, figures) -> str:
    parts = []
    for place, figure in enumerate(figures):
        value, sign, label = ("price_usd", "'$' || ", "Price") if figure == "price" else ("sales_volume", "", "Sales Volume")
        pieces = [f"{sign}{number(f'{f}({value})')}" for f in ("avg", "min", "max")]
        order = "any_value(mileage_bin_ord)" if column == "mileage_bin" else "0"
        line = filled(context.GROUP_LINE, column, quoted(label), *pieces, f"CAST(count({value}) AS VARCHAR)")
        parts.append(
            f"SELECT slice, {no} AS no, {place} * 1e9::DOUBLE + {order} AS o1, {column} AS o2, 0 AS o3, {line} AS line "
            f"FROM facts WHERE {column} IS NOT NULL GROUP BY slice, {column}"
        )
    return " UNION ALL ".join(parts)


def _trend(no: int, label: str, item: str, n: int) -> str:
    growth = "CASE WHEN years > 1 AND u0 > 0 THEN u1::DOUBLE / u0 - 1 ELSE 0 END"
    summary = filled(
        "Growth: %s%s% | Start_Year_Price: $%s | End_Year_Price: $%s".replace("% |", "%% |"),
        f"CASE WHEN {growth} >= 0 THEN '+' ELSE '' END",
        number(f"({growth}) * 100", 2, False),
        number("p0"),
        number("p1"),
    )
    name = f"CAST({item} AS VARCHAR)"
    entry = "'Y' || year || ': S' || " + number("units") + " || '/P$' || " + number("price")
    rows = (
        f"SELECT slice, {item}, position, count(*) AS years, arg_min(units, year) AS u0, arg_max(units, year) AS u1, "
        f"arg_min(price, year) AS p0, arg_max(price, year) AS p1, string_agg({entry}, ' | ' ORDER BY year) AS entries FROM ("
        f"SELECT f.slice, f.{item}, year, any_value(position) AS position, sum(sales_volume) AS units, avg(price_usd) AS price "
        f"FROM facts f JOIN (SELECT slice, {item}, row_number() OVER (PARTITION BY slice ORDER BY sum(sales_volume) DESC, {item}) "
        f"AS position FROM facts WHERE {item} IS NOT NULL GROUP BY slice, {item}) t ON f.slice = t.slice AND f.{item} = t.{item} "
        f"WHERE position <= {n} GROUP BY f.slice, f.{item}, year) GROUP BY slice, {item}, position"
    )
    return (
        f"SELECT slice, {no} AS no, position::DOUBLE AS o1, '' AS o2, 0 AS o3, {quoted(label + ': ')} || {name} || ' | SUMMARY: ' || {summary} AS line FROM ({rows}) "
        f"UNION ALL SELECT slice, {no} AS no, position::DOUBLE AS o1, '' AS o2, 1 AS o3, 'BREAKDOWN_' || {name} || ': ' || entries AS line FROM ({rows})"
    )


def context_ctes(facts: str, slice_expr: str = "'all'") -> str:
    """CTEs facts, slices and lines over a table with the derived columns."""
    c = context
    q = {f: f"quantile_cont({f}, {{}})" for f in ("price_usd", "mileage_km", "engine_size_l")}
    corr = {
        "r_ps": "corr(price_usd, sales_volume)",
        "r_mp": "corr(mileage_km, price_usd)",
    }
    figures = (
        "SELECT slice, sum(sales_volume) AS units, sum(sales_volume * price_usd) AS revenue, min(year) AS y0, max(year) AS y1, "
        + ", ".join(f"{v} AS {k}" for k, v in corr.items())
        + ", "
        + ", ".join(
            f"avg({f}) AS {f}_mean, min({f}) AS {f}_min, max({f}) AS {f}_max, "
            + ", ".join(f"{q[f].format(p)} AS {f}_q{int(p * 100)}" for p in (0.25, 0.5, 0.75))
            for f in q
        )
        + " FROM facts GROUP BY slice"
    )
    yearly = (
        f"SELECT slice, string_agg(year || ': ' || {number('units')}, ', ' ORDER BY year) AS yearly, "
        "CASE WHEN count(*) > 1 AND arg_min(units, year) > 0 THEN "
        "power(arg_max(units, year)::DOUBLE / arg_min(units, year), 1.0 / (count(*) - 1)) - 1 ELSE 0 END AS cagr "
        "FROM (SELECT slice, year, sum(sales_volume) AS units FROM facts WHERE year IS NOT NULL GROUP BY ALL) GROUP BY slice"
    )
    trend = "CASE WHEN cagr > 0.05 THEN 'INCREASING' WHEN cagr < -0.05 THEN 'DECREASING' ELSE 'STABLE' END"
    ps = "CASE WHEN r_ps < -0.4 THEN 'NEGATIVE' WHEN r_ps > 0.4 THEN 'POSITIVE' ELSE 'NEUTRAL' END"
    mp = "CASE WHEN r_mp < -0.6 THEN 'STRONG NEGATIVE' WHEN r_mp < -0.2 THEN 'NEGATIVE' ELSE 'NEUTRAL' END"
    summary = [
        (c.TITLE, False),
        ("", False),
        (c.SUMMARY_HEADING, False),
        (c.RULE, False),
        (filled(c.REVENUE_LINE, "'$' || " + number("revenue", 2)), True),
        (filled(c.UNITS_LINE, number("units")), True),
        (filled(c.PERIOD_LINE, "CAST(y0 AS VARCHAR)", "CAST(y1 AS VARCHAR)"), True),
        (filled(c.TREND_LINE, trend, number("cagr * 100", 2, False) + " || '%'"), True),
        (filled(c.YEARLY_LINE, "yearly"), True),
        (c.TOP_HEADING, False),
        *[(filled(c.TOP_LINE, quoted(label), f"top_{d}"), True) for d, label in c.TOP_LABELS.items()],
    ]
    dynamics = [
        (c.RULE, False),
        (c.DYNAMICS_HEADING, False),
        (c.RULE, False),
        (c.STATS_HEADING, False),
        (filled(c.PRICE_LINE, *[number(f"price_usd_{f}", 2) for f in ("mean", "q50", "min", "max", "q25", "q75")]), True),
        (filled(c.MILEAGE_LINE, *[number(f"mileage_km_{f}", 2) for f in ("mean", "q50", "max")]), True),
        (filled(c.ENGINE_LINE, *[number(f"engine_size_l_{f}", 2) for f in ("mean", "q50")]), True),
        (c.CORRELATION_HEADING, False),
        (filled(c.PRICE_SALES_LINE, ps, number("r_ps", 2)), True),
        (filled(c.MILEAGE_PRICE_LINE, mp, number("r_mp", 2)), True),
    ]

    def fixed(*lines: str):
        return [(x, False) for x in lines]

    parts = [_constant(1, 0, summary), _constant(2, 0, dynamics)]
    parts += [_constant(3, -1e300, fixed(c.RULE, c.PROFILE_HEADING, c.RULE)), _profile()]
    parts += [_constant(4, -1, fixed(c.VARIATION_HEADING)), _variation()]
    for i, (title, name, shown) in enumerate(c.CATEGORIES):
        opening = ["", c.SECTION_LINE % c.CATEGORICAL, c.RULE] if i == 0 else [""]
        parts += [_constant(5 + i, -1, fixed(*opening, title)), _category(5 + i, name, shown)]
    for i, (section, (label, name, n)) in enumerate(c.TREND_SECTIONS.items()):
        parts += [_constant(9 + i, 0, fixed("", c.SECTION_LINE % section, c.RULE)), _trend(9 + i, label, name, n)]
    tops = ", ".join(f"{_top(d, 'L' if d == 'engine_size_l' else '')} AS top_{d}" for d in c.TOP_LABELS)
    return f"""
facts AS MATERIALIZED (SELECT *, {slice_expr} AS slice FROM {facts} WHERE {slice_expr} IS NOT NULL),
slices AS MATERIALIZED (SELECT s.*, y.* EXCLUDE (slice), {tops} FROM ({figures}) s JOIN ({yearly}) y ON s.slice = y.slice),
places AS MATERIALIZED ({" UNION ALL ".join(parts)}),
lines AS MATERIALIZED (
  SELECT slice, no AS section_no, {_section_name()} AS section,
         CAST(row_number() OVER (PARTITION BY slice, no ORDER BY o1, o2, o3) AS INTEGER) AS seq, line FROM places
)"""


def _section_name() -> str:
    names = [context.SUMMARY, context.DYNAMICS, context.PROFILE, context.VARIATION]
    names += [context.CATEGORICAL] * len(context.CATEGORIES) + list(context.TREND_SECTIONS)
    return "CASE no " + " ".join(f"WHEN {i + 1} THEN '{n}'" for i, n in enumerate(names)) + " END"


def with_context(statement: str, facts: str, sql: str, slice_expr: str = "'all'") -> str:
    """Put the context CTEs between the tables of a statement and its body."""
    head, _, _ = statement.partition("--body--")
    return f"{head}, {context_ctes(facts, slice_expr)} --body-- {sql}"


LINES = "SELECT slice, section_no, section, seq, line FROM lines"
add(
    "context_lines",
    lambda s, d: context.context_lines(sales_fact(s, d)),
    with_context(on_sales(""), "fact", LINES),
)
add(
    "context_lines_by_region",
    lambda s, d: context.context_lines(sales_fact(s, d), "region"),
    with_context(on_sales(""), "fact", LINES, "region"),
)
VALID = "(SELECT * FROM clean WHERE price_usd > 0 AND sales_volume >= 0 AND year BETWEEN 1980 AND year(current_date))"
add(
    "context_lines_clean",
    lambda s, d: context.context_lines(rules.enforce_rules(clean_fact(s, d))),
    with_context(on_clean(""), VALID, LINES),
)


def _text_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "context")
    lines = materialize(context.context_lines(sales_fact(spark, sf_dir)), "context-lines")
    sinks.write_text(lines, path, ["slice", "section_no", "seq"])
    return spark.read.text(path)


add(
    "text_sink",
    _text_sink,
    with_context(on_sales(""), "fact", "SELECT line AS value FROM lines"),
)


def prompt_sql(slice_expr: str) -> str:
    opening = "\n\n".join(
        [context.DEFAULT_DIRECTIVES, context.DIRECTIVES_END, context.ROLE_LABEL + context.DEFAULT_ROLE, context.DEFAULT_TASK]
    )
    head = quoted(f"{opening}\n\n{context.DATA_LABEL}\n")
    return (
        f"SELECT slice, length({head} || string_agg(line, '\n' ORDER BY section_no, seq)) AS context_end, "
        "md5(string_agg(line, '\n' ORDER BY section_no, seq)) AS context_md5 FROM lines GROUP BY slice"
    )


def _prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the context ends in each prompt, and its digest; the JSON part is checked in the tests."""
    ending = f"\n\n{context.JSON_HEADING}\n"
    return context.prompt_rows(sales_fact(spark, sf_dir), "region").selectExpr(
        "slice",
        f"CAST(instr(prompt, '{ending}') - 1 AS BIGINT) AS context_end",
        f"md5(split_part(split_part(prompt, '{context.DATA_LABEL}\n', 2), '{ending}', 1)) AS context_md5",
    )


add("prompt_rows", _prompts, with_context(on_sales(""), "fact", prompt_sql("region"), "region"))


def _run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a whole run over a file with gaps, repeated rows and impossible years leaves behind."""
    source, out = new_path(spark, "input") + ".parquet", new_path(spark, "run")
    write_files(dirty_rows(spark, sf_dir).withColumn("price_usd", F.abs("price_usd")), source)
    record = report.run_report(spark, report.ReportConfig(source, out, model_name="any-model"))
    counted = {
        "context lines": spark.read.text(f"{out}/context"),
        "prompts": spark.read.parquet(f"{out}/prompts"),
        **{f"chart {name}": spark.read.parquet(f"{out}/charts/{name}") for name in charts.CHARTS},
    }
    result = record.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("n")) for c in ("rows_read", "total_records", "removed_records")]))
    ).unionByName(record.select(F.explode("warnings").alias("name"), F.lit(1).cast("bigint").alias("n")))
    for name, table in counted.items():
        result = result.unionByName(table.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n"))
    return result


POSITIVE = "positive AS (SELECT * REPLACE (abs(price_usd) AS price_usd) FROM dirty)"
COUNTS = {
    "rows_read": "SELECT count(*) FROM clean",
    "total_records": f"SELECT count(*) FROM {VALID}",
    "removed_records": f"SELECT (SELECT count(*) FROM clean) - (SELECT count(*) FROM {VALID})",
    "context lines": "SELECT count(*) FROM lines",
    "prompts": "SELECT 1",
    "chart combined_sales_trend": "SELECT count(*) FROM (SELECT DISTINCT year, region FROM facts WHERE year IS NOT NULL "
    "AND region IS NOT NULL) UNION ALL SELECT count(DISTINCT year) FROM facts",
    "chart top_models_sales": "SELECT count(*) FROM (SELECT DISTINCT model, year, fuel_type FROM facts WHERE year IS NOT NULL "
    "AND fuel_type IS NOT NULL AND model IN (SELECT model FROM facts WHERE model IS NOT NULL GROUP BY model "
    "ORDER BY sum(sales_volume) DESC, model LIMIT 10))",
    "chart price_elasticity": "SELECT count(*) FROM (SELECT DISTINCT transmission, fuel_type FROM facts)",
    "chart engine_price_box": "SELECT count(*) FROM (SELECT DISTINCT engine_size, fuel_type FROM facts)",
}
add(
    "report_run",
    _run,
    with_context(
        with_tables("", DIRTY, POSITIVE, cleaning("positive")),
        VALID,
        " UNION ALL ".join(
            f"SELECT '{name}' AS name, CAST(sum(n) AS BIGINT) AS n FROM ({sql}) counted(n)" for name, sql in COUNTS.items()
        )
        + f" UNION ALL SELECT message AS name, CAST(1 AS BIGINT) AS n FROM ({quality_sql('clean')})",
    ),
)
