"""Number and text formats, as Spark SQL expression text for ``F.expr``.

Report lines are long expressions; as text a whole line reaches the JVM in one
call. ``format_number`` rounds ties half to even.

The last bits of a sum depend on the order of its terms. Values are rounded to
six decimals before they are cut to the shown ones, so that a mean that is a tie
reads the same in every run.
"""

from __future__ import annotations


def literal(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def fixed(value: str, decimals: int, grouped: bool = True) -> str:
    """1234.5 -> 1,234.50 with two decimals; without the comma if not grouped."""
    text = f"format_number(round(CAST({value} AS DOUBLE), 6), {decimals})"
    return text if grouped else f"replace({text}, ',', '')"


def thousands(value: str) -> str:
    """1234567 -> 1,234,567."""
    return fixed(value, 0)


def money(value: str, decimals: int = 0, grouped: bool = True) -> str:
    return f"concat('$', {fixed(value, decimals, grouped)})"


def mixed(value: str, whole: bool, decimals: int = 2) -> str:
    """A whole number plainly (1234), any other with commas and decimals (1,234.00)."""
    return f"CAST(CAST({value} AS BIGINT) AS STRING)" if whole else fixed(value, decimals)


def percent(value: str, signed: bool = False) -> str:
    """0.1234 -> 12.34%, with a plus sign when asked for."""
    text = f"concat({fixed(f'({value}) * 100', 2, grouped=False)}, '%')"
    return f"concat(if({value} >= 0, '+', ''), {text})" if signed else text


def text(template: str, *pieces: str) -> str:
    """The template with its ``%s`` filled in; a missing piece reads N/A."""
    filled = [f"coalesce({p}, 'N/A')" for p in pieces]
    return f"format_string({', '.join([literal(template), *filled])})"


def joined(array: str, element: str, separator: str = ", ") -> str:
    """The elements of an array as text; ``element`` is an expression over ``x``."""
    return f"array_join(transform({array}, x -> {element}), {literal(separator)})"
