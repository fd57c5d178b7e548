"""Column expressions for IEEE arithmetic, rounding and number formatting.

Missing values are NULL everywhere; NaN is turned into NULL at the sources. Infinities are real
values and survive until :func:`inf_to_null` is applied.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")


def rint_to(x: Column, digits: int = 2) -> Column:
    """Round half to even at ``digits`` decimals; never returns a negative zero."""
    scale = F.lit(float(10**digits))
    return F.rint(x * scale) / scale + F.lit(0.0)


def ieee_div(a: Column, b: Column) -> Column:
    """``a / b`` with a signed infinity for a zero divisor and NULL for ``0 / 0``.

    ANSI mode raises on a zero divisor and ``try_divide`` hides it as NULL, so neither alone keeps
    "changed from zero" apart from "unknown".
    """
    signed = F.when(a > 0, F.lit(INF)).when(a < 0, F.lit(-INF))
    return F.when(b != 0, a / b).when(b == 0, signed)


def pct_change(current: Column, previous: Column) -> Column:
    """Percent change against ``previous``, two decimals, half to even."""
    return rint_to(ieee_div(current - previous, previous) * F.lit(100.0))


def fraction_to_percent(x: Column) -> Column:
    """Turn a fraction into percent with two decimals."""
    return rint_to(x * F.lit(100.0))


def is_inf(x: Column) -> Column:
    return F.abs(x) == F.lit(INF)


def inf_to_null(x: Column) -> Column:
    return F.when(~is_inf(x), x)


def nan_to_null(x: Column) -> Column:
    return F.when(~F.isnan(x), x)


def fixed(x: Column, digits: int, suffix: str = "") -> Column:
    """Fixed-point text. Rounds half to even first: the JVM formatter alone rounds half up."""
    return F.format_string(f"%.{digits}f{suffix.replace('%', '%%')}", rint_to(x, digits))


def significant(x: Column, digits: int = 6) -> Column:
    """Text with ``digits`` significant digits and no trailing zeros, in plain decimal notation."""
    exponent = F.floor(F.log10(F.abs(x)))
    scale = F.pow(F.lit(10.0), F.lit(digits - 1) - exponent)
    text = (F.rint(x * scale) / scale).cast("decimal(38,15)").cast("string")
    trimmed = F.regexp_replace(text, r"\.?0+$", "")
    return F.when(x == 0, F.lit("0")).otherwise(trimmed)
