"""Exact decimal rounding helpers.

Rule: sum exactly, divide once, round once, in integers. ``round(avg(decimal))`` in
Spark rounds twice (avg already rounds to scale 6) and ``round(avg(double))`` is not
exact, so every mean goes through :func:`mean_half_up` on scaled integer sums.
Rounding is half away from zero, like PostgreSQL ``round(numeric, n)``.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

WIDE_INT = "decimal(38,0)"

# Every helper takes Columns, or SQL text (a column name or an expression) for all of
# its inputs. With SQL text the whole expression is composed as text and becomes one
# Column through a single ``F.expr``: the same Catalyst expression, built with one
# round trip to the JVM instead of hundreds.


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _all_sql(*xs) -> bool:
    return all(isinstance(x, str) for x in xs)


def round_div_sql(n: str, d: str) -> str:
    """SQL text of :func:`round_div`."""
    n = f"CAST(({n}) AS DECIMAL(38,0))"
    d = f"NULLIF(CAST(({d}) AS DECIMAL(38,0)), 0)"
    q = f"((ABS({n}) * 2 + {d}) DIV ({d} * 2))"
    return f"(CASE WHEN {n} < 0 THEN -{q} ELSE {q} END)"


def to_decimal_sql(q: str, digits: int, precision: int = 18) -> str:
    return f"CAST(CAST(({q}) AS DECIMAL(38,0)) * {Decimal(1).scaleb(-digits)}BD AS DECIMAL({precision},{digits}))"


def scaled_sql(c: str, scale: int = 6) -> str:
    return f"CAST(({c}) * {10**scale} AS DECIMAL(38,0))"


def mean_half_up_sql(s: str, n: str, digits: int, scale: int = 6) -> str:
    num = f"CAST(({s}) AS DECIMAL(38,0)) * {10**digits}"
    den = f"CAST(({n}) AS DECIMAL(38,0)) * {10**scale}"
    return to_decimal_sql(round_div_sql(num, den), digits)


def round_ratio_sql(num: str, den: str, digits: int) -> str:
    return to_decimal_sql(round_div_sql(f"CAST(({num}) AS DECIMAL(38,0)) * {10**digits}", den), digits)


def int_div(a, b) -> Column:
    """Truncating integer division (SQL ``div``) of two integral columns."""
    return F.call_function("div", _col(a).cast(WIDE_INT), _col(b).cast(WIDE_INT))


def scaled_int(c, scale: int = 6) -> Column:
    """Exact integer ``c * 10^scale`` of a decimal column, as ``decimal(38,0)``."""
    if isinstance(c, str):
        return F.expr(scaled_sql(c, scale))
    return (c * F.lit(10**scale)).cast(WIDE_INT)


def round_div(num, den) -> Column:
    """Integer ``num / den`` rounded half away from zero; NULL when ``den`` is 0 or NULL.

    ``(2*|n| + d) div (2*d)`` for ``d > 0`` with the sign of ``n`` restored by ``CASE``
    (``sign`` is a double in Spark and would turn small negatives into -0.0).
    """
    if _all_sql(num, den):
        return F.expr(round_div_sql(num, den))
    n = _col(num).cast(WIDE_INT)
    d = F.nullif(_col(den).cast(WIDE_INT), F.lit(0))
    q = int_div(F.abs(n) * 2 + d, d * 2)
    return F.when(n < 0, -q).otherwise(q)


def to_decimal(q, digits: int, precision: int = 18) -> Column:
    """Integer ``q`` times ``10^-digits`` as ``decimal(precision, digits)`` (exact).

    Narrow on purpose: arithmetic on ``decimal(38, s)`` operands makes Spark drop scale
    ("precision loss"), e.g. ``decimal(38,2) - 2`` would come back at scale 1.
    """
    if isinstance(q, str):
        return F.expr(to_decimal_sql(q, digits, precision))
    step = Decimal(1).scaleb(-digits)
    return (q.cast(WIDE_INT) * F.lit(step)).cast(f"decimal({precision},{digits})")


def mean_half_up(sum_scaled, n, digits: int, scale: int = 6) -> Column:
    """Exact mean of values whose total is ``sum_scaled`` at ``10^scale``, rounded to
    ``digits`` half away from zero. A NULL total or ``n = 0`` gives NULL.
    """
    if _all_sql(sum_scaled, n):
        return F.expr(mean_half_up_sql(sum_scaled, n, digits, scale))
    num = _col(sum_scaled).cast(WIDE_INT) * F.lit(10**digits)
    den = _col(n).cast(WIDE_INT) * F.lit(10**scale)
    return to_decimal(round_div(num, den), digits)


def round_ratio(num, den, digits: int) -> Column:
    """``round(num / den, digits)`` for integral num and den: exact, half away from zero."""
    if _all_sql(num, den):
        return F.expr(round_ratio_sql(num, den, digits))
    return to_decimal(round_div(_col(num).cast(WIDE_INT) * F.lit(10**digits), den), digits)


def round_half_up(c, digits: int) -> Column:
    """``round(decimal, digits)``: Spark rounds decimals half away from zero already."""
    return F.round(_col(c), digits)


def cents(c) -> Column:
    """Whole cents of a double that holds exactly two decimals."""
    return F.round(_col(c) * 100).cast("bigint")
