"""Money arithmetic that gives the same answer on every engine.

PostgreSQL numeric, Spark decimal and DuckDB disagree on division scale and on rounding ties.
The rule here: keep exact decimal *numerators* (sums of gross amounts, times 100 for the VAT
removal), divide once at the end, and round to whole cents half away from zero (what PostgreSQL
``ROUND(numeric, 2)`` does) with integer arithmetic.  Sums stay exact decimals; nothing is
summed after a division.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..operators.rules import VAT_DIVISOR

DEFAULT_SCALE = 4      # all numerators carry at most 4 decimals (price * 85.75 has 4)


def _dec0(c: Column) -> Column:
    return c.cast("decimal(38,0)")


def div_round_half_away(num: Column, den) -> Column:
    """``round(num / den)`` to an integer, half away from zero.

    ``num`` must be integer valued, ``den`` a positive integer (int or Column). Exact; NULL in,
    NULL out.  Result is a bigint.
    """
    n = _dec0(num)
    d = _dec0(F.lit(den)) if isinstance(den, int) else _dec0(den)
    q = F.call_function("div", F.abs(n) * 2 + d, d * 2)
    return F.when(n < 0, -q).otherwise(q)


def ratio_round(numerator: Column, denominator, places: int = 2,
                scale: int = DEFAULT_SCALE) -> Column:
    """``round(numerator / denominator, places)`` as an integer count of ``10^-places`` units.

    Both operands are exact decimals with at most ``scale`` decimals (or integers).  The factors
    are decimals: a bigint times a bigint factor overflows from 9.2e12 on.
    """
    k = 10 ** scale
    den = denominator * k if isinstance(denominator, int) else denominator * F.lit(Decimal(k))
    return div_round_half_away(_dec0(numerator * F.lit(Decimal(10 ** places * k))), den)


def cents(numerator: Column, denominator=1, scale: int = DEFAULT_SCALE) -> Column:
    """Whole cents of ``numerator / denominator``; operands have at most ``scale`` decimals."""
    return ratio_round(numerator, denominator, 2, scale)


def net_cents(gross_sum: Column) -> Column:
    """Cents of ``gross * 100 / 111`` (remove 11 % VAT) from an exact gross sum."""
    return cents(gross_sum * F.lit(100), VAT_DIVISOR)


def from_cents(c: Column) -> Column:
    """Cents (bigint) to a double amount with two decimals."""
    return c.cast("double") / F.lit(100.0)


def amount(numerator: Column, denominator: int = 1, scale: int = DEFAULT_SCALE) -> Column:
    return from_cents(cents(numerator, denominator, scale))


def rupiah_text(value: Column) -> Column:
    """``1234567.5`` -> ``'1.234.568'``: round half away to whole rupiah, '.' between thousands."""
    whole = cents(value, 100)
    return F.translate(F.format_number(whole, 0), ",", ".")


def fixed_text(scaled: Column, decimals: int) -> Column:
    """Text of an integer count of 10^-decimals units, e.g. (1234, 2) -> '12.34', (-5, 1) -> '-0.5'."""
    p = 10 ** decimals
    a = F.abs(scaled)
    frac = F.lpad((a % F.lit(p)).cast("string"), decimals, "0")
    body = F.concat(F.call_function("div", a, F.lit(p)).cast("string"), F.lit("."), frac)
    return F.when(scaled < 0, F.concat(F.lit("-"), body)).otherwise(body)


# --- SQL text of the same functions (oracle side) ---------------------------------------------

def sql_div_round_half_away(num: str, den: str) -> str:
    n = f"CAST({num} AS HUGEINT)"
    return (f"((CASE WHEN {n} < 0 THEN -1 ELSE 1 END) * "
            f"((2 * abs({n}) + CAST({den} AS HUGEINT)) // (2 * CAST({den} AS HUGEINT))))")


def sql_ratio_round(numerator: str, denominator: int | str, places: int = 2,
                    scale: int = DEFAULT_SCALE) -> str:
    k = 10 ** scale
    den = f"({denominator}) * {k}" if isinstance(denominator, str) else str(denominator * k)
    num = f"({numerator}) * {10 ** places * k}"
    return f"CAST({sql_div_round_half_away(num, den)} AS BIGINT)"


def sql_cents(numerator: str, denominator: int | str = 1, scale: int = DEFAULT_SCALE) -> str:
    return sql_ratio_round(numerator, denominator, 2, scale)



def sql_from_cents(c: str) -> str:
    return f"(CAST({c} AS DOUBLE) / 100.0)"


def sql_amount(numerator: str, denominator: int | str = 1, scale: int = DEFAULT_SCALE) -> str:
    return sql_from_cents(sql_cents(numerator, denominator, scale))


def sql_rupiah_text(value: str) -> str:
    return f"replace(format('{{:,}}', {sql_cents(value, 100)}), ',', '.')"


def sql_fixed_text(scaled: str, decimals: int) -> str:
    p = 10 ** decimals
    body = (f"(CAST(abs({scaled}) // {p} AS VARCHAR) || '.' || "
            f"lpad(CAST(abs({scaled}) % {p} AS VARCHAR), {decimals}, '0'))")
    return f"(CASE WHEN {scaled} < 0 THEN '-' || {body} ELSE {body} END)"
