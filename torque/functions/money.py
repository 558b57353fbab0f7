"""Decimal types and exact HALF_UP rounding of ratios.

Spark keeps at least 6 fractional digits when a decimal division loses
precision, so ``round(a / b * 100, 2)`` can round twice once the operands are
wide. The reference's warehouse computes in exact decimals; to match it at
any scale we round ratios on unscaled integers instead:

    R = sign * ((2 * |N| * M + |D|) div (2 * |D|))

with ``N``/``D`` the operands scaled to integers and ``M`` the power of ten
that places the requested number of decimals. Everything stays a built-in
column expression (codegen, no UDF).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Column types of the model (declared types of the reference DDL).
UNIT_PRICE = DecimalType(10, 2)      # parts unit price
MONEY = DecimalType(12, 2)           # sale price, parts cost, margin
MARGIN_PCT = DecimalType(6, 4)       # gross_margin_pct
# Report output types (chosen once, used by Spark and oracle alike).
MONEY_SUM = DecimalType(22, 2)       # SUM of a MONEY column
WIDE_MONEY = DecimalType(38, 2)      # products of sums (segment cost estimate)
RATIO2 = DecimalType(18, 2)          # rounded averages and percentages

_INT = DecimalType(38, 0)


def _unscaled(c: Column, scale: int) -> Column:
    """Exact integer value of ``c * 10**scale`` as DECIMAL(38,0)."""
    if scale == 0:
        return c.cast(_INT)
    return (c.cast(DecimalType(38, scale)) * F.lit(10 ** scale)).cast(_INT)


def _int_div(a: Column, b: Column) -> Column:
    """Exact floor division of non-negative DECIMAL(38,0) ``a`` by positive ``b``.

    ``a - a % b`` is a multiple of ``b``, so the decimal quotient is an exact
    integer and no 6-digit rounding can move it.
    """
    return ((a - a % b) / b).cast("long")


def round_div(num: Column, den: Column, *, num_scale: int, den_scale: int,
              out_scale: int, factor: int = 1,
              out_type: DecimalType = RATIO2) -> Column:
    """``ROUND(factor * num / NULLIF(den, 0), out_scale)`` computed exactly.

    ``num``/``den`` are decimals (or integers) with at most ``num_scale`` /
    ``den_scale`` fractional digits. NULL when ``den`` is 0 or NULL, as with
    the reference's NULLIF guard. HALF_UP, away from zero for negatives.
    """
    n = _unscaled(num, num_scale)
    d = _unscaled(den, den_scale)
    e = out_scale + den_scale - num_scale
    if e >= 0:
        n = (n * F.lit(factor * 10 ** e)).cast(_INT)
    else:
        n = (n * F.lit(factor)).cast(_INT)
        d = (d * F.lit(10 ** (-e))).cast(_INT)
    two = F.lit(2).cast(_INT)
    q = _int_div((two * F.abs(n) + F.abs(d)).cast(_INT), (two * F.abs(d)).cast(_INT))
    signed = F.when((n < 0) != (d < 0), -q).otherwise(q).cast(DecimalType(20, 0))
    if out_scale:
        signed = signed * F.lit(Decimal(1).scaleb(-out_scale))
    return F.when(d != 0, signed.cast(out_type))


def avg_round(col: Column, *, col_scale: int, out_scale: int = 2, factor: int = 1,
              out_type: DecimalType = RATIO2) -> Column:
    """``ROUND(AVG(col) * factor, out_scale)`` exactly (aggregate expression)."""
    return round_div(F.sum(col), F.count(col), num_scale=col_scale, den_scale=0,
                     out_scale=out_scale, factor=factor, out_type=out_type)
