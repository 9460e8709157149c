"""Money arithmetic that gives the same digits on every engine.

Amounts are doubles at rest (reference schema). They are read as DECIMAL with
six decimals, so amounts below a cent count; sums run in DECIMAL (order
independent, unlike float sums) and are rounded once, at the end. Ratios and
means are rounded half-up in integer arithmetic, so there is no double
rounding and no engine-specific float rounding (Spark rounds doubles half-up
on their decimal text, other engines on the binary value).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(28,6)"


def as_money(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.cast(MONEY)


def money_sum(col: Column | str) -> Column:
    """SUM over money, exact."""
    return F.sum(as_money(col))


def cents(col: Column) -> Column:
    """Hundredths of an exact amount, with what is below a cent as decimals."""
    return col.cast("decimal(34,6)") * 100


def round2_double(dec: Column) -> Column:
    """ROUND(x, 2) of an exact decimal, emitted as double."""
    return F.round(dec, 2).cast("double")


def int_div(a: Column, b: Column) -> Column:
    """a DIV b, exact for integers and whole decimals of any size."""
    return F.call_function("div", a, b)


def ratio_round2(num_hundredths: Column, den: Column) -> Column:
    """ROUND(n / d, 2) where ``num_hundredths`` = 100 * n has at most four
    decimals and d is an integer.

    Half-up (away from zero) like Spark's decimal ROUND; NULL when d = 0.
    """
    n = num_hundredths.cast("decimal(32,4)")
    d = den.cast("bigint").cast("decimal(19,0)")
    sign = F.when((n < 0) != (d < 0), F.lit(-1)).otherwise(F.lit(1))
    top = ((F.abs(n) * 2 + F.abs(d)) * 10000).cast("decimal(38,0)")
    quotient = int_div(top, (F.abs(d) * 20000).cast("decimal(38,0)"))
    # As a decimal to the last step: a double holds no whole number above 2**53.
    hundredths = (sign * quotient).cast("decimal(19,0)") * F.lit(Decimal("0.01"))
    return F.when(d != 0, hundredths.cast("double"))


def mean_round2(sum_hundredths: Column, count: Column) -> Column:
    """ROUND(AVG(x), 2) from the exact sum (in hundredths) and the row count."""
    return ratio_round2(sum_hundredths, count)
