"""Numbers: lenient casts (F10) and exact half-away-from-zero rounding.

Spark and DuckDB round doubles differently (``round(1.005, 2)``), and Spark cuts
``avg(decimal)`` to six digits before any second rounding. The helpers below
round an average from its exact integer total and count instead:
``sign(c) * ((2*|c| + n) div (2*n))`` where ``c`` is the total in units of the
last kept digit. The result is a double, as the dashboards expect.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def try_int(c) -> Column:
    """text/number -> int; '', '1.0', 'x' -> null; ' 3 ' -> 3."""
    return _col(c).try_cast("int")


def try_double(c) -> Column:
    return _col(c).try_cast("double")


def to_money(c) -> Column:
    """Round to a ``decimal(12,2)`` amount (half up, as an insert into NUMERIC). An amount
    too large for it is an error, as the insert would be; text that is no number is null."""
    money = _col(c).try_cast("decimal(12,2)")
    lost = money.isNull() & _col(c).try_cast("double").isNotNull()
    return F.when(lost, F.raise_error(F.concat(F.lit("amount out of range: "), _col(c).cast("string")))
                  .cast("decimal(12,2)")).otherwise(money)


def round_ratio(total_units, count, digits: int = 0) -> Column:
    """Round ``total_units / count`` half away from zero, then scale by 10^-digits.

    ``total_units`` must be an exact integer (bigint or decimal with scale 0) in
    units of the last digit kept; null when ``count`` is 0 or null.
    """
    t = _col(total_units).cast("decimal(38,0)")
    n = _col(count).cast("decimal(38,0)")
    x = F.abs(t) * 2 + n
    d = n * 2
    # Exact integer division: subtract the remainder, then the quotient is whole.
    q = ((x - F.pmod(x, d)) / d).cast("decimal(38,0)") * F.signum(t).cast("decimal(38,0)")
    scaled = q.cast("double") / F.lit(float(10 ** digits))
    return F.when(n > 0, scaled)


def round_avg_money(total_money, count, digits: int = 2) -> Column:
    """Average of a decimal money column with 2 decimals, rounded to ``digits``.

    ``total_money`` is ``sum(decimal(p,2))``; exact for any count.
    """
    units = (_col(total_money) * F.lit(100)).cast("decimal(38,0)")
    if digits == 2:
        return round_ratio(units, count, 2)
    # Fewer digits: scale the count instead of the total.
    factor = 10 ** (2 - digits)
    return round_ratio(units, _col(count).cast("decimal(38,0)") * F.lit(factor), digits)


def round_avg_whole(total, count, digits: int = 1) -> Column:
    """Average of a whole-number column (e.g. days), rounded to ``digits``."""
    units = _col(total).cast("decimal(38,0)") * F.lit(10 ** digits)
    return round_ratio(units, count, digits)
