"""Decimal half-up rounding.

``round(double, n)`` rounds the binary value; engines differ on values whose
decimal expansion sits on a tie. Every rounded output here goes through an
8-place decimal first, so Spark and any SQL engine agree on every cell (a value
within 5e-9 of a tie therefore rounds as the tie). The decimal is wide enough
for any sum, and from 1e16 on, where a double has no fraction left, it is the
value itself.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


FAST_BELOW = 1e5   # where a double's error is far below the eighth place
FAST_PLACES = 6


def _through_decimal(n: int):
    def rounded(v: Column) -> Column:
        x = v.cast("double")
        return F.when(F.abs(x) < 1e16, F.round(v.cast("decimal(38,8)"), n).cast("double")).otherwise(x)
    return rounded


def round_half_up(c, n: int) -> Column:
    """Worked out in doubles where they decide it: with ``u`` the distance below
    the tie between two results, the eight-place decimal goes up from 5e-9
    below the tie on. Only values so near that border that a double's error
    could matter, and large ones, go through the decimal."""
    c = F.col(c) if isinstance(c, str) else c
    x = c.cast("double")
    size = F.abs(x)
    # as an array's transform: Spark generates code of split, small methods for what holds one, where one
    # method for a whole stage soon has over 8000 bytes, which the JVM does not compile
    exact = F.transform(F.array(c), _through_decimal(n))[0]
    if not 0 <= n <= FAST_PLACES:
        return exact
    unit = 10.0 ** n
    border = 5e-9 * unit
    down = F.floor(size * F.lit(unit))
    u = down + F.lit(0.5) - size * F.lit(unit)
    whole = down + F.when(u < border, 1).otherwise(0)  # a whole number: no negative zero
    fast = F.when(x < 0, -whole).otherwise(whole).cast("double") / F.lit(unit)
    return F.when((size < FAST_BELOW) & (F.abs(u - F.lit(border)) > border / 10), fast).otherwise(exact)


def round_sql(expr: str, n: int) -> str:
    """The same rounding as SQL text (for oracles and SQL-defined views)."""
    return (f"CASE WHEN ABS({expr}) < 1e16 THEN CAST(ROUND(CAST({expr} AS DECIMAL(38,8)), {n}) AS DOUBLE) "
            f"ELSE CAST({expr} AS DOUBLE) END")
