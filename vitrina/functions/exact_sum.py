"""Sums and averages of doubles that do not depend on the order of the rows.

A sum of doubles in shuffle order changes its last bits with the number of partitions or after a retried task.  Here every value is cut into
limbs of 32 bits at fixed binary places, the limbs are summed as 64-bit integers, which is exact in any order, and the totals are put
together once.  All of it is built-in aggregates with partial aggregation, and works over windows as well.

Four limbs from 2^-76 up hold values below 2^51 (prices and shares lie far inside); bits of a value below 2^-76 are rounded in that value alone, so
the order still does not matter.  A group may hold 2^31 rows.  Values of 2^51 and more, infinities and NaN are added up as
plain doubles beside the limbs.  The result is within one rounding of the true sum; the sum of one value is that value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WIDTH, LIMBS, LOWEST = 32, 4, -76
_PLACES = [LOWEST + WIDTH * k for k in range(LIMBS)]  # from the lowest limb to the highest
_LIMIT = LOWEST + WIDTH * LIMBS - 1


def _power(exponent: int) -> str:
    """A power of two as a double literal."""
    return f"{2.0 ** exponent!r}D".replace("e", "E")


def _limbs(x: str) -> list[str]:
    """The signed limbs of a double below the limit, lowest first; the remainder of a division by a power of two is exact."""
    out = []
    for k, place in enumerate(_PLACES):
        part = f"abs({x})" if k == LIMBS - 1 else f"(abs({x}) % {_power(place + WIDTH)})"
        out.append(f"cast({'floor' if k else 'rint'}({part} * {_power(-place)}) AS bigint) * cast(signum({x}) AS bigint)")
    return out


def _joined(sums: list[str]) -> str:
    """The double nearest to the total, added up from the lowest limb.

    Carries first bring every limb but the highest into -2^31 .. 2^31 - 1, so the limbs below one are worth half its unit at most and
    nothing cancels.
    """
    total, carry = "0D", ""
    for s, place in zip(sums, _PLACES, strict=True):
        full = f"({s}{carry})"
        if place != _PLACES[-1]:
            over = f"shiftright({full} + {1 << (WIDTH - 1)}L, {WIDTH})"
            full, carry = f"({full} - shiftleft({over}, {WIDTH}))", f" + {over}"
        total = f"({total} + cast({full} AS double) * {_power(place)})"
    return total


def _sum(value: str, over: str) -> str:
    x = f"cast({value} AS double)"
    inside = f"abs({x}) < {_power(_LIMIT)}"  # false for NaN, which compares as the largest number
    near = f"(CASE WHEN {inside} THEN {x} WHEN {x} IS NOT NULL THEN 0D END)"
    far = f"coalesce(sum(CASE WHEN NOT ({inside}) THEN {x} END){over}, 0D)"
    return f"{_joined([f'sum({limb}){over}' for limb in _limbs(near)])} + {far}"


def exact_sum(value: str, over: str = "") -> Column:
    """The sum of the doubles of an SQL expression, equal for every order of the rows; null for no value.

    ``over`` is the text of a window, such as ``OVER (PARTITION BY g)``.
    """
    return F.expr(_sum(value, f" {over}"))


def exact_avg(value: str, over: str = "") -> Column:
    """The average, from the exact sum and the number of values; null for no value."""
    return F.expr(f"({_sum(value, f' {over}')}) / nullif(count({value}) {over}, 0)")
