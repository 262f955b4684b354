"""Percent of a total, rounded to two decimals in whole-number arithmetic.

ROUND on a DOUBLE depends on how the engine prints the number, so the result is
found as a whole number of hundredths of a percent and divided by 100 last.
"""

from __future__ import annotations

HALF_UP = "half_up"
HALF_EVEN = "half_even"


def percent_sql(n: str, total: str, rounding: str = HALF_UP) -> str:
    """SQL text of the percentage; ``n`` and ``total`` are BIGINT columns or expressions."""
    if rounding == HALF_UP:
        return f"CAST(({n} * 20000 + {total}) div (2 * {total}) AS DOUBLE) / 100"
    if rounding == HALF_EVEN:
        floor, twice_rest = f"({n} * 10000) div {total}", f"2 * (({n} * 10000) % {total})"
        return (
            f"CAST({floor} + CASE WHEN {twice_rest} > {total} THEN 1"
            f" WHEN {twice_rest} = {total} THEN ({floor}) % 2 ELSE 0 END AS DOUBLE) / 100"
        )
    raise ValueError(f"rounding must be {HALF_UP!r} or {HALF_EVEN!r}, not {rounding!r}")
