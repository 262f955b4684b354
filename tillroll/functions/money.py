"""Exact sums of money held as DOUBLE.

A sum of doubles depends on the order in which tasks finish. A sum through
DECIMAL does not, but turns every value into a decimal object. Here each amount
is split into whole units and three times six decimals, each part is summed as
BIGINT inside code generation, and one decimal is built per group. Amounts keep
the decimals that a DOUBLE holds, 18 at most: what is left of an amount below its
own precision is no digit of it. NaN counts as missing, as it does for Spark's
null functions; an infinite amount raises.

Sums come in two steps, so that rows can be summed by a join key before the join
and again after it: ``parts`` over rows, ``merged`` over such parts, ``value``
for the result. ``total_sql`` is the one-step form for SQL text, ``merged_sql``
that over parts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNITS = "amount_units"
#: Parts of a unit: millionths, millionths of those, and again.
MICROS, PICOS, ATTOS = "amount_micros", "amount_picos", "amount_attos"
COLUMNS = (UNITS, MICROS, PICOS, ATTOS)

# Twice the relative precision of a DOUBLE.
_PRECISION = "2.3E-16D"


def _parts_sql(amount: str) -> list[str]:
    """Whole units, and six decimals three times, of one amount."""
    double = f"CAST({amount} AS DOUBLE)"
    units = f"CAST(nanvl({double}, CAST(NULL AS DOUBLE)) AS BIGINT)"
    noise = f"abs({double}) * {_PRECISION}"
    micros = f"rint(({double} - {units}) * 1000000)"
    rest = f"({double} - {units} - {micros} / 1000000)"
    rest = f"if(abs({rest}) <= {noise}, 0D, {rest})"
    picos = f"rint({rest} * 1E12D)"
    last = f"({rest} - {picos} / 1E12D)"
    attos = f"rint(if(abs({last}) <= {noise}, 0D, {last}) * 1E18D)"
    return [units, *(f"CAST(nanvl({part}, CAST(NULL AS DOUBLE)) AS BIGINT)" for part in (micros, picos, attos))]


def _carried(part: str, lower: str) -> str:
    """A sum of parts and what a sum of the next lower parts carries into it."""
    return f"({part} + ({lower} - pmod({lower}, 1000000)) DIV 1000000)"


def _value_sql(units: str, micros: str, picos: str, attos: str, digits: int | None) -> str:
    picos = _carried(picos, attos)
    micros = _carried(micros, picos)
    units = _carried(units, micros)
    decimals = ", ".join(f"lpad(CAST(pmod({part}, 1000000) AS STRING), 6, '0')" for part in (micros, picos, attos))
    # 37 digits each: their sum then fits DECIMAL(38,18) without giving up a decimal.
    exact = f"(CAST({units} AS DECIMAL(37,18)) + CAST(concat('0.', {decimals}) AS DECIMAL(37,18)))"
    if digits is not None:
        exact = f"round({exact}, {digits})"
    return f"CAST({exact} AS DOUBLE)"


def parts(amount: str = "amount") -> list[Column]:
    """Aggregates over rows: the sums of units and of the three parts of a unit."""
    return [F.expr(f"sum({part})").alias(name) for name, part in zip(COLUMNS, _parts_sql(amount), strict=True)]


def merged() -> list[Column]:
    """Aggregates over rows that already hold ``parts``."""
    return [F.sum(name).alias(name) for name in COLUMNS]


def value(digits: int | None = 2) -> Column:
    """The sum as DOUBLE, half-up at ``digits`` decimals, or unrounded for None."""
    return F.expr(_value_sql(*COLUMNS, digits))


def total_sql(amount: str = "amount", digits: int | None = 2) -> str:
    """SQL text of the whole aggregate."""
    return _value_sql(*(f"sum({part})" for part in _parts_sql(amount)), digits)


def merged_sql(digits: int | None = 2) -> str:
    """SQL text of the whole aggregate over rows that already hold ``parts``."""
    return _value_sql(*(f"sum({name})" for name in COLUMNS), digits)
