"""Small helpers shared by the expression modules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def as_column(x) -> Column:
    """Column for a name, a number or a Column."""
    if isinstance(x, Column):
        return x
    return F.col(x) if isinstance(x, str) else F.lit(float(x))


def num(x: float) -> Column:
    return F.lit(float(x))


def ratio(a, b) -> Column:
    """a / b, null where b is 0: one odd row must not end a job under ANSI rules."""
    return F.try_divide(as_column(a), as_column(b))


def polynomial(x, coefficients: list[float]) -> Column:
    """Sum of c[n]·x^n, evaluated from the highest power down."""
    x = as_column(x)
    out = num(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        out = out * x + num(c)
    return out


def quadrature(*errors) -> Column:
    """Root of the sum of squares."""
    total = as_column(errors[0]) * as_column(errors[0])
    for e in errors[1:]:
        total = total + as_column(e) * as_column(e)
    return F.sqrt(total)


def settled(x, digits: int = 6) -> Column:
    """Rounded double without a negative zero, for comparable output."""
    return F.round(as_column(x), digits) + num(0.0)
