"""Money arithmetic: DECIMAL(10,2) inside, DOUBLE only where a ratio is made."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import MONEY


def money(c: Column) -> Column:
    """Cast to DECIMAL(10,2) (half-up; ANSI raises on overflow)."""
    return c.cast(MONEY)


def round2_double(x: Column) -> Column:
    """Round a DOUBLE to cents as ``round(x*100)/100`` (half away from zero
    on the binary value), the rounding analytical SQL engines apply to
    DOUBLE averages."""
    return F.round(x * F.lit(100.0)) / F.lit(100.0)


def avg_money(c: Column) -> Column:
    """AVG of a money column as DOUBLE rounded to cents; NULL for no rows.

    Summed exactly as DECIMAL, divided once in DOUBLE.
    """
    n = F.count(c)
    return round2_double(F.sum(c).cast(T.DoubleType()) / F.nullif(n, F.lit(0)).cast(T.DoubleType()))


def pct(part: Column, whole: Column) -> Column:
    """``round(100.0 * part / nullif(whole, 0), 2)`` in exact DECIMAL
    arithmetic, returned as DOUBLE."""
    return F.round(F.lit(Decimal("100.0")) * part / F.nullif(whole, F.lit(0)), 2).cast(T.DoubleType())
