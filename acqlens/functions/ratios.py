"""Guarded decimal ratios: NULL instead of a division that makes no sense."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType


# Operands are money (2 decimals), counts, or money times a short decimal factor. Casting both to
# decimal(28,4) is exact for them and makes Spark's quotient carry 10 decimals, so the final
# HALF_UP cast rounds (practically) once, like an exact division would.
_OPERAND = DecimalType(28, 4)


def _quotient(num: Column, den: Column) -> Column:
    return num.cast(_OPERAND) / den.cast(_OPERAND)


def ratio(num: Column, den: Column, precision: int, scale: int, when: Column | None = None) -> Column:
    """``cast(num / den as decimal(p, s))`` (HALF_UP) when ``when`` holds (default ``den > 0``), else NULL."""
    guard = (den > 0) if when is None else when
    return F.when(guard, _quotient(num, den).cast(DecimalType(precision, scale)))


def nullif_ratio(num: Column, den: Column, precision: int, scale: int) -> Column:
    """``cast(num / nullif(den, 0) as decimal(p, s))``: NULL only when the denominator is 0 or NULL."""
    return F.when(den != 0, _quotient(num, den).cast(DecimalType(precision, scale)))
