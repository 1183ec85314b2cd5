"""Tolerant casts from text, used after parsing JSON fields as STRING.

A typed JSON parse turns the string ``"7"`` into NULL for an INT field, and
the number ``4.0`` into NULL for a BIGINT field.  Parsing every field as
STRING and casting afterwards reads both; a bad value becomes NULL instead
of failing the batch.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts with these are not such numbers.  A cast that fails does so by an
# exception, inside, which costs more than the rest of a row.
_NO_INTEGER = r"[.A-Za-z\[\{]"
_NO_DECIMAL = r"[A-DF-Za-df-z\[\{]"
#: "nan", "inf" and "infinity" are numbers, and so are "0x1p3" and "1.5d".
_NO_FLOAT = r"^[A-HJ-MO-Za-hj-mo-z\[\{]"
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def lenient_cast(c: Column, to: T.DataType) -> Column:
    """``try_cast`` of a text column; integral targets also accept a number
    with a zero fraction (``"4.0"``, ``"1e2"``), a true fraction stays NULL."""
    if isinstance(to, T.StringType):
        return c
    if isinstance(to, _INTEGRAL):
        direct = F.when(~c.rlike(_NO_INTEGER), c.try_cast(to))
        dec = F.when(~c.rlike(_NO_DECIMAL), c.try_cast(T.DecimalType(38, 10)))
        via_dec = F.when(dec == F.floor(dec), dec.try_cast(to))
        return F.coalesce(direct, via_dec)
    if isinstance(to, (T.FloatType, T.DoubleType)):
        return F.when(~c.rlike(_NO_FLOAT), c.try_cast(to))
    return c.try_cast(to)
