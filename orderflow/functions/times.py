"""Time helpers that do not depend on the session time zone.

Everything downstream of the wire format is ``TIMESTAMP_NTZ`` holding UTC
wall-clock time, so results are the same whatever zone a session runs in.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def EPOCH_NTZ() -> Column:  # noqa: N802 - reads like the constant it is
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")

# Text ends with a zone designator: Z, +hh, +hhmm or +hh:mm.
_OFFSET_SUFFIX = r"([Zz]|[+-][0-9]{2}(:?[0-9]{2})?)$"

ISO_UTC_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def ntz_from_epoch_ms(ms: Column) -> Column:
    """Epoch milliseconds -> UTC wall-clock TIMESTAMP_NTZ (exact, no float)."""
    return F.timestamp_add("MILLISECOND", ms, EPOCH_NTZ())


def epoch_ms_of(ts_ntz: Column) -> Column:
    """UTC wall-clock TIMESTAMP_NTZ -> epoch milliseconds (BIGINT)."""
    return F.timestamp_diff("MILLISECOND", EPOCH_NTZ(), ts_ntz)


def instant_to_utc_ntz(ts: Column) -> Column:
    """TIMESTAMP (an instant) -> its UTC wall-clock TIMESTAMP_NTZ."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), EPOCH_NTZ())



def parse_timestamp(text: Column, strict: bool = True) -> Column:
    """ISO-8601 text -> UTC TIMESTAMP_NTZ.

    Text with a zone designator is converted to UTC; text without one is
    taken as UTC already.  ``strict`` raises on unparsable text (ANSI cast),
    otherwise the value becomes NULL (quarantine by a later NULL check).
    """
    cast = (lambda c, t: c.cast(t)) if strict else (lambda c, t: c.try_cast(t))
    is_utc = text.endswith("Z") | text.endswith("z")
    utc_wall = F.substring(text, F.lit(1), F.length(text) - F.lit(1))   # drop the Z
    has_zone = text.rlike(_OFFSET_SUFFIX)
    return (F.when(is_utc, cast(utc_wall, T.TimestampNTZType()))
            .when(has_zone, instant_to_utc_ntz(cast(text, T.TimestampType())))
            .otherwise(cast(text, T.TimestampNTZType())))


def trunc_ntz(unit: str, ts_ntz: Column) -> Column:
    """``date_trunc`` that keeps TIMESTAMP_NTZ (Spark returns TIMESTAMP)."""
    return F.date_trunc(unit, ts_ntz).cast(T.TimestampNTZType())


def format_iso_utc(ts_ntz: Column) -> Column:
    """UTC wall-clock timestamp -> ``yyyy-MM-ddTHH:mm:ss.ffffffZ`` text."""
    return F.date_format(ts_ntz, ISO_UTC_FORMAT)
