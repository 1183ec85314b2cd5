"""Column-expression helpers (all JVM-side, codegen friendly)."""

from .casts import lenient_cast
from .times import (EPOCH_NTZ, epoch_ms_of, format_iso_utc, instant_to_utc_ntz, ntz_from_epoch_ms,
                    parse_timestamp, trunc_ntz)
from .money import avg_money, money, pct, round2_double

__all__ = [
    "lenient_cast", "EPOCH_NTZ", "epoch_ms_of", "format_iso_utc", "instant_to_utc_ntz", "ntz_from_epoch_ms",
    "parse_timestamp", "trunc_ntz", "avg_money", "money", "pct", "round2_double",
]
