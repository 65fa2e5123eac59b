"""The eight-bit record flag set."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Flag names and bits, in the order they are printed.
FLAG_BITS = {
    "f_last": 128,
    "f_tob": 64,
    "f_snapshot": 32,
    "f_mbp": 16,
    "f_bad_ts_recv": 8,
    "f_maybe_bad_book": 4,
    "f_publisher_specific": 2,
}


def has_flag(flags: Column, name: str) -> Column:
    return flags.bitwiseAND(F.lit(FLAG_BITS[name.lower()])) != 0


def flags_text(flags: Column) -> Column:
    """``f_last, f_tob`` and so on; empty text when no known bit is set."""
    names = [F.when(has_flag(flags, n), F.lit(n)) for n in FLAG_BITS]
    return F.when(flags.isNotNull(), F.concat_ws(", ", *names))
