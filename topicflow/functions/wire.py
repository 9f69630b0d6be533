"""Column functions for the wire form of values."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def long_hex(value: Column) -> Column:
    """A long as 16 upper-case hex digits, most significant byte first."""
    return F.lpad(F.hex(value.cast("bigint")), 16, "0")


def encode_long(value: Column) -> Column:
    """A long as 8 big-endian bytes, the form long values take in a topic."""
    return F.unhex(long_hex(value))


def decode_long(value: Column) -> Column:
    """Inverse of :func:`encode_long`.

    The top byte is read apart because ``conv`` is unsigned: 8 bytes with the sign
    bit set would not fit a bigint.
    """
    digits = F.hex(value)
    high = F.conv(F.substring(digits, 1, 2), 16, 10).cast("bigint")
    low = F.conv(F.substring(digits, 3, 14), 16, 10).cast("bigint")
    signed_high = F.when(high > 127, high - 256).otherwise(high)
    return signed_high * F.lit(1 << 56) + low


def epoch_micros(timestamp_ntz: Column) -> Column:
    """Microseconds since 1970-01-01 for a zone-less timestamp.

    Put together from the date and the clock fields, so that the session zone and its
    clock changes have no part in it.
    """
    seconds = F.hour(timestamp_ntz) * 3600 + F.minute(timestamp_ntz) * 60
    micros = (F.extract(F.lit("SECOND"), timestamp_ntz) * 1_000_000).cast("bigint")
    days = F.unix_date(timestamp_ntz.cast("date")).cast("bigint")
    return days * 86_400_000_000 + seconds.cast("bigint") * 1_000_000 + micros
