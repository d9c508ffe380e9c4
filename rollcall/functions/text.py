"""Text forms of numbers, dates and addresses."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from rollcall.functions.json import _col, blank_to_null

# Text patterns of dates, times and money.
PARTITION_DATE = "yyyyMMdd"
DATE = "yyyy-MM-dd"
DATE_TIME = "yyyy-MM-dd HH:mm:ss"
MONEY = "0.00"
PARTITION_LAG_DAYS = 8


def int_to_ipv4(ip) -> Column:
    """Dotted address of a signed 32-bit number."""
    ip = _col(ip).cast("int")
    octets = [
        F.shiftrightunsigned(ip, bits).bitwiseAND(F.lit(255)).cast("string")
        for bits in (24, 16, 8, 0)
    ]
    return F.concat_ws(".", *octets)


def money_text(amount) -> Column:
    """Two decimals, ties to even on the exact binary value, no grouping."""
    return F.call_function("format_number", _col(amount).cast("double"), F.lit(MONEY))


def money(text) -> Column:
    return F.trim(blank_to_null(text)).try_cast("decimal(18,2)")


def partition_date(day, lag_days: int = PARTITION_LAG_DAYS) -> Column:
    return F.date_format(F.date_sub(_col(day), lag_days), PARTITION_DATE)


def date_text(moment, with_time: bool = False) -> Column:
    return F.date_format(_col(moment), DATE_TIME if with_time else DATE)


def to_time(text) -> Column:
    return blank_to_null(text).try_cast("timestamp")


def timestamp_text(moment) -> Column:
    """Timestamp text that always carries a fraction, ``.0`` for whole seconds."""
    text = _col(moment).cast("string")
    return F.when(F.instr(text, ".") > 0, text).otherwise(F.concat(text, F.lit(".0")))
