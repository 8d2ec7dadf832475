"""Column functions the scripts define or need beyond single Spark built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ts_text(col: str | Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss")


def day_text(col: str | Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd")


def money(col: str | Column) -> Column:
    """Exact two-digit decimal, so that sums do not depend on row order."""
    return (F.col(col) if isinstance(col, str) else col).cast("decimal(18,2)")


def exact_sum(col: str | Column) -> Column:
    return F.sum(money(col)).cast("double")


def exact_avg(col: str | Column) -> Column:
    return F.sum(money(col)).cast("double") / F.count(col)


def java_hash(col: str | Column) -> Column:
    """32-bit string hash ``h = 31*h + unit`` over UTF-16 code units; null stays null.

    Characters above U+FFFF contribute their two surrogate units.
    """
    text = F.col(col) if isinstance(col, str) else col
    chars = F.filter(F.split(text, ""), lambda c: c != "")

    def step(acc: Column, ch: Column) -> Column:
        code = F.ascii(ch).cast("bigint")
        high = F.lit(0xD800) + F.shiftright(code - 0x10000, 10)
        low = F.lit(0xDC00) + (code - 0x10000) % 1024
        one = (acc * 31 + code).bitwiseAND(F.lit(0xFFFFFFFF))
        two = (((acc * 31 + high).bitwiseAND(F.lit(0xFFFFFFFF))) * 31 + low).bitwiseAND(
            F.lit(0xFFFFFFFF)
        )
        return F.when(code > 0xFFFF, two).otherwise(one)

    unsigned = F.aggregate(chars, F.lit(0).cast("bigint"), step)
    return F.when(unsigned >= 2**31, unsigned - 2**32).otherwise(unsigned).cast("int")


def bucketed_key(dept: Column, member: Column, buckets: int = 10) -> Column:
    """Row key ``<2-digit bucket>_<dept>_<member>`` that spreads departments."""
    bucket = F.abs(java_hash(dept).cast("bigint")) % buckets
    return F.concat_ws("_", F.lpad(bucket.cast("string"), 2, "0"), dept, member)


def ceil_to(unit: str, ts: str | Column) -> Column:
    """Smallest ``unit`` boundary not before ``ts``; an aligned value is kept."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    floor = F.date_trunc(unit, ts)
    up = F.timestamp_add(unit.upper(), F.lit(1), floor)
    return F.when(floor == ts, floor).otherwise(up)


def slot_text(ts: str | Column, minutes: int) -> Column:
    """``HHmm`` of the slot of ``minutes`` the time falls in."""
    start = F.floor(F.minute(ts) / minutes) * minutes
    return F.concat(
        F.lpad(F.hour(ts).cast("string"), 2, "0"), F.lpad(start.cast("string"), 2, "0")
    )


def slot_last_minute(ts: str | Column, minutes: int) -> Column:
    """Last minute of the slot within its hour, e.g. 14, 29, 44, 59 for 15 minutes."""
    return ((F.floor(F.minute(ts) / minutes) + 1) * minutes - 1).cast("int")


def time_slice(ts: str | Column, seconds: int, origin: str = "1970-01-01 00:00:00") -> Column:
    """Start of the slice of ``seconds`` counted from ``origin``."""
    ts = (F.col(ts) if isinstance(ts, str) else ts).cast("timestamp")
    base = F.unix_timestamp(F.lit(origin))
    return F.timestamp_seconds(
        base + F.floor((F.unix_timestamp(ts) - base) / seconds) * seconds
    )


def round_up_decimal(text: str | Column) -> Column:
    """Parse, round away from zero to 2 digits; null beyond DECIMAL(5,2) or if not a number."""
    text = F.col(text) if isinstance(text, str) else text
    number = text.try_cast("decimal(28,10)")
    up = F.ceil(F.abs(number) * 100) * F.signum(number).cast("int")
    return (up.cast("decimal(28,2)") / 100).try_cast("decimal(5,2)")


def level_of(years: Column) -> Column:
    """Letter for a rounded number of years (bounds are fixed values)."""
    out = F.when(years < 0, "-")
    for bound, letter in ((3, "F"), (6, "E"), (9, "D"), (12, "C"), (15, "B"), (18, "A")):
        out = out.when(years <= bound, letter)
    return out.otherwise("S")
