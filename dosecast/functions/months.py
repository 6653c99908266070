"""Month arithmetic on a single month index ``year*12 + month - 1``.

The reference mixes ``yyyymm - 202000`` and ``yyyymm00`` integers; one index
removes the year-end special cases (December + 1 is simply index + 1).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def mi_of(ts) -> Column:
    """Month index of a date / timestamp column."""
    ts = _c(ts)
    return (F.year(ts) * 12 + F.month(ts) - 1).cast("int")


def mi_of_yyyymm(ym) -> Column:
    """Month index of an integer ``yyyymm``."""
    ym = _c(ym)
    return (F.floor(ym / 100) * 12 + ym % 100 - 1).cast("int")


def yyyymm_of_mi(mi) -> Column:
    mi = _c(mi)
    return (F.floor(mi / 12) * 100 + mi % 12 + 1).cast("int")


def mi_first_day(mi) -> Column:
    mi = _c(mi)
    return F.make_date(F.floor(mi / 12).cast("int"), (mi % 12 + 1).cast("int"), F.lit(1))


def mi_last_day(mi) -> Column:
    return F.last_day(mi_first_day(mi))


def datekey_of(ts) -> Column:
    """``yyyymmdd`` integer of a date / timestamp."""
    ts = _c(ts)
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("int")


def lenient_date(key) -> Column:
    """``yyyymmdd`` (int or string) to date; a bad value gives null."""
    return F.try_to_timestamp(_c(key).cast("string"), F.lit("yyyyMMdd")).cast("date")


def fold_month(mi, start) -> Column:
    """Position of a month inside its training year, 1..12, then 13...

    The reference folds ``101 -> 13``: months after the start year's December
    continue counting.  With a month index that is the offset from January of
    the start year, plus one.
    """
    mi = _c(mi)
    start = _c(start) if not isinstance(start, int) else F.lit(start)
    return (mi - F.floor(start / 12) * 12 + 1).cast("int")


def brand_no(col) -> Column:
    """``Brand#17`` -> 17 (fixture key of a medicine).

    ``try_cast``: Catalyst may evaluate this on rows a later filter removes
    (e.g. closed SCD2 versions), where an ANSI cast would raise.
    """
    return F.substring(_c(col), 7, 20).try_cast("int")
