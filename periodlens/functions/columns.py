"""Column-level building blocks.

Every helper returns a ``Column`` made only of built-in Spark expressions, so the
whole fact build and every report stay inside whole-stage codegen (no Python UDF).
Parsing helpers use the ``try_*`` family: Spark 4 runs with ANSI mode on, where a
plain ``cast('*' as double)`` or ``to_date('20250431')`` raises instead of
returning NULL.
"""

from __future__ import annotations

import re
from functools import reduce
from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Fixed values that define the analysis (they must stay exactly as below).
# Time bands: label -> first and last hour of day, both included; other hours (and NULL) are "other".
EVENING, NIGHT, LATE_NIGHT, OTHER = "evening", "night", "late_night", "other"
NIGHT_BANDS = {EVENING: (18, 20), NIGHT: (21, 23), LATE_NIGHT: (0, 2)}
# Spark dayofweek numbering: Sunday = 1 ... Saturday = 7; weekend = {1, 7}.
WEEKEND_DAYS = (1, 7)


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def time_band(hour: ColumnOrName) -> Column:
    """Night-time band of an hour of day."""
    labels = [F.when(_col(hour).between(first, last), F.lit(label)) for label, (first, last) in NIGHT_BANDS.items()]
    return F.coalesce(*labels, F.lit(OTHER))


def in_night_window(hour: ColumnOrName) -> Column:
    """``time_band(hour) != 'other'`` written as a plain range predicate.

    Being a comparison on the raw column, it can be pushed into a Parquet scan
    when the hour is stored, and it drops rows before any join or shuffle (F2).
    """
    return reduce(lambda a, b: a | b, [_col(hour).between(*band) for band in NIGHT_BANDS.values()])


def date_parts(date: ColumnOrName) -> dict[str, Column]:
    """year, month, short weekday name, weekday number, weekend flag."""
    d = _col(date)
    dow = F.dayofweek(d)
    return {
        "year": F.year(d),
        "month": F.month(d),
        "day_of_week": F.date_format(d, "E"),
        "day_of_week_num": dow,
        "is_weekend": dow.isin(*WEEKEND_DAYS),
    }


def lenient_date(text: ColumnOrName, fmt: str = "yyyyMMdd") -> Column:
    """Strip every non-digit, parse ``yyyyMMdd``; NULL when not a real date."""
    digits = F.regexp_replace(_col(text).cast("string"), "[^0-9]", "")
    return digits_date(digits) if fmt == "yyyyMMdd" else F.try_to_date(digits, fmt)


def digits_date(digits: Column) -> Column:
    """The date of eight digits, yyyymmdd; NULL when there is no such day.

    The day is checked by arithmetic before the date is made: a parser would raise and catch an exception for every
    text that is no date. ``transform`` binds the number, so that it is read once however often the check names it."""
    number = F.when(F.length(digits) == 8, digits).cast("int")

    def made(n: Column) -> Column:
        year, month, day = F.floor(n / 10000).cast("int"), F.floor(n / 100).cast("int") % 100, n % 100
        leap = (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))
        last = F.when(month == 2, F.when(leap, 29).otherwise(28)).when(month.isin(4, 6, 9, 11), 30).otherwise(31)
        real = month.between(1, 12) & (day >= 1) & (day <= last)
        return F.when(real, F.make_date(year, month, day))

    return F.transform(F.array(number), made)[0]


def strict_date(text: ColumnOrName, fmt: str = "yyyyMMdd") -> Column:
    """Parse a date in one exact format; NULL (not an error) when it does not parse."""
    return F.try_to_date(_col(text).cast("string"), fmt)


def try_integer(text: ColumnOrName, dtype: str = "int") -> Column:
    """Text to an integer type the way a non-ANSI cast does it: surrounding blanks
    ignored, a fractional part truncated toward zero (``"18.0"`` -> 18), anything
    else (or an out-of-range value) NULL. A plain ``try_cast`` under ANSI rules
    would reject ``"18.0"``."""
    return F.trim(_col(text).cast("string")).try_cast("decimal(38,9)").try_cast(dtype)


def parse_count(text: ColumnOrName) -> Column:
    """Thousands-separated integer text such as ``"1,000"`` to bigint, else NULL."""
    return try_integer(F.regexp_replace(_col(text).cast("string"), ",", ""), "long")


def try_number(text: ColumnOrName, dtype: str = "double") -> Column:
    """Cast that yields NULL on bad input."""
    return _col(text).try_cast(dtype)


def safe_row_sum(cols: Iterable[ColumnOrName]) -> Column:
    """Sum across columns counting NULL as 0."""
    parts = [F.coalesce(_col(c), F.lit(0.0)) for c in cols]
    return reduce(lambda a, b: a + b, parts)


def guarded_ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """num / den when den > 0, else NULL."""
    d = _col(den)
    return F.when(d > 0, _col(num) / d)


def lift(base: ColumnOrName, new: ColumnOrName) -> Column:
    """Relative change (new - base) / base, NULL unless base > 0."""
    b = _col(base)
    return F.when(b > 0, (_col(new) - b) / b)


def did_lift(
    treat_base: ColumnOrName, treat_new: ColumnOrName, ctrl_base: ColumnOrName, ctrl_new: ColumnOrName
) -> Column:
    """Difference in differences of two lifts; NULL unless both bases > 0."""
    tb, cb = _col(treat_base), _col(ctrl_base)
    return F.when((tb > 0) & (cb > 0), lift(tb, treat_new) - lift(cb, ctrl_new))


def to_units(value: ColumnOrName, scale: int) -> Column:
    """A decimal quantity with ``scale`` fraction digits as an exact bigint count.

    Summing integers is exact and order independent, so a distributed SUM gives
    bit-identical results however the rows are partitioned. ``rint`` (IEEE
    nearest) is used instead of ``round``: a value recorded with ``scale``
    decimals lands within 1e-9 of an integer once scaled, where both agree, and
    ``rint`` avoids a BigDecimal per row.
    """
    return F.rint(_col(value) * (10**scale)).cast("long")


def from_units(units: ColumnOrName, scale: int) -> Column:
    """Inverse of :func:`to_units` after aggregation."""
    return _col(units).cast("double") / float(10**scale)


# a header cell: quotes and byte order marks anywhere, blanks around, question marks in front
_HEADER_MARKS = dict.fromkeys(map(ord, "\ufeff\""))
_HEADER_CELL = re.compile(r"\s*\?*(.*?)\s*", re.DOTALL)


def clean_header_name(name: str) -> str:
    """Header cleaning (S7): the name without the marks that exports leave around it."""
    return _HEADER_CELL.fullmatch(name.translate(_HEADER_MARKS))[1]
