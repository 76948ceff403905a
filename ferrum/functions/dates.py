"""Date and time column functions (built-in expressions only, no UDFs).

ANSI mode is on in Spark 4, so every parse uses a ``try_*`` form: bad input
becomes NULL instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed formats (must stay as written).
ISO_OFFSET_FORMAT = "yyyy-MM-dd'T'HH:mm:ssXXX"
DAY_OF_YEAR_FORMAT = "yyyyDDD"
COMPACT_DAY_FORMAT = "yyyyMMdd"
DOTTED_DAY_FORMAT = "dd.MM.yyyy"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_iso_offset(col) -> Column:
    """ISO-8601 text with a zone offset (``2024-01-02T03:04:05+01:00`` or ``...Z``) -> timestamp."""
    return F.try_to_timestamp(_c(col), F.lit(ISO_OFFSET_FORMAT))


def parse_timestamp(col, fmt: str | None = None) -> Column:
    """Text -> timestamp; unparseable text -> NULL."""
    if fmt is None:
        return F.try_to_timestamp(_c(col))
    return F.try_to_timestamp(_c(col), F.lit(fmt))


def parse_day(col) -> Column:
    """The day of an ISO date-time with a zone offset, or of a plain ``yyyy-MM-dd``; else NULL."""
    return F.to_date(F.coalesce(parse_iso_offset(col), parse_timestamp(col, "yyyy-MM-dd")))


def parse_day_of_year(col) -> Column:
    """``2023152`` (year + day of year) -> timestamp at midnight."""
    return F.try_to_timestamp(_c(col), F.lit(DAY_OF_YEAR_FORMAT))


def epoch_seconds(col) -> Column:
    return F.unix_timestamp(_c(col))


def as_of_literal(as_of: str) -> Column:
    """An explicit point in time, interpreted in the (UTC) session zone."""
    return F.to_timestamp(F.lit(as_of))


def day_age(ts, as_of) -> Column:
    """Whole calendar days from ``ts`` to ``as_of`` (23:59 -> 00:01 next day is 1).

    This is the two-argument ``datediff(end, start)``, which counts date
    boundaries; ``datediff(DAY, ...)`` would count elapsed 24 h periods instead.
    """
    return F.datediff(_c(as_of), _c(ts))


def same_day(ts, as_of) -> Column:
    return F.to_date(_c(ts)) == F.to_date(_c(as_of))


def reformat_compact_day(col) -> Column:
    """``20240131`` -> ``31.01.2024``; bad text -> NULL."""
    return F.date_format(F.try_to_timestamp(_c(col), F.lit(COMPACT_DAY_FORMAT)), DOTTED_DAY_FORMAT)


def days_before(as_of, n: int, fmt: str = "yyyy-MM-dd") -> Column:
    return F.date_format(F.date_sub(F.to_date(_c(as_of)), n), fmt)


def inclusive_days(start, end, reversed_mode: str = "swap") -> Column:
    """Array of every date between two dates, both ends included.

    ``reversed_mode="swap"`` orders the two ends first (a reversed range gives
    the same days); ``"empty"`` gives an empty array for a reversed range.
    NULL ends give NULL.
    """
    s, e = F.to_date(_c(start)), F.to_date(_c(end))
    if reversed_mode == "swap":
        return F.sequence(F.least(s, e), F.greatest(s, e), F.expr("INTERVAL 1 DAY"))
    if reversed_mode == "empty":
        return F.when(s <= e, F.sequence(s, e, F.expr("INTERVAL 1 DAY"))).when(
            s > e, F.array().cast("array<date>"))
    raise ValueError(f"unknown reversed_mode {reversed_mode!r}")


def trailing_days(as_of, days) -> Column:
    """The ``max(days, 2) - 1`` days that end the day before ``as_of``, ascending.

    ``days`` is an int or an integer column (one interval per row).
    """
    if isinstance(days, int):
        n = F.lit(max(days, 2) - 1)
    else:
        n = F.greatest(_c(days).cast("int"), F.lit(2)) - 1
    d = F.to_date(_c(as_of))
    return F.sequence(F.date_sub(d, n), F.date_sub(d, 1), F.expr("INTERVAL 1 DAY"))


def to_decimal4(col, precision: int = 18) -> Column:
    """Number rounded to 4 places as ``decimal(precision, 4)``."""
    return F.round(_c(col).cast("double"), 4).cast(f"decimal({precision},4)")
