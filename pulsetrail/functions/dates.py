"""Day strings in the two partition formats, on columns and on plain strings."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two formats of partition days.
COMPACT = "yyyyMMdd"
DASHED = "yyyy-MM-dd"
_PYTHON_FORMATS = {COMPACT: "%Y%m%d", DASHED: "%Y-%m-%d"}


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def shift_date(value: Column | str, days: int, out: str = DASHED) -> Column:
    """A ``yyyyMMdd`` string moved by ``days``; null when it is no date."""
    day = F.try_to_timestamp(_column(value), F.lit(COMPACT)).cast("date")
    return F.date_format(F.date_add(day, days), out)


def reformat_date(value: Column | str) -> Column:
    """``yyyyMMdd`` to ``yyyy-MM-dd``; null when it is no date."""
    return shift_date(value, 0)


def elapsed_days(value: Column | str, as_of: Column | str) -> Column:
    """Whole 24-hour blocks from a timestamp to ``as_of``."""
    late, early = (_column(c).cast("timestamp").cast("double") for c in (as_of, value))
    return F.floor((late - early) / 86400).cast("long")


def days_between(later: Column | str, earlier: Column | str) -> Column:
    """Calendar days from ``earlier`` to ``later``; the time of day does not count."""
    return F.datediff(_column(later), _column(earlier))


def dormant(last_active: Column | str, day: Column | str, days: int) -> Column:
    """Whether the last activity lies at least ``days`` days before ``day``."""
    return _column(last_active).try_cast("date") <= F.date_add(_column(day), -days)


def day_string(as_of: Column | str, days: int, pattern: str = COMPACT) -> Column:
    """The day of ``as_of`` moved by ``days``, in ``pattern``."""
    return F.date_format(F.date_add(_column(as_of).cast("date"), days), pattern)


def day(text: str, days: int = 0, out: str = DASHED) -> str:
    """A plain day string (either format) moved by ``days``; used to name partitions."""
    pattern = COMPACT if "-" not in text else DASHED
    moved = datetime.strptime(text, _PYTHON_FORMATS[pattern]) + timedelta(days=days)
    return moved.strftime(_PYTHON_FORMATS[out])
