"""Text used in printed reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the block character of report bars.
BAR = "█"


def two_digits(number: Column | str) -> Column:
    number = F.col(number) if isinstance(number, str) else number
    return F.lpad(number.cast("string"), 2, "0")


def month_name(year: str, month: str) -> Column:
    """``Jan 2023``."""
    return F.date_format(F.make_date(F.col(year), F.col(month), F.lit(1)), "MMM yyyy")


def year_month(year: str, month: str) -> Column:
    """``2023-01``."""
    return F.concat(F.col(year).cast("string"), F.lit("-"), two_digits(month))


def hour_start(hour: str) -> Column:
    """``09:00``."""
    return F.concat(two_digits(hour), F.lit(":00"))


def hour_span(hour: str) -> Column:
    """``09:00-09:59``."""
    return F.concat(hour_start(hour), F.lit("-"), two_digits(hour), F.lit(":59"))


def currency(amount: str, decimals: int) -> Column:
    """``$1,234.50``."""
    return F.concat(F.lit("$"), F.format_number(F.col(amount), decimals))


def bar(length: Column | str) -> Column:
    length = F.col(length) if isinstance(length, str) else length
    return F.repeat(F.lit(BAR), length.cast("int"))


def short_name(name: str, width: int = 40) -> Column:
    return F.substring(F.col(name), 1, width)
