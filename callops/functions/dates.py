"""Date and calendar rules. "Today" is always an argument, never the wall clock."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Upper bound in days → label of the tenure bands.
TENURE_BANDS = {
    30: "0-30 days",
    60: "30-60 days",
    90: "60-90 days",
    120: "90-120 days",
    180: "120-180 days",
}
TENURE_REST = "Above 180 days"


def as_date(value) -> Column:
    """A date argument (text, ``datetime.date`` or column) as a column."""
    return value if isinstance(value, Column) else F.lit(str(value)).cast("date")


def lenient_date(c: Column, pattern: str | None = None) -> Column:
    """Date, or NULL where the text is none."""
    return F.try_to_date(c, pattern) if pattern else c.try_cast("date")


def text_date(c: Column) -> Column:
    """``yyyy-MM-dd`` text → date, NULL where it is not."""
    return F.try_to_date(c, "yyyy-MM-dd")


def weekday_abbr(d: Column) -> Column:
    """``mon`` … ``sun``."""
    return F.lower(F.date_format(d, "EEE"))


def monday_week_number(d: Column) -> Column:
    """Week of the year, weeks start on Monday, days before the first Monday are week 0."""
    return F.floor((F.dayofyear(d) + 6 - F.weekday(d)) / 7).cast("int")


def day_first_text(d: Column) -> Column:
    """``dd-MM-yyyy``."""
    return F.date_format(d, "dd-MM-yyyy")


def days_before(d: Column, days: int) -> Column:
    return F.date_sub(d, days)


def month_start(d: Column) -> Column:
    return F.trunc(d, "MM")


def is_month_start(d: Column) -> Column:
    return F.dayofmonth(d) == 1


def in_month(d: Column, as_of) -> Column:
    """Same calendar month and year as ``as_of``."""
    return month_start(d) == month_start(as_date(as_of))


def after_cutoff(d: Column, as_of, month: int = 5, day: int = 5) -> Column:
    """Later than a fixed day of the year of ``as_of``; NULL dates fail."""
    return d > F.make_date(F.year(as_date(as_of)), F.lit(month), F.lit(day))


def tenure_band(joined: Column, as_of) -> Column:
    """Band of days since joining; unknown joining date counts as the longest."""
    days = F.datediff(as_date(as_of), joined)
    band = F
    for limit, label in TENURE_BANDS.items():
        band = band.when(days <= limit, F.lit(label))
    return band.otherwise(F.lit(TENURE_REST))
