"""Lenient dates, calendar attributes and expiry bands."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ledgerspan.functions.text import col, strip

ISO_DATE_SHAPE = r"\A\d{4}-\d{2}-\d{2}([ T]([01]\d|2[0-3]):[0-5]\d(:[0-5]\d(\.\d+)?)?)?\z"
# Month and weekday names of the calendar.
MONTH_NAMES = (
    "janeiro", "fevereiro", "marco", "abril", "maio", "junho",
    "julho", "agosto", "setembro", "outubro", "novembro", "dezembro",
)
WEEKDAY_NAMES = (
    "segunda-feira", "terca-feira", "quarta-feira", "quinta-feira", "sexta-feira", "sabado", "domingo",
)
# Widths in days and names of the expiry bands.
EXPIRY_BANDS = ((30, "expires_in_30_days"), (60, "expires_in_60_days"), (90, "expires_in_90_days"))


def lenient_date(c: Column | str) -> Column:
    """ISO date, with or without a time of day, as DATE; anything else is NULL.

    Plain `yyyy-mm-dd` text takes a path without a regular expression.
    """
    c = col(c).cast("string")
    plain = (F.length(c) == 10) & (F.substring(c, 5, 1) == "-") & (F.substring(c, 8, 1) == "-")
    text = strip(c)
    timed = F.when(text.rlike(ISO_DATE_SHAPE), F.substring(text, 1, 10))
    return F.when(plain, c).otherwise(timed).try_cast("date")


def days_between(start: Column | str, end: Column | str) -> Column:
    return F.datediff(col(end), col(start)).cast("bigint")


def year_start(c: Column | str) -> Column:
    return F.trunc(col(c), "year")


def calendar_key(c: Column | str) -> Column:
    c = col(c)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("bigint")


def key_name(date_column: str) -> str:
    return f"{date_column.removesuffix('_date')}_calendar_key"


def _named(position: Column, names: tuple[str, ...]) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), position)


def calendar_attributes(day: Column | str) -> dict[str, Column]:
    """Every attribute of a calendar day, in published order."""
    day = col(day)
    year, month, quarter = F.year(day), F.month(day), F.quarter(day)
    weekday = F.weekday(day) + 1
    first_of_year = F.trunc(day, "year")
    return {
        "calendar_key": calendar_key(day),
        "calendar_date": day,
        "calendar_year": year.cast("bigint"),
        "calendar_semester": F.when(month <= 6, 1).otherwise(2).cast("bigint"),
        "calendar_quarter": quarter.cast("bigint"),
        "year_quarter": F.concat(year.cast("string"), F.lit("-T"), quarter.cast("string")),
        "calendar_month": month.cast("bigint"),
        "month_name": _named(month, MONTH_NAMES),
        "year_month": F.date_format(day, "yyyy-MM"),
        "calendar_week": F.weekofyear(day).cast("bigint"),
        "day_of_month": F.dayofmonth(day).cast("bigint"),
        "day_of_week": weekday.cast("bigint"),
        "day_name": _named(weekday, WEEKDAY_NAMES),
        "is_weekend": weekday >= 6,
        "is_month_start": F.dayofmonth(day) == 1,
        "is_month_end": day == F.last_day(day),
        "is_year_start": day == first_of_year,
        "is_year_end": day == F.date_sub(F.add_months(first_of_year, 12), 1),
    }


def expiry_band(end: Column | str, as_of: Column) -> Column:
    """Expired, within 30 / 60 / 90 days, or outside the renewal window."""
    end = col(end)
    band = F.when(end < as_of, "expired")
    for days, name in EXPIRY_BANDS:
        band = band.when(end <= F.date_add(as_of, days), name)
    return band.otherwise("outside_renewal_window")
