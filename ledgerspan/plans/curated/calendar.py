"""`dim_calendar`: every day between the first and the last date of the staged tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerspan.functions.dates import calendar_attributes
from ledgerspan.operators.reshape import date_bounds, date_spine, union_all

BUSINESS_DATES = {
    "contracts": ("validity_start_date", "validity_end_date", "risk_evaluation_date"),
    "amendments": ("validity_start_date", "validity_end_date"),
    "payments": ("payment_date",),
    "risk": ("assessment_date", "last_approval_date", "expiration_date"),
}


class EmptyCalendarError(ValueError):
    """No staged table has a date."""


def covered_dates(staged: dict[str, DataFrame], *, with_load_date: bool) -> DataFrame:
    """One row (lo, hi): each table is aggregated in one pass, then four rows are merged."""
    extra = ("load_date",) if with_load_date else ()
    bounds = [date_bounds(staged[name], (*columns, *extra)) for name, columns in BUSINESS_DATES.items()]
    return union_all(bounds).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def build_calendar(staged: dict[str, DataFrame], *, check: bool = False) -> DataFrame:
    """`check` fails on sources without any date (an action); else the calendar is just empty."""
    days = date_spine(covered_dates(staged, with_load_date=True))
    if check and days.isEmpty():
        raise EmptyCalendarError("Não há datas válidas nas fontes staging para construir dim_calendar.")
    return days.select(*[c.alias(n) for n, c in calendar_attributes("calendar_date").items()])
