"""Lenient numbers, money, ratios and ordinal risks."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ledgerspan.functions.text import col

MONEY = "decimal(18,2)"
EXACT_SUM = "decimal(38,2)"
# Order of the risk levels, after and before slugging.
RISK_ORDER = {"baixo": 1, "medio": 2, "alto": 3}
RISK_LABEL_ORDER = {"Baixo": 1, "Médio": 2, "Alto": 3}


def lenient_double(c: Column | str) -> Column:
    """Decimal or scientific notation as double, else NULL.

    A number ends in a digit or a point and has no `x`; that keeps out what the JVM parser takes
    as well (`1d`, `NaN`, `Infinity`, hexadecimal).
    """
    text = F.trim(col(c).cast("string"))
    last = F.ascii(F.substring(text, -1, 1))
    plausible = last.between(ord("0"), ord("9")) | (last == ord("."))
    return F.when(plausible & ~F.contains(F.lower(text), F.lit("x")), text).try_cast("double")


def lenient_bigint(c: Column | str) -> Column:
    """Whole number or NULL; `12.0` is whole, `12.5` is not."""
    exact = col(c).cast("string").try_cast("decimal(38,6)")
    return F.when(exact == F.floor(exact), exact).try_cast("bigint")


def money(c: Column | str) -> Column:
    """Text straight to decimal(18,2), half-up, so no binary fraction is ever in between."""
    return col(c).cast("string").try_cast(MONEY)


def exact_sum(c: Column | str) -> Column:
    """Exact decimal total, NULLs skipped, zero when there is nothing to add."""
    return F.coalesce(F.sum(col(c).cast(EXACT_SUM)).cast(EXACT_SUM), F.lit(0).cast(EXACT_SUM))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double, NULL when the denominator is zero."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def or_zero(c: Column | str) -> Column:
    return F.coalesce(col(c), F.lit(0))


def round4(c: Column) -> Column:
    """Round a double to four places the way IEEE `rint` does."""
    return F.rint(c * 10000) / 10000


def ordinal(c: Column | str, order: dict[str, int]) -> Column:
    c = col(c)
    expression = F.lit(None).cast("int")
    for value, rank in order.items():
        expression = F.when(c == value, F.lit(rank)).otherwise(expression)
    return expression


def highest_risk(left: Column | str, right: Column | str, order: dict[str, int] = RISK_ORDER) -> Column:
    """The worse of two ordinal risks; NULL when either is unknown."""
    first, second = ordinal(left, order), ordinal(right, order)
    return F.when(first.isNull() | second.isNull(), F.lit(None)).when(first >= second, col(left)).otherwise(col(right))


def amendment_id(contract_id: Column | str, sequence: Column | str) -> Column:
    """`AMD-<contract>-<sequence, four digits or more>`; blank when the parts do not identify an event."""
    contract_id, sequence = col(contract_id), col(sequence)
    usable = (contract_id != "") & sequence.isNotNull() & (sequence % 1 == 0)
    number = sequence.cast("bigint")
    digits = number.cast("string")
    filled = F.when(number.between(0, 9999), F.lpad(digits, 4, "0")).otherwise(F.format_string("%04d", number))
    return F.coalesce(F.when(usable, F.concat(F.lit("AMD-"), contract_id, F.lit("-"), filled)), F.lit(""))
