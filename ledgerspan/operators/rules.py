"""Declarative row rules: every violated rule of a row is kept, in rule order.

All row-local rules of a table are evaluated in ONE projection, so validating a table costs no
shuffle beyond the ones its uniqueness and reference flags need.
"""

from __future__ import annotations

from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from ledgerspan.functions.text import blank, matches, member

SEPARATOR = "; "


class Rule(NamedTuple):
    """`message` is recorded when `violated` is true; a NULL predicate does not fire."""

    violated: Column
    message: str
    flagged: bool = False  # looks at a flag that other rows decide, not at the row alone


def error_text(rules: list[Rule]) -> Column:
    return F.concat_ws(SEPARATOR, *[F.when(r.violated, F.lit(r.message)) for r in rules])


def annotate(df: DataFrame, rules: list[Rule], column: str = "validation_errors") -> DataFrame:
    """Add the messages of the violated rules; the column knows all the messages there may be."""
    return df.withColumn(column, error_text(rules)).withMetadata(column, {"rules": [r.message for r in rules]})


def none_violated(rules: list[Rule]) -> Column:
    return reduce(and_, [~F.coalesce(r.violated, F.lit(False)) for r in rules])


def valid_alone(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rows that break none of the rules on the row alone; what the `flagged` ones say comes later, on fewer rows.

    The optimizer would work out the columns' long expressions again inside a filter below the projection that makes
    them. An id that each row gets on the way holds the filter where it is.
    """
    alone = error_text([r for r in rules if not r.flagged]) == ""
    return df.withColumn("__alone", alone & (F.monotonically_increasing_id() >= 0)).where("__alone").drop("__alone")


def valid_by_flags(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Of the rows that `valid_alone` left, those that break none of the other rules."""
    return df.where(none_violated([r for r in rules if r.flagged]))


def with_alone(df: DataFrame, rules: list[Rule], column: str = "__alone") -> DataFrame:
    """Add a bit mask of the rules that a row breaks by itself, so that their columns need not go where the flags are met."""
    assert len(rules) < 64
    bits = [F.when(r.violated, F.lit(1 << i).cast("bigint")).otherwise(F.lit(0).cast("bigint")) for i, r in enumerate(rules) if not r.flagged]
    return df.withColumn(column, reduce(lambda a, b: a.bitwiseOR(b), bits))


def annotate_met(df: DataFrame, rules: list[Rule], column: str = "validation_errors", alone: str = "__alone") -> DataFrame:
    """`annotate` for rows that have the mask of `with_alone` and, since then, the flags of the other rules."""
    broken = lambda i: F.col(alone).bitwiseAND(F.lit(1 << i).cast("bigint")) != 0
    return annotate(df, [r if r.flagged else Rule(broken(i), r.message) for i, r in enumerate(rules)], column).drop(alone)


def accepted(df: DataFrame, column: str = "validation_errors") -> DataFrame:
    return df.where(F.col(column) == "").drop(column)


def rejected(df: DataFrame, column: str = "validation_errors") -> DataFrame:
    return df.where(F.col(column) != "")


def rule_counts(df: DataFrame, column: str = "validation_errors") -> DataFrame:
    """Violations per message; a row counts once under each rule it breaks."""
    messages = df.where(F.col(column) != "").select(F.explode(F.split(column, SEPARATOR)).alias("message"))
    return messages.groupBy("message").agg(F.count("*").alias("violations")).orderBy("message")


def required(name: str, message: str | None = None) -> Rule:
    return Rule(blank(name), message or f"{name} ausente")


def parsed(name: str, suffix: str = "ausente ou inválido") -> Rule:
    return Rule(F.col(name).isNull(), f"{name} {suffix}")


def formatted(name: str, pattern: str, message: str) -> Rule:
    return Rule(~matches(name, pattern), message)


def one_of(name: str, values, suffix: str = "inválido") -> Rule:
    return Rule(~member(name, values), f"{name} {suffix}")


def not_negative(name: str, suffix: str = "não pode ser negativo") -> Rule:
    return Rule(F.col(name) < 0, f"{name} {suffix}")


def positive(name: str, suffix: str = "deve ser positivo") -> Rule:
    return Rule(F.col(name) <= 0, f"{name} {suffix}")
