"""Reference lookups: membership flags, guarded many-to-one joins, calendar roles, key remaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ledgerspan.functions.dates import key_name
from ledgerspan.operators.skew import join_unique

class AmbiguousKeyError(ValueError):
    """A many-to-one lookup found a repeated key on its one side."""


def flag_member(df: DataFrame, key: str, valid: DataFrame, valid_key: str, flag: str) -> DataFrame:
    """Add `flag`: is `key` among `valid[valid_key]`? Rows are kept either way.

    `valid` grows with the data, so no broadcast is forced: AQE broadcasts it when its measured size
    is small and otherwise runs a sort-merge join, splitting skewed partitions of `df`.
    """
    keys = valid.select(F.col(valid_key).alias("__valid")).where(F.col("__valid").isNotNull()).distinct()
    joined = join_unique(df, keys.withColumn(flag, F.lit(True)), [key], ["__valid"])
    return joined.withColumn(flag, F.coalesce(flag, F.lit(False)))


def flag_member_unique(df: DataFrame, key: str, valid: DataFrame, valid_key: str, flag: str) -> DataFrame:
    """`flag_member` for a `valid` side whose key is already unique: no distinct, one shuffle less."""
    keys = valid.select(F.col(valid_key).alias("__valid"))
    joined = df.join(keys, F.col(key) == F.col("__valid"), "left")
    return joined.withColumn(flag, F.col("__valid").isNotNull()).drop("__valid")


def assert_unique(df: DataFrame, key: str, description: str) -> None:
    """Fail when `key` repeats. Runs one aggregate and brings at most three keys to the driver."""
    repeated = df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").select(key).take(3)
    if repeated:
        raise AmbiguousKeyError(f"{description}: repeated {key}: {', '.join(str(r[0]) for r in repeated)}")


def lookup(
    df: DataFrame,
    dimension: DataFrame,
    left_key: str,
    right_key: str,
    columns: dict[str, str],
    *,
    check: bool = False,
) -> DataFrame:
    """Many-to-one left join that brings `columns` (source name -> output name) from `dimension`.

    With `check` the dimension key is verified first (an action). The publishing jobs check each
    dimension once after writing it; lookups on those tables then skip the second pass.
    """
    if check:
        assert_unique(dimension, right_key, "many-to-one lookup")
    side = dimension.select(
        F.col(right_key).alias("__right"), *[F.col(c).alias(out) for c, out in columns.items()]
    )
    return df.join(side, F.col(left_key) == F.col("__right"), "left").drop("__right")


def calendar_roles(df: DataFrame, calendar: DataFrame, date_columns: Sequence[str]) -> DataFrame:
    """Add `<role>_calendar_key` for each date column, NULL when the day is not in the calendar.

    The calendar carries no hint: a stored one has a known size and is broadcast while that is small (all
    roles reuse one exchange); one blown up by a wrong date is joined by shuffle.
    """
    for name in date_columns:
        days = calendar.select(F.col("calendar_date").alias("__day"), F.col("calendar_key").alias(key_name(name)))
        df = df.join(days, F.col(name) == F.col("__day"), "left").drop("__day")
    return df


def calendar_dates(df: DataFrame, calendar: DataFrame, roles: dict[str, str], how: str = "left") -> DataFrame:
    """Inverse of `calendar_roles`: key column -> named date column."""
    for key, name in roles.items():
        days = calendar.select(F.col("calendar_key").alias("__key"), F.col("calendar_date").alias(name))
        df = df.join(days, F.col(key) == F.col("__key"), how).drop("__key")
    return df


def remap(df: DataFrame, column: str, mapping: DataFrame, old: str, new: str) -> DataFrame:
    """Replace `column` through a mapping table; unmapped values become NULL."""
    pairs = mapping.select(F.col(old).alias("__old"), F.col(new).alias("__new"))
    joined = df.join(pairs, F.col(column) == F.col("__old"), "left")
    return joined.withColumn(column, F.col("__new")).drop("__old", "__new")


def orphans(df: DataFrame, key: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose key has no parent; the subset test is `orphans(...).isEmpty()`."""
    return df.join(parents.select(F.col(parent_key).alias("__p")), F.col(key) == F.col("__p"), "left_anti")
