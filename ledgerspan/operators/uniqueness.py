"""Flags and filters for repeated keys, and the latest row per key.

A window `count(*) over (partition by key)` would buffer a whole group in one task. Here the key
counts come from a hash aggregate (map-side partial, so a hot key shrinks to one row per task)
and the flag is attached in a way that spreads hot keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerspan.operators.skew import MAX_HOT, attach


def key_counts(df: DataFrame, keys: Sequence[str], exempt: Column | None = None) -> DataFrame:
    """Rows per key, `exempt` ones not counted. They are left out by the count: a filter would be moved below the
    projection that makes the keys, and work out the keys' long expressions once more."""
    rows = F.count("*") if exempt is None else F.count_if(~F.coalesce(exempt, F.lit(False)))
    return df.groupBy(*keys).agg(rows.alias("__rows"))


def flag_repeated(
    df: DataFrame,
    keys: Sequence[str],
    flag: str,
    *,
    exempt: Column | None = None,
    salt_on: Sequence[str] = ("source_file", "source_row_number"),
    most_hot: int = MAX_HOT,
    among: DataFrame | None = None,
) -> DataFrame:
    """Add `flag`: true on EVERY copy of a key that occurs more than once (NULL equals NULL).

    `exempt` rows are never flagged and never counted. Call this on rows read from a table, before
    any join: the key counts are a second, narrow pass over `df`, or over `among` where `df` is only a part of the rows.
    """
    salt_on = [c for c in salt_on if c in df.columns] or df.columns
    counted = key_counts(df if among is None else among, keys, exempt)
    repeated = counted.where("__rows > 1").withColumn(flag, F.lit(True))
    flagged = attach(df, repeated, keys, [flag], salt_on=salt_on, exempt=exempt, most_hot=most_hot)
    return flagged.withColumn(flag, F.coalesce(flag, F.lit(False)))


def drop_ambiguous(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """One row per key that occurs exactly once; every copy of a repeated key goes.

    A single aggregate: `any_value` is the row itself because the group has one row.
    """
    packed = df.groupBy(key).agg(F.count("*").alias("__rows"), F.any_value(F.struct(*columns)).alias("__row"))
    return packed.where("__rows = 1").select(key, "__row.*")


def latest_per_key(df: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    """Row with the highest `order` columns per key.

    `row_number = 1` lets Catalyst add a partial WindowGroupLimit before the shuffle, so a task
    sends at most one row per key whatever the size of the group.
    """
    ranking = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return df.withColumn("__rank", F.row_number().over(ranking)).where("__rank = 1").drop("__rank")


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).where(F.col(column).isNotNull() & (F.col(column) != "")).distinct().orderBy(column)
