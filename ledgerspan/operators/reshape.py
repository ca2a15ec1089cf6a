"""Unions, unpivots, spines and schedules."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def stack_columns(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """All values of several columns of one table as one column, in a single scan; NULLs dropped."""
    values = df.select(F.explode(F.array(*[F.col(c) for c in columns])).alias(name))
    return values.where(F.col(name).isNotNull())


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def append(current: DataFrame, new: DataFrame) -> DataFrame:
    """Event-log append; a column missing on one side is NULL there."""
    return current.unionByName(new, allowMissingColumns=True)


def date_bounds(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Smallest and largest date over several columns: one pass, one row."""
    lows = [F.min(c) for c in columns]
    highs = [F.max(c) for c in columns]
    pick = lambda f, cs: f(*cs) if len(cs) > 1 else cs[0]
    return df.agg(pick(F.least, lows).alias("lo"), pick(F.greatest, highs).alias("hi"))


def date_spine(bounds: DataFrame, name: str = "calendar_date") -> DataFrame:
    """One row per day from `lo` to `hi` (at most one row per calendar day that can exist)."""
    return bounds.where("lo IS NOT NULL").select(F.explode(F.sequence("lo", "hi")).alias(name))


def unpivot_years(
    df: DataFrame,
    keep: Sequence[str],
    measures: dict[str, str],
    years: Sequence[int],
    *,
    previous: dict[str, str] | None = None,
) -> DataFrame:
    """`<source>_<year>` columns to one row per year, several measures at once, in a single scan.

    `previous` (source -> output) also brings last year's value. It sits on the same wide row, so a
    year-on-year comparison needs no window and no shuffle.
    """
    def per_year(year: int) -> Column:
        fields = [F.lit(year).cast("bigint").alias("financial_year")]
        fields += [F.col(f"{src}_{year}").cast("double").alias(out) for src, out in measures.items()]
        for src, out in (previous or {}).items():
            before = F.col(f"{src}_{year - 1}") if year > years[0] else F.lit(None)
            fields.append(before.cast("double").alias(out))
        return F.struct(*fields)

    rows = df.select(*keep, F.explode(F.array(*[per_year(y) for y in years])).alias("__y"))
    return rows.select(*keep, "__y.*")


def monthly_schedule(df: DataFrame, start: str, end: str, name: str) -> DataFrame:
    """One row per monthly date from `start` to `end`; the start alone when the window is empty.

    Every date is one month after the one before it, so a day that a short month lacks stays lost
    (31 Jan, 28 Feb, 28 Mar).
    """
    first, last = F.col(start), F.greatest(F.col(start), F.col(end))
    months = F.greatest(F.ceil(F.months_between(last, first)).cast("int"), F.lit(0))
    steps = F.sequence(F.lit(0), months)
    # step 0 is the start itself
    dates = F.aggregate(
        steps, F.array().cast("array<date>"), lambda got, i: F.concat(got, F.array(F.when(i == 0, first).otherwise(F.add_months(F.try_element_at(got, F.lit(-1)), 1))))
    )
    return df.withColumn(name, F.explode(F.filter(dates, lambda d: d <= last)))


def key_set_comparison(expected: DataFrame, actual: DataFrame, key: str = "key") -> DataFrame:
    """Sizes of two key sets and of their intersection: one shuffle over a tagged union, one row."""
    def tagged(df: DataFrame, exp: int, act: int) -> DataFrame:
        present = df.select(F.col(key).cast("string").alias("key")).where(F.col("key").isNotNull())
        return present.select("key", F.lit(exp).alias("e"), F.lit(act).alias("a"))

    merged = tagged(expected, 1, 0).unionByName(tagged(actual, 0, 1))
    seen = merged.groupBy("key").agg(F.max("e").alias("e"), F.max("a").alias("a"))
    return seen.agg(
        F.coalesce(F.sum("e"), F.lit(0)).cast("bigint").alias("expected_count"),
        F.coalesce(F.sum("a"), F.lit(0)).cast("bigint").alias("actual_count"),
        F.coalesce(F.sum(F.col("e") * F.col("a")), F.lit(0)).cast("bigint").alias("common_count"),
    )
