"""Interval operators without pairwise comparison inside a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerspan.operators.skew import join_unique


def flag_contained(
    df: DataFrame, key: str, start: str, end: str, *, inner: Column, outer: Column, flag: str, among: DataFrame | None = None
) -> DataFrame:
    """Add `flag`: does an `outer` interval of the same key contain this `inner` one?

    [s, e] lies inside some [s', e'] exactly when the largest e' among the outer intervals with
    s' <= s is >= e. So per (key, start day) only the largest outer end matters: the aggregate
    before the window leaves at most one row per day of each key (a date has at most 3.7 million
    values), however many intervals a hot key has, and the running maximum is a single sort.
    Rows that are neither `inner` nor `outer` get false. They are not filtered out first: that filter would be moved
    below the projection that makes the columns, and work out their long expressions once more. The `outer` ones are
    those of `among` where `df` is only a part of the rows.
    """
    inner, outer = F.coalesce(inner, F.lit(False)), F.coalesce(outer, F.lit(False))
    reach = (
        (df if among is None else among)
        .groupBy(F.col(key).alias("__key"), F.col(start).alias("__start"))
        .agg(F.max(F.when(outer, F.col(end))).alias("__end"))
    )
    so_far = Window.partitionBy("__key").orderBy("__start").rowsBetween(Window.unboundedPreceding, 0)
    reach = reach.select("__key", "__start", F.max("__end").over(so_far).alias("__reach"))
    reach = reach.where(F.col("__reach").isNotNull())
    joined = join_unique(df, reach, [key, F.when(inner, F.col(start))], ["__key", "__start"])
    return joined.withColumn(flag, F.coalesce(F.col("__reach") >= F.col(end), F.lit(False))).drop("__reach")


def overlapped_periods(df: DataFrame, start: str, end: str, periods: DataFrame) -> DataFrame:
    """One row per (row, fiscal period it overlaps); `periods` has period_year and period_end.

    A row is expanded into the years it spans (clipped to the years that exist) and meets the
    periods by year, so the join is an equi join and the expansion is bounded by the number of
    periods. `periods` is one row per distinct year end: bounded by the calendar.
    """
    span = periods.agg(
        F.min(F.year("period_end")).alias("lo"), F.max(F.year("period_end")).alias("hi")
    ).select(F.struct("lo", "hi").alias("span"))
    limits = span.scalar()
    first = F.greatest(F.year(start), limits["lo"])
    last = F.least(F.year(end), limits["hi"])
    years = F.when(first <= last, F.sequence(first, last))
    keyed = periods.withColumn("__year", F.year("period_end"))
    expanded = df.withColumn("__active", F.explode(years))
    joined = expanded.join(F.broadcast(keyed), F.col("__active") == F.col("__year"))
    return joined.where(
        (F.col(start) <= F.col("period_end")) & (F.col(end) >= F.trunc("period_end", "year"))
    ).drop("__active", "__year")


def as_of_in_year(
    events: DataFrame,
    facts: DataFrame,
    *,
    key: str,
    event_date: str,
    fact_key: str,
    fact_date: str,
    tie: str,
    columns: dict[str, str],
) -> DataFrame:
    """Latest fact in the year of the event, else the latest of an earlier year, else NULLs.

    Only the last fact of each (key, year) can ever be chosen: one aggregate (partial on the map
    side) leaves it. The years an event needs but has no fact for are carried forward over a
    spine of (key, year), at most one row per calendar year and key. Events then meet their fact
    by equality on (key, year); no event is ever paired with more than one fact.
    """
    best = F.max_by(F.struct(*[F.col(c).alias(o) for c, o in columns.items()]), F.struct(fact_date, tie))
    yearly = (
        facts.where(F.col(fact_date).isNotNull())
        .groupBy(F.col(fact_key).alias("__key"), F.year(fact_date).alias("__year"))
        .agg(best.alias("__fact"))
    )
    wanted = (
        events.where(F.col(event_date).isNotNull())
        .select(F.col(key).alias("__key"), F.year(event_date).alias("__year"))
        .distinct()
        .withColumn("__fact", F.lit(None).cast(yearly.schema["__fact"].dataType))
    )
    spine = yearly.unionByName(wanted).groupBy("__key", "__year").agg(
        F.max_by("__fact", F.when(F.col("__fact").isNotNull(), 1)).alias("__fact")
    )
    carried = Window.partitionBy("__key").orderBy("__year").rowsBetween(Window.unboundedPreceding, 0)
    spine = spine.select("__key", "__year", F.last("__fact", ignorenulls=True).over(carried).alias("__fact"))
    keyed = events.withColumn("__event_year", F.year(event_date))
    joined = keyed.join(
        spine, (F.col(key) == F.col("__key")) & (F.col("__event_year") == F.col("__year")), "left"
    )
    return joined.select("*", *[F.col(f"__fact.{o}").alias(o) for o in columns.values()]).drop(
        "__event_year", "__key", "__year", "__fact"
    )
