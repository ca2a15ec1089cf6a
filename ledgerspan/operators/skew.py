"""Joins back to per-key aggregates when one key may own a large share of the rows.

An aggregate leaves its result hash-partitioned by the key, so a plain join back to it would send
every row of a hot key to one task, and AQE could not help: it splits a skewed side only when both
sides of the join are shuffles of their own. Two ways around that:

* `attach` knows the row count of each key (the aggregate is over the same rows). The MAX_HOT most
  frequent keys travel in a broadcast list and their rows are spread over SALTS reducers; every
  other key has at most 1 / MAX_HOT of the rows.
* `join_unique` joins on (key, 0). The extra column makes Spark shuffle the aggregate once more,
  which is small, and so AQE can split a skewed partition of the left side.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

MAX_HOT = 1_000  # size bound of the broadcast list
SALTS = 256


def _same(pairs: Sequence[tuple[str, str]]) -> Column:
    return reduce(and_, [F.col(mine).eqNullSafe(F.col(theirs)) for mine, theirs in pairs])


def _zero(c: Column) -> Column:
    """0 in a form the optimizer does not fold away, so that it stays a join key; never NULL, as a filter for that would be
    worked out on the rows below an aggregate."""
    return F.coalesce(F.pmod(F.hash(c), F.lit(1)), F.lit(0))


def hot_keys(per_key: DataFrame, rows: str = "__rows", most_hot: int = MAX_HOT) -> DataFrame:
    """Rows of the `most_hot` most frequent keys (a top-k, not a full sort), whatever the size of the table."""
    return per_key.orderBy(F.col(rows).desc()).limit(most_hot)


def attach(
    df: DataFrame,
    per_key: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    *,
    salt_on: Sequence[str],
    exempt: Column | None = None,
    most_hot: int = MAX_HOT,
) -> DataFrame:
    """Bring `values` of `per_key` (keys, values, `__rows`) to every row of `df`, NULL keys included.

    `salt_on` must tell rows apart; it decides only where a hot row is processed, never the result.
    `exempt` rows get NULLs.
    """
    names = [f"__k{i}" for i in range(len(keys))]
    renamed = [F.col(k).alias(n) for k, n in zip(keys, names)]
    hot = hot_keys(per_key, most_hot=most_hot).select(*renamed, F.struct(*values).alias("__hot"))
    cold = per_key.select(*renamed, _zero(F.col("__rows")).alias("__bucket"), F.struct(*values).alias("__cold"))
    same = _same(list(zip(keys, names)))
    apart = F.col("__hot").isNotNull()
    if exempt is not None:
        apart = apart | F.coalesce(exempt, F.lit(False))
    spread = F.pmod(F.hash(*salt_on), F.lit(SALTS)) + 1
    marked = df.join(F.broadcast(hot), same, "left").drop(*names)
    marked = marked.withColumn("__salt", F.when(apart, spread).otherwise(0))
    joined = marked.join(cold, same & (F.col("__salt") == F.col("__bucket")), "left")
    found = F.coalesce("__hot", "__cold")
    if exempt is not None:
        found = F.when(~F.coalesce(exempt, F.lit(False)), found)
    joined = joined.withColumn("__found", found)
    return joined.select(*df.columns, *[F.col(f"__found.{v}").alias(v) for v in values])


def join_unique(
    df: DataFrame, per_key: DataFrame, keys: Sequence[str | Column], right_keys: Sequence[str]
) -> DataFrame:
    """Left join to a frame with one row per `right_keys` that comes out of an aggregate or a window.

    Rows with a NULL key match nothing, so they are spread instead of meeting in one task.
    """
    left_names = [f"__l{i}" for i in range(len(keys))]
    right_names = [f"__r{i}" for i in range(len(keys))]
    left = df.withColumns({n: F.col(k) if isinstance(k, str) else k for n, k in zip(left_names, keys)})
    unmatched = F.lit(False)
    for name in left_names:
        unmatched = unmatched | F.col(name).isNull()
    spread = F.pmod(F.hash(*df.columns), F.lit(SALTS)) + 1
    left = left.withColumn("__part", F.when(unmatched, spread).otherwise(_zero(F.col(left_names[0]))))
    right = per_key.withColumnsRenamed(dict(zip(right_keys, right_names)))
    right = right.withColumn("__zero", _zero(F.col(right_names[0])))
    same = reduce(and_, [F.col(a) == F.col(b) for a, b in zip(left_names, right_names)])
    joined = left.join(right, same & (F.col("__part") == F.col("__zero")), "left")
    return joined.drop(*left_names, *right_names, "__part", "__zero")
