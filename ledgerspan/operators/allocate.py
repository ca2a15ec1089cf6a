"""Cent-exact proportional allocation without collecting a group.

Amounts are whole cents, so shares are computed in integer arithmetic and always add up. The
group total, the rounded shares and the last row of each group come from hash aggregates that are
attached to the rows; no window buffers a group, and hot keys are spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerspan.operators.skew import MAX_HOT, attach
from ledgerspan.operators.storage import keep

CENTS = "decimal(18,0)"


def to_cents(amount: Column) -> Column:
    return (amount.cast("decimal(20,2)") * 100).cast(CENTS)


def from_cents(cents: Column) -> Column:
    return (cents.cast("decimal(20,0)") / 100).cast("decimal(18,2)")


def allocate(
    rows: DataFrame,
    key: str,
    amount: str,
    weight: str,
    order: list[str],
    *,
    eligible: Column,
    out: str,
    most_hot: int = MAX_HOT,
) -> DataFrame:
    """Split `amount` (one value per key, repeated on its rows) over the eligible rows of the key.

    Shares are proportional to `weight`, rounded half-up to cents; the last eligible row in `order`
    takes the remainder. Ineligible rows get 0. `<out>_exceeds` is true on every row of a key whose
    amount is beyond its eligible weight by more than one cent (nothing is allocated there).
    """
    ok = F.coalesce(eligible, F.lit(False))
    base = rows.withColumns(
        {
            "__ok": ok,
            "__amount": to_cents(F.col(amount)),
            "__weight": F.when(ok, to_cents(F.col(weight))).otherwise(F.lit(0).cast(CENTS)),
        }
    )
    salt_on = [key, *order]
    totals = base.groupBy(key).agg(
        F.count("*").alias("__rows"),
        F.sum("__weight").cast(CENTS).alias("__total"),
        F.max(F.when(F.col("__ok"), F.struct(*order))).alias("__last"),
    )
    sized = attach(base, totals, [key], ["__total", "__last"], salt_on=salt_on, most_hot=most_hot)
    exceeds = F.col("__amount") > F.col("__total") + 1
    usable = F.col("__ok") & (F.col("__amount") > 0) & (F.col("__total") > 0) & ~exceeds
    # round(amount * weight / total) half-up, in integers
    share = F.expr(
        "(2 * cast(__amount as decimal(18,0)) * cast(__weight as decimal(18,0)) + __total) div (2 * __total)"
    )
    is_last = usable & (F.struct(*order) == F.col("__last"))
    shared = sized.withColumns(
        {
            "__is_last": F.coalesce(is_last, F.lit(False)),
            "__share": F.when(usable & ~is_last, share).otherwise(F.lit(0)).cast(CENTS),
            f"{out}_exceeds": F.coalesce(exceeds, F.lit(False)),
        }
    )
    # Read three times below; each reader would repeat the joins above.
    shared = keep(shared, "allocation-shares")
    given = shared.groupBy(F.col(key).alias("__key")).agg(F.sum("__share").cast(CENTS).alias("__given"))
    # Only the last row of a key needs the sum of the others: one row per key on both sides.
    last = shared.where("__is_last").join(given, F.col(key) == F.col("__key")).drop("__key")
    final = last.unionByName(shared.where("NOT __is_last").withColumn("__given", F.lit(None).cast(CENTS)))
    cents = F.when(F.col("__is_last"), F.col("__amount") - F.col("__given")).otherwise(F.col("__share"))
    return final.withColumn(out, from_cents(cents)).drop(
        "__ok", "__amount", "__weight", "__total", "__last", "__is_last", "__share", "__given"
    )
