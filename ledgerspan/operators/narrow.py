"""Flags worked out on a few columns, and brought to the wide rows once.

A flag that needs a shuffle of its own (repeats, references, containment) would shuffle whole rows, once per flag.
Here the rows' identity and the columns that the flags need go through those shuffles; what comes back is a bit
mask of the rows that have a flag at all, so the wide rows move once, and not at all while that list is small enough to be broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

IDENTITY = ("batch_id", "source_file", "source_row_number")


def with_flags(
    rows: DataFrame,
    columns: Sequence[str],
    flagging: Callable[[DataFrame], DataFrame],
    flags: dict[str, bool],
    identity: Sequence[str] = IDENTITY,
) -> DataFrame:
    """`flagging(rows)`, which adds the boolean `flags` by `columns` alone, without a shuffle of all columns per flag.

    `flags` says which value of each flag is the usual one; only rows with another come back. `identity` tells rows
    apart; rows that lack it are flagged as they are.
    """
    if any(c not in rows.columns for c in identity):
        return flagging(rows)
    narrow = flagging(rows.select(*identity, *[c for c in columns if c not in identity]))
    bits = [F.when(F.col(f) != F.lit(usual), F.lit(1 << i)).otherwise(0) for i, (f, usual) in enumerate(flags.items())]
    mask = reduce(lambda a, b: a.bitwiseOR(b), bits)
    names = [f"__i{k}" for k in range(len(identity))]
    marked = narrow.select(*[F.col(c).alias(n) for c, n in zip(identity, names)], mask.alias("__mask")).where("__mask <> 0")
    marked = marked.groupBy(*names).agg(F.bit_or("__mask").alias("__mask"))
    same = reduce(lambda a, b: a & b, [F.col(c) == F.col(n) for c, n in zip(identity, names)])
    met = rows.join(marked, same, "left").drop(*names)
    found = F.coalesce(F.col("__mask"), F.lit(0))
    values = {f: (found.bitwiseAND(F.lit(1 << i)) != 0) != F.lit(usual) for i, (f, usual) in enumerate(flags.items())}
    return met.withColumns(values).drop("__mask")
