"""Mixing sources to target weights: repetition rates per source, then whole copies of documents.

The tokens of each source are summed, targets give a rate (target / size) per source, and a document
is emitted floor(rate) times plus once more with a probability of the fraction, drawn from a hash of
the seed and its id. Only sums per source and single numbers leave the executors; a rerun, or a task
run again after a lost executor, draws the same.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerspan.llm.common import WORD, fresh, stored
from ledgerspan.operators.ordering import dense_positions

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2.0
SEED = 17


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_sizes(docs: DataFrame, size: Column, source: str = "source") -> DataFrame:
    """(source, source_size); a null source is a source of its own."""
    return docs.groupBy(F.col(source).alias("source")).agg(F.sum(size).cast("long").alias("source_size"))


def cyclic_weights(sizes: DataFrame, weights: Sequence[float] = WEIGHTS) -> DataFrame:
    """Add `weight`: the weights in turn, by code point of the source, null last."""
    placed = dense_positions(sizes, F.col("source").asc_nulls_last(), name="position")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    at = ((F.col("position") - 1) % len(weights)).cast("int")
    return placed.withColumn("weight", F.get(cycle, at)).drop("position")


def rates(sizes: DataFrame, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(source, source_size, target, rate) from (source, source_size, weight).

    The targets share `share` times all sizes by weight; one above `cap` times its source's size stops
    there and its excess is shared again, until none is above. A round is one aggregate over a row
    per source. A source of size 0 has target and rate 0, and so have all where no text has a word.
    """
    most = F.col("source_size") * F.lit(cap)
    budget = float(sizes.agg(F.sum("source_size")).first()[0] or 0) * share
    level, seen = 0.0, -1
    while True:
        below = F.lit(level) * F.col("weight") > most
        row = sizes.agg(
            F.sum(F.when(below, most)).alias("capped"),
            F.sum(F.when(~below, F.col("weight"))).alias("free"),
            F.count(F.when(below, 1)).alias("n"),
        ).first()
        if row["n"] == seen or not row["free"]:
            break
        seen = row["n"]
        level = (budget - (row["capped"] or 0.0)) / row["free"]
    target = F.least(most, F.lit(level) * F.col("weight"))
    rate = F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0)
    return sizes.select("source", "source_size", target.alias("target"), rate.alias("rate"))


def draw(doc_id: Column, seed: int = SEED) -> Column:
    """A number in [0, 1) from the first 52 bits of md5(seed:id); a null id counts as the empty text."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def copies(rate: Column, doc_id: Column, seed: int = SEED) -> Column:
    whole = F.floor(rate)
    return whole + F.when(draw(doc_id, seed) < rate - whole, 1).otherwise(0)


def with_rates(docs: DataFrame, rated: DataFrame, source: str = "source") -> tuple[DataFrame, str]:
    """Documents with a struct column (its name is returned) of their source's sizes, target and rate.

    `rated` is a stored table of one row per source, so Spark broadcasts it only while it is small and
    otherwise joins by shuffle, where it splits the partition of a hot source.
    """
    key, found = fresh(docs.columns, "__source"), fresh(docs.columns, "__rated")
    right = rated.select(F.col("source").alias(key), F.struct("source_size", "target", "rate").alias(found))
    return docs.join(right, docs[source].eqNullSafe(F.col(key)), "left").drop(key), found


def emit(docs: DataFrame, seed: int = SEED, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """The mix itself: every document as often as its source's rate says, with the columns of `docs`.

    Null text has size 0. Repeated rows of one id share their draw, and so do all rows without an id. An empty
    table gives none, and so does one without words.
    """
    sizes = stored(source_sizes(docs, word_count(F.col("text"))), "mix-sizes")
    rated = stored(rates(stored(cyclic_weights(sizes, weights), "mix-weights"), share, cap), "mix-rates")
    joined, found = with_rates(docs, rated)
    times = copies(F.col(f"{found}.rate"), F.col("doc_id"), seed).cast("int")
    again = fresh(joined.columns, "__copy")
    repeated = joined.withColumn(again, F.explode(F.array_repeat(F.lit(1), times)))
    return repeated.select(*[F.col(f"`{c}`") for c in docs.columns])


def mixture(docs: DataFrame, seed: int = SEED, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """doc_id, size, source_size, target, taken and copies of every row, without its text."""
    thin = stored(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "mix-docs")
    sizes = stored(source_sizes(thin, F.col("size")), "mix-sizes")
    rated = stored(rates(stored(cyclic_weights(sizes, weights), "mix-weights"), share, cap), "mix-rates")
    joined, found = with_rates(thin, rated)
    times = copies(F.col(f"{found}.rate"), F.col("doc_id"), seed).cast("long")
    return joined.select(
        "doc_id", "size", f"{found}.source_size", f"{found}.target", (F.col("size") * times).alias("taken"), times.alias("copies")
    )
