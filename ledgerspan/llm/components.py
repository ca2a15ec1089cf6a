"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerspan.llm.common import stored
from ledgerspan.operators.skew import join_unique


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.hash("u", "v").cast("long")).alias("h")).first()
    return row["n"], row["h"]


def _star(pairs: DataFrame, larger_only: bool) -> DataFrame:
    """Point the neighbours of every u at the smallest node around it."""
    least = pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("least"))
    met = join_unique(pairs, least, ["u"], ["u"])
    if larger_only:
        return met.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("least").alias("v"))
    hung = met.where(F.col("v") != F.col("least")).select(F.col("v").alias("u"), F.col("least").alias("v"))
    return hung.unionByName(least.select("u", F.col("least").alias("v")))


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node in a link; the component is its smallest node.

    Links are pairs of non-null ids, in any order, repeats and self-links allowed; self-links and an
    empty table give no rows. Each round is two aggregates and two joins, and rounds grow with the
    logarithm of the longest chain. A hub's links are spread over tasks (join_unique), and only the
    count and a checksum of the links reach the driver. Rounds are stored, so none is run twice.
    """
    big, small = F.greatest(a, b), F.least(a, b)
    edges = stored(links.where(F.col(a) != F.col(b)).select(big.alias("u"), small.alias("v")).distinct(), "links")
    before = _state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = stored(_star(both, larger_only=True).distinct(), "large-star")
        edges = stored(_star(large, larger_only=False).where("u <> v").distinct(), "small-star")
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
