"""SimHash near-duplicates: fingerprints joined through their segment popcounts.

A fingerprint is cut into 32 segments of 2 bits and stands for the vector of their bit counts. The
Manhattan distance of two vectors is at most the Hamming distance of the fingerprints, so linked
fingerprints lie within `distance` of each other in that space. The grid: the segments form
distance + 3 blocks; two vectors within `distance` agree on at least three whole blocks, so every
vector is posted in the cells of all triples of blocks (35 for a distance of 4), and only vectors that
share a cell are compared, first by Manhattan, then by Hamming distance. (A grid over the whole vector
would need 50,049 probes for its neighbour cells.) No link is missed: the cells only choose what is
compared.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerspan.llm.common import fresh, stored
from ledgerspan.llm.components import components

DISTANCE = 4
SHINGLE = 4
LOW = 0x5555555555555555


def fingerprint_value(text: str | None, k: int = SHINGLE) -> int:
    """Majority of the bits of the shingles' XXH64 (seed 42), as a signed 64-bit number."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    hashed, joined = xxhash.xxh64_intdigest, b" ".join
    if len(words) < k:
        hashes = [hashed(joined(words), 42)]
    else:
        hashes = [hashed(joined(s), 42) for s in zip(*[words[i:] for i in range(k)])]
    n, block = len(hashes), 255
    bits = np.unpackbits(np.array(hashes, dtype=">u8").view(np.uint8)).reshape(n, 64)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, block):  # a block's counts fit in a byte
        ones += np.add.reduce(bits[i : i + block], axis=0, dtype=np.uint8)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


@F.pandas_udf(T.LongType())
def fingerprint(text: pd.Series) -> pd.Series:
    return text.map(fingerprint_value)


def hex_digits(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def embed(value: Column) -> Column:
    """Bit counts of the 2-bit segments in unary (0: 00, 1: 01, 2: 11), so that the number of differing
    bits of two embeddings is the Manhattan distance of their count vectors."""
    low = F.lit(LOW)
    odd, even = F.shiftrightunsigned(value, 1).bitwiseAND(low), value.bitwiseAND(low)
    return F.shiftleft(odd.bitwiseAND(even), 1).bitwiseOR(odd.bitwiseOR(even))


def block_masks(distance: int) -> list[int]:
    blocks = distance + 3
    cuts = [round(i * 32 / blocks) for i in range(blocks + 1)]
    return [_signed(sum(3 << (2 * s) for s in range(a, b))) for a, b in zip(cuts, cuts[1:])]


def _lowest(bits: Column, n: int) -> Column:
    rest, got = bits, F.lit(0).cast("long")
    for _ in range(n):
        lowest = rest.bitwiseAND(-rest)
        got, rest = got.bitwiseOR(lowest), rest.bitwiseXOR(lowest)
    return got


def _or(x: Column, y: Column) -> Column:
    return x.bitwiseOR(y)


def links(values: DataFrame, name: str, distance: int = DISTANCE) -> DataFrame:
    """(a, b), a < b: the pairs of distinct values of column `name` that differ in at most `distance` bits.

    A pair comes out once, from the first of its common cells. Cells are joined by shuffle; a cell
    that many fingerprints share is split by the skew join. Values are distinct, so copies make no pairs.
    """
    masks = block_masks(distance)
    cells = [(sum(1 << b for b in three), three) for three in combinations(range(len(masks)), 3)]
    embedded = embed(F.col("a"))
    posted = F.array(
        *[
            F.struct(F.lit(bits).cast("long").alias("blocks"), F.col("e").bitwiseAND(F.lit(_signed(sum(masks[b] & (1 << 64) - 1 for b in three)))).alias("cell"))
            for bits, three in cells
        ]
    )
    points = values.select(F.col(name).alias("a")).withColumn("e", embedded)
    left = points.select("a", "e", F.inline(posted))
    right = left.select(F.col("a").alias("b"), F.col("e").alias("f"), F.col("blocks").alias("blocks_b"), F.col("cell").alias("cell_b"))
    apart = F.col("e").bitwiseXOR(F.col("f"))
    agreeing = reduce(
        _or, [F.when(apart.bitwiseAND(F.lit(m)) == 0, F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, m in enumerate(masks)]
    )
    close = (
        (F.col("blocks") == F.col("blocks_b"))
        & (F.col("cell") == F.col("cell_b"))
        & (F.col("a") < F.col("b"))
        & (F.bit_count(apart) <= distance)
        & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
        & (_lowest(agreeing, 3) == F.col("blocks"))
    )
    return left.hint("merge").join(right, close).select("a", "b")


def groups(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """doc_id, fingerprint (signed number) and component_id of every row.

    Null and empty texts have fingerprint zero and link like any other. The component is the smallest
    doc_id reachable through links, null only if no document of the group has an id. Copies share a
    fingerprint, hence are grouped before any join. An empty table gives none.
    """
    marked = stored(docs.select("doc_id", fingerprint("text").alias("fp")), "simhash")
    distinct = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-values")
    joined = components(links(distinct, "fp", distance), "a", "b")
    rooted = distinct.join(joined, distinct["fp"] == joined["node"], "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("root")
    )
    rooted = stored(rooted, "simhash-roots")
    least = rooted.groupBy(F.col("root").alias("at")).agg(F.min("first").alias("component_id"))
    named = stored(rooted.join(least, F.col("root") == F.col("at")).select(F.col("fp").alias("value"), "component_id"), "simhash-groups")
    return marked.join(named, F.col("fp") == F.col("value"), "left").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """One row of each group, with the columns of `docs`: that of the smallest doc_id (null ids last).

    Of rows that repeat the id, the one whose text hashes lowest stays; of rows alike in both any single
    one. Only ids and hashes are stored; the texts meet the table of those that stay in one join.
    """
    none, mark, wins = (fresh(docs.columns, n) for n in ("__none", "__mark", "__wins"))
    thin = stored(docs.select("doc_id", F.xxhash64("text").alias("mark"), fingerprint("text").alias("fp")), "simhash")
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("mark"))
    distinct = stored(thin.groupBy("fp").agg(F.min(order).alias("first")), "simhash-values")
    joined = components(links(distinct, "fp", distance), "a", "b")
    rooted = distinct.join(joined, distinct["fp"] == joined["node"], "left").select(
        "first", F.coalesce("component", "fp").alias("root")
    )
    best = rooted.groupBy("root").agg(F.min("first").alias("first"))
    best = stored(best.select(F.coalesce("first.doc_id", F.lit(0)).alias(wins), F.col("first.none").alias(none), F.col("first.mark").alias(mark)), "simhash-kept")
    same = (F.coalesce(docs["doc_id"], F.lit(0)) == F.col(wins)) & (docs["doc_id"].isNull() == F.col(none)) & (F.xxhash64(docs["text"]) == F.col(mark))
    # the join's own partitioning serves the removal of rows alike in id and text
    kept = docs.join(best, same).dropDuplicates([wins, none, mark])
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
