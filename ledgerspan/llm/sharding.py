"""Shards by extendible hashing: a directory over hash-prefix bits in which only oversized buckets split.

Each document has 60 bits of the md5 of its id and text. A bucket (depth, prefix) that holds more than
the byte limit splits on the next bit, so a shard is the shallowest prefix that fits. The split runs on
a histogram of prefixes a few bits deeper than an even split needs; prefixes still too large are counted
again, deeper, until all fit. Only the total and counts reach the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ledgerspan.llm.common import fresh, stored
from ledgerspan.operators.ordering import dense_positions

BITS = 60
LIMIT = 64 << 20  # bytes of text in a shard
SLACK = 4  # bits of the first histogram beyond those of an even split
STEP = 8  # bits that each further histogram adds


def n_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def key_bits(doc_id: Column, text: Column) -> Column:
    """The first 60 bits of md5(id : md5(text)) as a number; nulls count as empty."""
    digest = F.md5(F.coalesce(text, F.lit("")).cast("binary"))
    key = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), digest)
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 15), 16, 10).cast("long")


def prefix(bits: Column, depth: Column | int) -> Column:
    away = F.lit(BITS) - (F.lit(depth) if isinstance(depth, int) else depth)
    return F.when(away >= BITS, F.lit(0).cast("long")).otherwise(F.call_function("shiftright", bits, away.cast("int")))


def _histogram(thin: DataFrame, shallow: int, deep: int, limit: int) -> DataFrame:
    """(prefix, depth, shard_bytes) of each prefix of `deep` bits: its shallowest ancestor below `shallow`
    that fits; null where none does."""
    counted = stored(thin.groupBy(prefix(F.col("bits"), deep).alias("prefix")).agg(F.sum("n_bytes").alias("bytes")), "shard-histogram")
    level = F.explode(F.sequence(F.lit(shallow), F.lit(deep))).alias("depth")
    # shifting by the difference in depth takes a prefix to its ancestor
    above = counted.select("prefix", "bytes", level).withColumn("ancestor", F.call_function("shiftright", F.col("prefix"), F.lit(deep) - F.col("depth")))
    sizes = above.groupBy("depth", "ancestor").agg(F.sum("bytes").alias("shard_bytes")).where(F.col("shard_bytes") <= limit)
    fitting = above.join(sizes, ["depth", "ancestor"]).groupBy("prefix").agg(F.min(F.struct("depth", "shard_bytes")).alias("leaf"))
    return counted.join(fitting, "prefix", "left").select("prefix", "leaf.depth", "leaf.shard_bytes")


def directory(thin: DataFrame, limit: int = LIMIT) -> list[tuple[int, DataFrame]]:
    """The rounds of splitting: (bits looked at, table of prefix, depth, shard_bytes) over (bits, n_bytes).

    A row is looked up round by round until its prefix has a depth. In the last round a prefix without
    one holds rows with equal keys that are too large together.
    """
    total = thin.agg(F.sum("n_bytes")).first()[0] or 0
    deep = min(BITS, max(1, math.ceil(math.log2(max(1, total) / limit)) if total > limit else 1) + SLACK)
    rounds, shallow, rest = [], 0, thin
    while True:
        found = stored(_histogram(rest, shallow, deep, limit), "shard-directory")
        rounds.append((deep, found))
        open_ = found.where(F.col("depth").isNull()).select(F.col("prefix").alias("open"))
        if deep == BITS or open_.limit(1).count() == 0:
            return rounds
        rest = rest.join(open_, prefix(F.col("bits"), deep) == F.col("open"), "left_semi")
        shallow, deep = deep + 1, min(BITS, deep + STEP)


def assign(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Add n_bytes, shard, depth and shard_bytes to every document; clashing names of `docs` are replaced.

    `shard` is the prefix in binary digits (empty: all fits in one). A document above the limit is a
    shard of its own, `large-` and its key, and makes no bucket split. Rows with equal id and text share
    their key; where they are too many for a shard, they fill pages `prefix/0`, `prefix/1`, ... that fit.
    Null text has 0 bytes. An empty table gives none.
    """
    added = ("n_bytes", "shard", "depth", "shard_bytes")
    kept = [c for c in docs.columns if c.lower() not in added]
    b, n = fresh(docs.columns, "__bits"), fresh(docs.columns, "__bytes")
    keyed = docs.select(*[F.col(f"`{c}`") for c in kept], key_bits(F.col("doc_id"), F.col("text")).alias(b), n_bytes(F.col("text")).alias(n))
    small = keyed.where(F.col(n) <= limit).select(F.col(b).alias("bits"), F.col(n).alias("n_bytes"))
    rounds = directory(stored(small, "shard-keys"), limit)
    depth, size = F.lit(None).cast("int"), F.lit(None).cast("long")
    joined, large = keyed, F.col(n) > limit
    names = []
    for i, (deep, found) in enumerate(rounds):
        p, leaf = fresh(joined.columns, f"__prefix{i}"), fresh(joined.columns, f"__leaf{i}")
        side = found.where(F.col("depth").isNotNull()).select(F.col("prefix").alias(p), F.struct("depth", "shard_bytes").alias(leaf))
        joined = joined.join(side, prefix(F.col(b), deep) == F.col(p), "left").drop(p)
        names.append(leaf)
        depth, size = F.coalesce(depth, F.col(f"{leaf}.depth")), F.coalesce(size, F.col(f"{leaf}.shard_bytes"))
    depth, size = F.when(large, BITS).otherwise(depth), F.when(large, F.col(n)).otherwise(size)
    digits = F.lpad(F.conv(prefix(F.col(b), depth).cast("string"), 10, 2), F.greatest(depth, F.lit(0)), "0")
    shard = F.when(large, F.concat(F.lit("large-"), F.lower(F.lpad(F.hex(F.col(b)), 15, "0")))).otherwise(F.when(depth == 0, "").otherwise(digits))
    out = joined.select(*[F.col(f"`{c}`") for c in kept], F.col(b), F.col(n).alias("n_bytes"), shard.alias("shard"), depth.alias("depth"), size.alias("shard_bytes"))
    last = rounds[-1][1].where(F.col("depth").isNull())
    if rounds[-1][0] < BITS or last.limit(1).count() == 0:
        return out.drop(b)
    return _paged(out, b, limit)


def _paged(out: DataFrame, b: str, limit: int) -> DataFrame:
    """Pages for the rows whose prefix never fits: they are numbered within their key across partitions."""
    number, position, first = (fresh(out.columns, x) for x in ("__row", "__position", "__first"))
    done = out.where(F.col("shard").isNotNull()).drop(b)
    rest = stored(out.where(F.col("shard").isNull()).withColumn(number, F.monotonically_increasing_id()), "shard-overflow")
    placed = dense_positions(rest.select(F.col(b), F.col(number), F.col("n_bytes")), F.col(b), F.col(number), name=position)
    starts = placed.groupBy(F.col(b).alias("key")).agg(F.min(position).alias(first), F.count("*").alias("rows"))
    in_page = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.col("n_bytes")))
    at = F.floor((F.col(position) - F.col(first)) / in_page)
    held = F.least(in_page, F.col("rows") - at * in_page) * F.col("n_bytes")
    pages = placed.join(stored(starts, "shard-overflow-keys"), F.col(b) == F.col("key")).select(
        F.col(number).alias("at_row"), F.concat(F.lpad(F.conv(F.col(b).cast("string"), 10, 2), BITS, "0"), F.lit("/"), at.cast("string")).alias("page"), held.alias("held")
    )
    met = rest.join(pages, F.col(number) == F.col("at_row"))
    filled = met.withColumns({"shard": F.col("page"), "depth": F.lit(BITS), "shard_bytes": F.col("held").cast("long")})
    return done.unionByName(filled.select(*done.columns))


def report(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, shard, depth and shard_bytes of every document, without its text.

    The directory decides; texts are read for their size and key only.
    """
    return assign(docs.select("doc_id", "text"), limit).drop("text")


def write(docs: DataFrame, path: str, limit: int = LIMIT) -> None:
    """One folder of Parquet files per shard; each shard is written by one task and fits its limit."""
    assigned = assign(docs, limit)
    assigned.repartition("shard").write.partitionBy("shard").parquet(path)
