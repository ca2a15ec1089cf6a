"""Digests of files of any size: a hash tree over lines, built by aggregates.

A line has a hash, ROWS lines make a block, BLOCKS blocks a segment, and the segments with the size of the file its
digest. Lines are numbered over the file, so the digest does not depend on how it is cut into tasks; no value
holds more than a thousand hashes but the last one, which has one for every million lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

ROWS, BLOCKS = 1_000, 1_000


def _files(spark: SparkSession, paths: list[str], kind: str):
    return spark.read.format(kind).option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")


def file_sizes(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, bytes) of every data file below `paths`, without its content. Spark does not list empty files."""
    listed = _files(spark, paths, "binaryFile").load(paths)
    return listed.select(F.col("_metadata.file_path").alias("path"), F.col("length").alias("bytes"))


def row_digests(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, number, digest) of every line, numbered from 0 in its file; two narrow passes, as for lineage."""
    text = _files(spark, paths, "text").option("lineSep", "\n").load(paths)
    placed = text.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"),
        F.unhex(F.sha2(F.col("value").cast("binary"), 256)).alias("digest"),
    )
    blocks = placed.groupBy("path", "block").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")
    shifts = blocks.select(F.col("path").alias("its_path"), F.col("block").alias("its_block"), shift.alias("shift"))
    # a row per block that Spark reads: the lines stay where they are
    met = placed.join(F.broadcast(shifts), (F.col("path") == F.col("its_path")) & (F.col("block") == F.col("its_block")))
    return met.select("path", (F.col("id") + F.col("shift")).alias("number"), "digest")


def _level(hashes: DataFrame, fan: int, of: Column) -> DataFrame:
    """Hash of every `fan` successive hashes of a file."""
    parent = F.floor(F.col("number") / fan).cast("bigint")
    children = F.array_sort(F.collect_list(F.struct("number", of.alias("digest"))))
    joined = F.array_join(F.transform(children, lambda x: x["digest"]), "")
    return hashes.groupBy("path", parent.alias("number")).agg(F.sha2(joined, 256).alias("digest"), F.sum("lines").alias("lines"))


def block_digests(rows: DataFrame) -> DataFrame:
    """(path, number, digest, lines) of every ROWS successive lines.

    A line goes to its block as one value of 34 bytes, two for its place and 32 of its hash; text comes after the shuffle.
    """
    place = F.unhex(F.lpad(F.hex(F.col("number") % ROWS), 4, "0"))
    lines = F.array_sort(F.collect_list(F.concat(place, F.col("digest"))))
    joined = F.array_join(F.transform(lines, lambda x: F.lower(F.hex(F.substring(x, 3, 32)))), "")
    parent = F.floor(F.col("number") / ROWS).cast("bigint")
    return rows.groupBy("path", parent.alias("number")).agg(F.sha2(joined, 256).alias("digest"), F.count("*").alias("lines"))


def file_digests(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, sha256, bytes, lines) of every data file below `paths`."""
    segments = _level(block_digests(row_digests(spark, paths)), BLOCKS, F.col("digest"))
    roots = _level(segments, 1 << 62, F.col("digest")).select(F.col("path").alias("its_path"), "digest", "lines")
    files = file_sizes(spark, paths).join(roots, F.col("path") == F.col("its_path"), "left")
    # the last hash is taken over the segments' text, so that it ends in the size of the file
    root = F.sha2(F.concat_ws(":", F.coalesce("digest", F.lit("")), F.col("bytes").cast("string")), 256)
    return files.select("path", root.alias("sha256"), "bytes", F.coalesce("lines", F.lit(0)).alias("lines"))
