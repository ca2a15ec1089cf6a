"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerspan.operators.storage import forget, keep as stored, shared_folder

__all__ = ["stored", "forget", "shared_folder", "table", "fresh", "let", "words_of", "ascii_lower", "crc_remainder", "commonest", "WORD"]

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(columns: Iterable[str], name: str) -> str:
    """A column name that none of `columns` has, in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with `value` computed once per row, also where a lambda inside uses it per element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """Words between ASCII white space; null has none."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\f\r"))
    none = F.array().cast("array<string>")
    return F.when(inner == "", none).otherwise(F.split(inner, r"[\x20\x09-\x0D]+"))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. The quick path applies where no other character is."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, upper, upper.lower())
    )


def crc_remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo `divisor`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor


def commonest(counts: DataFrame, count: str, limit: int) -> DataFrame:
    """Rows with the highest counts, as many as fit in `limit` when cut between two bins of counts.

    Bins are an eighth of an octave wide, so their sizes are a few hundred numbers whatever the table, and
    no task sends more than what is taken. Rows of a bin that would pass the limit stay out together.
    """
    at = F.floor(F.log2(F.col(count)) * 8)
    sizes = {r["at"]: r["n"] for r in counts.groupBy(at.alias("at")).agg(F.count("*").alias("n")).collect()}
    total, least = 0, None
    for bin_ in sorted(sizes, reverse=True):
        total += sizes[bin_]
        if total > limit:
            break
        least = bin_
    return counts.where(at >= least) if least is not None else counts.limit(0)
