"""Registration of queries and of the SQL that must return the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ledgerspan.session import tune

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Comparable output types: decimals as double, dates as ISO text."""
    def shown(field: T.StructField):
        if isinstance(field.dataType, T.DecimalType):
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return F.col(field.name).cast("string").alias(field.name)
        return F.col(field.name)

    return df.select(*[shown(f) for f in df.schema.fields])


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(build(tune(spark), sf_dir))

        run.__doc__ = build.__doc__
        assert name not in QUERIES, name
        QUERIES[name] = run
        if oracle is not None:
            ORACLE[name] = oracle
        return build

    return register
