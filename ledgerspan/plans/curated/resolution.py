"""Shared by the curated builders: split of resolved and rejected rows, supplier lookup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ledgerspan.operators.lookup import lookup
from ledgerspan.operators.rules import Rule

ERRORS = "curated_validation_errors"


def published(annotated: DataFrame, columns: Sequence[str]) -> DataFrame:
    return annotated.where(F.col(ERRORS) == "").select(*columns)


def exceptions(annotated: DataFrame) -> DataFrame:
    return annotated.where(F.col(ERRORS) != "")


def with_supplier(df: DataFrame, suppliers: DataFrame, left_key: str = "supplier_cnpj") -> DataFrame:
    return lookup(
        df,
        suppliers,
        left_key,
        "supplier_cnpj",
        {"supplier_key": "supplier_key", "economic_group_key": "economic_group_key"},
    )


def missing(column: str, subject: str, table: str) -> Rule:
    return Rule(F.col(column).isNull(), f"{subject} não encontrado em {table}")


def missing_optional(source: str, column: str, table: str) -> Rule:
    return Rule(F.col(source).isNotNull() & F.col(column).isNull(), f"{source} não encontrado em {table}")
