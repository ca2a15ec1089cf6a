"""`fact_spending`: payments resolved against the published contract and the dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerspan.functions.text import prefixed_key
from ledgerspan.operators.lookup import calendar_roles, lookup
from ledgerspan.operators.rules import Rule, annotate, parsed, positive
from ledgerspan.operators.uniqueness import flag_repeated
from ledgerspan.plans.curated.resolution import ERRORS, missing, with_supplier
from ledgerspan.sources.raw import LINEAGE

SPENDING_COLUMNS = (
    "spending_key", "payment_id", "contract_key", "supplier_key", "economic_group_key",
    "category_key", "payment_calendar_key", "cost_center", "payment_value", *LINEAGE,
)


def resolve_spending(
    payments: DataFrame,
    contracts: DataFrame,
    suppliers: DataFrame,
    categories: DataFrame,
    calendar: DataFrame,
) -> DataFrame:
    rows = flag_repeated(payments, ["payment_id"], "__repeated")
    rows = lookup(
        rows,
        contracts,
        "contract_id",
        "contract_id",
        {
            "contract_key": "contract_key",
            "supplier_key": "contract_supplier_key",
            "category_key": "contract_category_key",
        },
    )
    rows = with_supplier(rows, suppliers)
    rows = lookup(rows, categories, "payment_category", "category_code", {"category_key": "category_key"})
    rows = calendar_roles(rows, calendar, ["payment_date"])
    rules = [
        Rule(F.col("__repeated"), "payment_id duplicado na fonte curated"),
        missing("contract_key", "contract_id", "dim_contract"),
        missing("supplier_key", "supplier_cnpj", "dim_supplier"),
        missing("category_key", "payment_category", "dim_category"),
        missing("payment_calendar_key", "payment_date", "dim_calendar"),
        parsed("payment_value"),
        positive("payment_value"),
        Rule(F.col("supplier_key") != F.col("contract_supplier_key"), "supplier_key divergente do contrato"),
        Rule(F.col("category_key") != F.col("contract_category_key"), "category_key divergente do contrato"),
    ]
    return annotate(rows, rules, ERRORS).drop("__repeated").withColumn(
        "spending_key", prefixed_key("SPN-", "payment_id")
    )
