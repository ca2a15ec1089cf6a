"""`dim_contract`: staged contracts with supplier, category and calendar keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerspan.functions.text import prefixed_key
from ledgerspan.operators.lookup import calendar_roles, lookup
from ledgerspan.operators.rules import Rule, annotate
from ledgerspan.operators.uniqueness import flag_repeated
from ledgerspan.plans.curated.resolution import ERRORS, missing, missing_optional, with_supplier
from ledgerspan.sources.raw import LINEAGE

CONTRACT_COLUMNS = (
    "contract_key", "contract_id", "supplier_key", "economic_group_key", "category_key",
    "validity_start_calendar_key", "validity_end_calendar_key", "risk_evaluation_calendar_key",
    "contract_name", "contract_type", "contract_status", "final_risk", "closure_reason",
    "original_value", "total_value", "balance_value", *LINEAGE,
)


def resolve_contracts(
    contracts: DataFrame, suppliers: DataFrame, categories: DataFrame, calendar: DataFrame
) -> DataFrame:
    rows = flag_repeated(contracts, ["contract_id"], "__repeated")
    rows = with_supplier(rows, suppliers)
    rows = lookup(rows, categories, "contract_category", "category_code", {"category_key": "category_key"})
    rows = calendar_roles(
        rows, calendar, ["validity_start_date", "validity_end_date", "risk_evaluation_date"]
    )
    rules = [
        Rule(F.col("__repeated"), "contract_id duplicado na fonte curated"),
        missing("supplier_key", "supplier_cnpj", "dim_supplier"),
        missing("category_key", "contract_category", "dim_category"),
        missing("validity_start_calendar_key", "validity_start_date", "dim_calendar"),
        missing("validity_end_calendar_key", "validity_end_date", "dim_calendar"),
        missing_optional("risk_evaluation_date", "risk_evaluation_calendar_key", "dim_calendar"),
    ]
    return annotate(rows, rules, ERRORS).drop("__repeated").withColumn(
        "contract_key", prefixed_key("CON-", "contract_id")
    )
