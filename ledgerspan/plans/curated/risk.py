"""`fact_rfi`: approval and risk assessments resolved to supplier and calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerspan.functions.text import prefixed_key
from ledgerspan.operators.lookup import calendar_roles
from ledgerspan.operators.rules import Rule, annotate
from ledgerspan.operators.uniqueness import flag_repeated
from ledgerspan.plans.curated.resolution import ERRORS, missing, missing_optional, with_supplier
from ledgerspan.sources.raw import LINEAGE

RFI_COLUMNS = (
    "rfi_key", "risk_assessment_id", "supplier_key", "economic_group_key", "assessment_calendar_key",
    "last_approval_calendar_key", "expiration_calendar_key", "homologation_result",
    "homologation_status", "financial_risk", "labor_risk", "credit_rating", "final_risk",
    "interest_to_revenue_ratio", "revenue_trend", "net_margin", "labor_cases_index", *LINEAGE,
)


def resolve_rfi(assessments: DataFrame, suppliers: DataFrame, calendar: DataFrame) -> DataFrame:
    rows = flag_repeated(assessments, ["risk_assessment_id"], "__repeated")
    rows = with_supplier(rows, suppliers)
    rows = calendar_roles(rows, calendar, ["assessment_date", "last_approval_date", "expiration_date"])
    rules = [
        Rule(F.col("__repeated"), "risk_assessment_id duplicado na fonte curated"),
        missing("supplier_key", "supplier_cnpj", "dim_supplier"),
        missing("assessment_calendar_key", "assessment_date", "dim_calendar"),
        missing_optional("last_approval_date", "last_approval_calendar_key", "dim_calendar"),
        missing_optional("expiration_date", "expiration_calendar_key", "dim_calendar"),
    ]
    return annotate(rows, rules, ERRORS).drop("__repeated").withColumn(
        "rfi_key", prefixed_key("RFI-", "risk_assessment_id")
    )
