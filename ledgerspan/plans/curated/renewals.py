"""`fact_renewal`: renewals and top-ups resolved through the published contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerspan.functions.text import prefixed_key
from ledgerspan.operators.lookup import calendar_roles, lookup
from ledgerspan.operators.rules import Rule, annotate, parsed, positive
from ledgerspan.operators.uniqueness import flag_repeated
from ledgerspan.plans.curated.resolution import ERRORS, missing
from ledgerspan.plans.staging.amendments import RENEWAL
from ledgerspan.sources.raw import LINEAGE

RENEWAL_COLUMNS = (
    "renewal_key", "amendment_id", "amendment_sequence", "amendment_type", "is_renewal",
    "contract_key", "supplier_key", "economic_group_key", "category_key",
    "validity_start_calendar_key", "validity_end_calendar_key", "amendment_value", *LINEAGE,
)


def resolve_renewals(amendments: DataFrame, contracts: DataFrame, calendar: DataFrame) -> DataFrame:
    rows = flag_repeated(amendments, ["amendment_id"], "__repeated")
    brought = ("contract_key", "supplier_key", "economic_group_key", "category_key")
    rows = lookup(rows, contracts, "contract_id", "contract_id", {c: c for c in brought})
    rows = calendar_roles(rows, calendar, ["validity_start_date", "validity_end_date"])
    rules = [
        Rule(F.col("__repeated"), "amendment_id duplicado na fonte curated"),
        missing("contract_key", "contract_id", "dim_contract"),
        missing("validity_start_calendar_key", "validity_start_date", "dim_calendar"),
        missing("validity_end_calendar_key", "validity_end_date", "dim_calendar"),
        parsed("amendment_value"),
        positive("amendment_value"),
    ]
    return annotate(rows, rules, ERRORS).drop("__repeated").withColumns(
        {
            "renewal_key": prefixed_key("RNL-", "amendment_id"),
            "is_renewal": F.col("amendment_type") == RENEWAL,
        }
    )
