"""RAW -> STAGING: normalise a source and attach to every row the rules it breaks."""

from ledgerspan.plans.staging.amendments import stage_amendments, valid_amendments
from ledgerspan.plans.staging.companies import stage_companies
from ledgerspan.plans.staging.contracts import stage_contracts, valid_contracts
from ledgerspan.plans.staging.payments import stage_payments, valid_payments
from ledgerspan.plans.staging.risk import stage_risk, valid_risk

__all__ = [
    "stage_amendments", "stage_companies", "stage_contracts", "stage_payments", "stage_risk",
    "valid_amendments", "valid_contracts", "valid_payments", "valid_risk",
]
