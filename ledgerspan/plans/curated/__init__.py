"""STAGING -> CURATED: dimensions with deterministic keys, facts, and the rows that do not resolve.

Every builder returns the annotated rows; `published(...)` and `exceptions(...)` split them, so a
publishing job evaluates the rules once and writes both sides from one materialised frame.
"""

from ledgerspan.plans.curated.calendar import build_calendar
from ledgerspan.plans.curated.categories import build_categories
from ledgerspan.plans.curated.contracts import resolve_contracts
from ledgerspan.plans.curated.financials import resolve_financials
from ledgerspan.plans.curated.renewals import resolve_renewals
from ledgerspan.plans.curated.risk import resolve_rfi
from ledgerspan.plans.curated.spending import resolve_spending
from ledgerspan.plans.curated.suppliers import economic_groups, resolve_suppliers

__all__ = [
    "build_calendar", "build_categories", "economic_groups", "resolve_contracts", "resolve_financials",
    "resolve_renewals", "resolve_rfi", "resolve_spending", "resolve_suppliers",
]
