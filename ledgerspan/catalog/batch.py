"""One batch over the test tables: staging and curated tables, each written once per session.

The curated and quality queries read published tables, as a run does: a table is staged, written
as Parquet to the shared checkpoint folder of the cluster, and read by everything downstream.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerspan.catalog import adapters as A
from ledgerspan.catalog.store import base_path, is_stored, stored
from ledgerspan.operators.rules import accepted
from ledgerspan.plans import curated as C, staging as S
from ledgerspan.plans.curated.calendar import BUSINESS_DATES
from ledgerspan.plans.curated.contracts import CONTRACT_COLUMNS
from ledgerspan.plans.curated.financials import FINANCIAL_COLUMNS
from ledgerspan.plans.curated.renewals import RENEWAL_COLUMNS
from ledgerspan.plans.curated.resolution import exceptions, published
from ledgerspan.plans.curated.risk import RFI_COLUMNS
from ledgerspan.plans.curated.spending import SPENDING_COLUMNS
from ledgerspan.plans.curated.suppliers import SUPPLIER_COLUMNS, publish_names

REFERENCE = date.fromisoformat(A.RISK_REFERENCE)
CATEGORY = {"contracts": "contract_category", "payments": "payment_category"}
STAGED = ("contracts", "amendments", "payments", "risk")


class Batch:
    """`reads` names the staged sources whose rows the query itself reads; all of them by default.

    Of the others only dates and categories are wanted, for the calendar and the categories (`seen`), so their rows aren't stored.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, reads: Iterable[str] = STAGED):
        # payments and amendments both need the contracts
        self.spark, self.sf_dir, self.reads = spark, sf_dir, {*reads, "contracts"}
        self.base = base_path(spark, sf_dir)

    def table(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        return stored(self.spark, self.sf_dir, name, build)

    def raw(self, source: str) -> DataFrame:
        return A.raw(self.spark, self.sf_dir, source)

    # staging: valid rows
    def valid(self, source: str) -> DataFrame:
        builders = {
            "companies": lambda: accepted(S.stage_companies(self.raw("companies"))),
            "contracts": lambda: S.valid_contracts(self.raw("contracts")),
            "amendments": lambda: S.valid_amendments(self.raw("amendments"), self.staged("contracts")),
            "payments": lambda: S.valid_payments(self.raw("payments"), self.staged("contracts")),
            "risk": lambda: S.valid_risk(self.raw("risk"), REFERENCE),
        }
        return builders[source]()

    def staged(self, source: str) -> DataFrame:
        return self.table(f"stg_{source}", lambda: self.valid(source))

    def seen(self, source: str) -> DataFrame:
        """What the calendar and the categories take from a staged source: the first and last value of each date, by category.

        Taken from the staged rows themselves where the query reads them anyway.
        """
        if source in self.reads or is_stored(self.spark, self.sf_dir, f"stg_{source}"):
            return self.staged(source)
        dates = (*BUSINESS_DATES[source], "load_date")
        keys = [CATEGORY[source]] if source in CATEGORY else []

        def ends() -> DataFrame:
            both = F.array(*[F.struct(*[f(c).alias(c) for c in dates]) for f in (F.min, F.max)])
            return self.valid(source).groupBy(*keys).agg(both.alias("ends")).select(*keys, F.inline("ends"))

        return self.table(f"seen_{source}", ends)

    def all_staged(self) -> dict[str, DataFrame]:
        return {s: self.staged(s) for s in STAGED}

    def all_seen(self) -> dict[str, DataFrame]:
        return {s: self.seen(s) for s in STAGED}

    # curated: annotated rows, from which published rows and exceptions are read
    def suppliers(self) -> DataFrame:
        return self.table("res_supplier", lambda: C.resolve_suppliers(self.staged("companies")))

    def dim_supplier(self) -> DataFrame:
        return published(publish_names(self.suppliers()), SUPPLIER_COLUMNS)

    def dim_economic_group(self) -> DataFrame:
        return C.economic_groups(self.dim_supplier())

    def dim_calendar(self) -> DataFrame:
        return self.table("dim_calendar", lambda: C.build_calendar(self.all_seen()))

    def dim_category(self) -> DataFrame:
        return self.table(
            "dim_category", lambda: C.build_categories(self.seen("contracts"), self.seen("payments"))
        )

    def resolve_contracts(self) -> DataFrame:
        return C.resolve_contracts(
            self.staged("contracts"), self.dim_supplier(), self.dim_category(), self.dim_calendar()
        )

    def contracts(self) -> DataFrame:
        return self.table("res_contract", self.resolve_contracts)

    def dim_contract(self) -> DataFrame:
        return published(self.contracts(), CONTRACT_COLUMNS)

    def resolve_spending(self) -> DataFrame:
        return C.resolve_spending(
            self.staged("payments"), self.dim_contract(), self.dim_supplier(), self.dim_category(),
            self.dim_calendar(),
        )

    def spending(self) -> DataFrame:
        return self.table("res_spending", self.resolve_spending)

    def resolve_rfi(self) -> DataFrame:
        return C.resolve_rfi(self.staged("risk"), self.dim_supplier(), self.dim_calendar())

    def resolve_renewals(self) -> DataFrame:
        return C.resolve_renewals(self.staged("amendments"), self.dim_contract(), self.dim_calendar())

    def resolve_financials(self) -> DataFrame:
        return C.resolve_financials(self.staged("companies"), self.dim_supplier(), self.dim_calendar())

    def resolved(self) -> dict[str, DataFrame]:
        return {
            "dim_supplier": self.suppliers(),
            "dim_contract": self.contracts(),
            "fact_spending": self.spending(),
            "fact_rfi": self.table("res_rfi", self.resolve_rfi),
            "fact_renewal": self.table("res_renewal", self.resolve_renewals),
            "fact_supplier_financial": self.table("res_financial", self.resolve_financials),
        }

    def curated(self) -> dict[str, DataFrame]:
        rows = self.resolved()
        return {
            "dim_supplier": self.dim_supplier(),
            "dim_economic_group": self.dim_economic_group(),
            "dim_calendar": self.dim_calendar(),
            "dim_category": self.dim_category(),
            "dim_contract": self.dim_contract(),
            "fact_spending": published(rows["fact_spending"], SPENDING_COLUMNS),
            "fact_rfi": published(rows["fact_rfi"], RFI_COLUMNS),
            "fact_renewal": published(rows["fact_renewal"], RENEWAL_COLUMNS),
            "fact_supplier_financial": published(rows["fact_supplier_financial"], FINANCIAL_COLUMNS),
        }

    def rejected(self) -> dict[str, DataFrame]:
        from ledgerspan.plans.quality import DIRECT_CONTROLS

        rows = self.resolved()
        return {c.exceptions: exceptions(rows[c.entity]) for c in DIRECT_CONTROLS}

    def sources(self) -> dict[str, DataFrame]:
        from ledgerspan.plans.curated.financials import expected_revenue

        return {
            "stg_empresas": self.staged("companies"),
            "stg_contratos": self.staged("contracts"),
            "stg_pagamentos": self.staged("payments"),
            "stg_homologacoes_risco": self.staged("risk"),
            "stg_aditamentos": self.staged("amendments"),
            "stg_empresas_financial": expected_revenue(self.staged("companies")),
        }
