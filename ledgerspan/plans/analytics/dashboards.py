"""Queries behind the documented dashboard, each on the views and in its own grain."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerspan.functions.numbers import exact_sum, or_zero
from ledgerspan.plans.analytics import kpis
from ledgerspan.plans.analytics.views import CATEGORY_LEVELS

LEVELS = ("category_macro_group", "category_group", "category_family", "category_name")


def monthly_spending(spending: DataFrame) -> DataFrame:
    return (
        spending.groupBy(F.trunc("payment_date", "month").alias("payment_month"))
        .agg(exact_sum("payment_value").alias("total_spending"), F.count("*").alias("payment_count"))
        .orderBy("payment_month")
    )


def level_mix(contracts: DataFrame, spending: DataFrame, level: str) -> DataFrame:
    """Contract value and spend per category level; each fact is aggregated before they meet."""
    value = contracts.groupBy(level).agg(exact_sum("total_value").alias("contracted_value"))
    spent = spending.groupBy(level).agg(exact_sum("payment_value").alias("total_spending"))
    return value.join(spent, level, "full_outer").select(
        level, or_zero("contracted_value").alias("contracted_value"), or_zero("total_spending").alias("total_spending")
    )


def amendment_flags(renewals: DataFrame) -> DataFrame:
    return renewals.groupBy("contract_key").agg(
        F.max("is_renewal").alias("has_renewal"), F.max(~F.col("is_renewal")).alias("has_top_up")
    )


def contract_table(contracts: DataFrame, renewals: DataFrame) -> DataFrame:
    """Operational table: events are reduced to one row per contract first, so contracts never multiply."""
    flags = amendment_flags(renewals)
    return contracts.join(flags, "contract_key", "left").select(
        "contract_id", "supplier_legal_name", "category_name", "balance_value", "final_risk",
        "validity_start_date", "validity_end_date",
        F.coalesce("has_renewal", F.lit(False)).alias("has_renewal"),
        F.coalesce("has_top_up", F.lit(False)).alias("has_top_up"),
    )


def action_card(contracts: DataFrame, context: DataFrame) -> DataFrame:
    """Contracts expired or within 90 days, per band."""
    as_of = context.select("as_of_date").scalar()
    banded = contracts.select(kpis.expiry_band("validity_end_date", as_of).alias("expiry_status"))
    due = banded.where(F.col("expiry_status") != "outside_renewal_window")
    return due.groupBy("expiry_status").agg(F.count("*").alias("contract_count"))


def drill_hierarchy(contracts: DataFrame) -> DataFrame:
    """Macro group -> group -> family -> category with subtotals at every level."""
    rolled = contracts.rollup(*LEVELS).agg(
        F.grouping_id().cast("bigint").alias("level_id"),
        F.count("*").alias("contract_count"),
        exact_sum("total_value").alias("contracted_value"),
    )
    return rolled.select(*LEVELS, "level_id", "contract_count", "contracted_value")


def top_contracts(contracts: DataFrame, renewals: DataFrame, n: int = 20) -> DataFrame:
    """A top-k report: the limit is applied before the flags, which then touch k contracts only."""
    top = contracts.select("contract_key", "contract_id", "total_value", "balance_value").orderBy(
        F.col("total_value").desc(), "contract_id"
    ).limit(n)
    events = renewals.join(F.broadcast(top.select("contract_key")), "contract_key", "left_semi")
    return top.join(amendment_flags(events), "contract_key", "left").select(
        "contract_id", "total_value", "balance_value",
        F.coalesce("has_renewal", F.lit(False)).alias("has_renewal"),
        F.coalesce("has_top_up", F.lit(False)).alias("has_top_up"),
    )


def top_suppliers(
    spending: DataFrame, latest_risk: DataFrame, financials: DataFrame, financial_year: int, n: int = 20
) -> DataFrame:
    """A top-k report of spend, enriched with latest risk and dependency in one fiscal year."""
    totals = spending.groupBy("supplier_key", "supplier_legal_name").agg(
        exact_sum("payment_value").alias("total_spending")
    )
    top = totals.orderBy(F.col("total_spending").desc(), "supplier_key").limit(n)
    risk = latest_risk.select("supplier_key", "final_risk", "homologation_status")
    ratio = financials.where(F.col("financial_year") == financial_year).select(
        "supplier_key", "financial_dependency_ratio"
    )
    return top.join(risk, "supplier_key", "left").join(ratio, "supplier_key", "left")


def category_dimension(contracts: DataFrame) -> DataFrame:
    return contracts.select(*CATEGORY_LEVELS).distinct()


def supplier_profile(
    suppliers: DataFrame, contracts: DataFrame, spending: DataFrame, latest_risk: DataFrame
) -> DataFrame:
    """Risk, spend and contracts side by side, every fact reduced to the supplier first."""
    held = contracts.groupBy("supplier_key").agg(
        F.count("*").alias("contract_count"), exact_sum("total_value").alias("contracted_value")
    )
    spent = spending.groupBy("supplier_key").agg(exact_sum("payment_value").alias("total_spending"))
    risk = latest_risk.select("supplier_key", "final_risk", "homologation_status")
    base = suppliers.select(
        "supplier_key", "supplier_legal_name", "economic_group_key", "economic_group_legal_name"
    )
    return (
        base.join(risk, "supplier_key", "left")
        .join(spent, "supplier_key", "left")
        .join(held, "supplier_key", "left")
        .withColumns({c: or_zero(c) for c in ("total_spending", "contract_count", "contracted_value")})
    )


def exceptions_by_entity(exceptions: DataFrame) -> DataFrame:
    """Exceptions per entity and cause."""
    cause = F.explode(F.split("exception_cause", "; "))
    return exceptions.select("entity", cause.alias("cause")).groupBy("entity", "cause").agg(
        F.count("*").alias("exception_count")
    )


def profit_composition(financials: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Does cost plus gross profit recompose revenue in each supplier-year?"""
    gap = F.abs(F.col("total_cost") + F.col("gross_profit") - F.col("gross_revenue"))
    return financials.select(
        "financial_snapshot_key", "financial_year", "total_cost", "gross_profit", "net_income",
        "gross_revenue", (gap <= tolerance).alias("is_recomposed"),
    )


def risk_alerts(latest_risk: DataFrame) -> DataFrame:
    return latest_risk.select(
        "supplier_key", "homologation_status", "final_risk",
        (F.col("homologation_status") != "ativa").alias("is_approval_inactive"),
        (F.col("final_risk") == "alto").alias("is_high_risk"),
    )
