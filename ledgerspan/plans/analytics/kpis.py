"""The six KPIs, each on its analytic view."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerspan.functions.dates import days_between, expiry_band
from ledgerspan.functions.numbers import EXACT_SUM, RISK_ORDER, exact_sum, or_zero, ordinal, safe_ratio
from ledgerspan.operators.ordering import dense_rank_desc
from ledgerspan.operators.storage import keep
from ledgerspan.operators.uniqueness import latest_per_key


def consumption(contracts: DataFrame) -> DataFrame:
    """Contracted, balance and consumed value per supplier and macro group."""
    consumed = F.col("total_value") - F.col("balance_value")
    rows = contracts.groupBy("supplier_legal_name", "category_macro_group").agg(
        F.count("*").alias("contract_count"),
        exact_sum("total_value").alias("contracted_value"),
        exact_sum("balance_value").alias("contract_balance_value"),
        exact_sum(consumed).alias("consumed_contract_value"),
    )
    return rows.withColumn(
        "consumption_percentage", safe_ratio(F.col("consumed_contract_value"), F.col("contracted_value"))
    ).orderBy(F.col("contracted_value").desc_nulls_last(), F.col("supplier_legal_name").asc_nulls_last())


def expiry(contracts: DataFrame, context: DataFrame) -> DataFrame:
    """Days to expiry and band at the reference date of the run (a one-row context)."""
    as_of = context.select("as_of_date").scalar()
    return contracts.select(
        "contract_id", "contract_name", "supplier_legal_name", "contract_status", "validity_end_date",
        "total_value", "balance_value",
        days_between(as_of, F.col("validity_end_date")).alias("days_to_expiry"),
        expiry_band("validity_end_date", as_of).alias("expiry_status"),
    ).orderBy(F.col("validity_end_date").asc_nulls_last(), F.col("contract_id").asc_nulls_last())


def spending_by_supplier(spending: DataFrame) -> DataFrame:
    return spending.groupBy("economic_group_key", "supplier_legal_name").agg(
        exact_sum("payment_value").alias("total_spending")
    )


def portfolio_share(totals: DataFrame, value: str, name: str) -> DataFrame:
    """Share of each row in the grand total, which is a scalar subquery."""
    total = totals.agg(F.sum(F.col(value).cast(EXACT_SUM)).cast(EXACT_SUM)).scalar()
    return totals.withColumn(name, safe_ratio(F.col(value), total))


def concentration(spending: DataFrame) -> DataFrame:
    """Spend share and dense rank per group and supplier.

    Three consumers (share, total, rank) need the totals, which are small next to the payments, so
    the payments are aggregated once and the totals are stored.
    """
    totals = keep(spending_by_supplier(spending), "spending-totals")
    shared = portfolio_share(totals, "total_spending", "spending_concentration_ratio")
    ranked = dense_rank_desc(shared, "total_spending", "spending_rank")
    return ranked.select(
        "economic_group_key", "supplier_legal_name", "total_spending", "spending_concentration_ratio",
        "spending_rank",
    ).orderBy("spending_rank", F.col("supplier_legal_name").asc_nulls_last())


def risk_severity(risk: Column) -> Column:
    return F.coalesce(ordinal(risk, RISK_ORDER), F.lit(0))


def latest_risk(rfi: DataFrame) -> DataFrame:
    """Latest assessment of each supplier (by date, then id), worst risk first."""
    latest = latest_per_key(rfi, ["supplier_key"], "assessment_date", "risk_assessment_id")
    return latest.select(
        "supplier_key", "supplier_cnpj", "supplier_legal_name", "economic_group_key", "assessment_date",
        "expiration_date", "homologation_result", "homologation_status", "financial_risk", "labor_risk",
        "credit_rating", "final_risk", "interest_to_revenue_ratio", "revenue_trend", "net_margin",
        "labor_cases_index",
    ).orderBy(risk_severity(F.col("final_risk")).desc(), F.col("supplier_legal_name").asc_nulls_last())


def dependency(financials: DataFrame) -> DataFrame:
    return financials.select(
        "financial_year", "supplier_key", "supplier_cnpj", "supplier_legal_name", "economic_group_key",
        "gross_revenue", "total_cost", "gross_profit", "net_income", "annualized_contract_value",
        "financial_dependency_ratio", "revenue_to_contract_coverage_ratio",
    ).orderBy(
        F.col("financial_year").desc(),
        F.col("financial_dependency_ratio").desc_nulls_last(),
        F.col("supplier_legal_name").asc_nulls_last(),
    )


def data_quality(reconciliation: DataFrame, exceptions: DataFrame) -> DataFrame:
    counts = exceptions.groupBy("entity").agg(F.count("*").alias("exception_count"))
    return (
        reconciliation.join(counts, "entity", "left")
        .select(
            "entity", "status", "match_rate", "row_count_delta", "monetary_delta", "failure_reasons",
            or_zero("exception_count").alias("exception_count"),
        )
        .orderBy(F.col("status").desc(), "entity")
    )
