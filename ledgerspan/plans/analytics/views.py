"""The eight analytic views: curated tables joined to their dimensions, lazily.

`curated` maps table names to DataFrames. Dimensions other than the calendar grow with the data, so
they carry no broadcast hint: their measured size decides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerspan.functions.dates import days_between
from ledgerspan.functions.numbers import or_zero, safe_ratio
from ledgerspan.operators.intervals import overlapped_periods
from ledgerspan.operators.lookup import calendar_dates

CATEGORY_LEVELS = (
    "category_key", "category_code", "category_name", "category_macro_group", "category_group", "category_family",
)


def _calendar(curated: dict[str, DataFrame]) -> DataFrame:
    return curated["dim_calendar"].select("calendar_key", "calendar_date")


def suppliers_view(curated: dict[str, DataFrame]) -> DataFrame:
    groups = curated["dim_economic_group"].select("economic_group_key", "economic_group_legal_name")
    return curated["dim_supplier"].join(groups, "economic_group_key", "left").select(
        "supplier_key", "supplier_cnpj", "supplier_legal_name", "supplier_hierarchy", "company_size",
        "economic_activity", "economic_group_key", "economic_group_legal_name", "parent_supplier_key",
        "financial_scenario",
    )


def contracts_view(curated: dict[str, DataFrame]) -> DataFrame:
    suppliers = curated["dim_supplier"].select("supplier_key", "supplier_legal_name", "economic_group_key")
    categories = curated["dim_category"].select(*CATEGORY_LEVELS)
    rows = (
        curated["dim_contract"].drop("economic_group_key")
        .join(suppliers, "supplier_key")
        .join(categories, "category_key")
    )
    rows = calendar_dates(
        rows,
        _calendar(curated),
        {
            "validity_start_calendar_key": "validity_start_date",
            "validity_end_calendar_key": "validity_end_date",
        },
    )
    return rows.select(
        "contract_key", "contract_id", "contract_name", "contract_type", "contract_status", "final_risk",
        "original_value", "total_value", "balance_value", "supplier_key", "supplier_legal_name",
        "economic_group_key", *CATEGORY_LEVELS, "validity_start_date", "validity_end_date",
    )


def spending_view(curated: dict[str, DataFrame]) -> DataFrame:
    contracts = curated["dim_contract"].select("contract_key", "contract_id", "contract_status")
    suppliers = curated["dim_supplier"].select("supplier_key", "supplier_legal_name", "economic_group_key")
    categories = curated["dim_category"].select(*CATEGORY_LEVELS)
    rows = (
        curated["fact_spending"].drop("economic_group_key")
        .join(suppliers, "supplier_key")
        .join(categories, "category_key")
        .join(contracts, "contract_key")
    )
    rows = calendar_dates(rows, _calendar(curated), {"payment_calendar_key": "payment_date"})
    return rows.select(
        "spending_key", "payment_id", "payment_value", "cost_center", "payment_date", "contract_key",
        "contract_id", "contract_status", "supplier_key", "supplier_legal_name", "economic_group_key",
        *CATEGORY_LEVELS,
    )


def renewals_view(curated: dict[str, DataFrame]) -> DataFrame:
    contracts = curated["dim_contract"].select("contract_key", "contract_id")
    suppliers = curated["dim_supplier"].select("supplier_key", "supplier_legal_name")
    categories = curated["dim_category"].select(*CATEGORY_LEVELS)
    rows = (
        curated["fact_renewal"]
        .join(suppliers, "supplier_key")
        .join(categories, "category_key")
        .join(contracts, "contract_key")
    )
    rows = calendar_dates(
        rows,
        _calendar(curated),
        {
            "validity_start_calendar_key": "validity_start_date",
            "validity_end_calendar_key": "validity_end_date",
        },
    )
    return rows.select(
        "renewal_key", "amendment_id", "amendment_sequence", "amendment_type", "is_renewal",
        "amendment_value", "contract_key", "contract_id", "supplier_key", "supplier_legal_name",
        *CATEGORY_LEVELS, "validity_start_date", "validity_end_date",
    )


def quality_reconciliation_view(report: DataFrame) -> DataFrame:
    return report.select(
        "pipeline_run_id", "source_snapshot_id", "entity", "reconciliation_type", "source_table",
        "curated_table", "source_row_count", "published_row_count", "exception_row_count", "match_rate",
        "row_count_delta", "source_monetary_total", "curated_monetary_total", "exception_monetary_total",
        "monetary_delta", "status", "failure_reasons",
    )


def quality_exceptions_view(index: DataFrame) -> DataFrame:
    return index.select(
        "pipeline_run_id", F.col("batch_id").alias("source_snapshot_id"), "entity", "business_key_type",
        "business_key", "exception_cause", "source_file", "source_row_number", "load_date", "source_batch_id",
    )


def rfi_view(curated: dict[str, DataFrame]) -> DataFrame:
    suppliers = curated["dim_supplier"].select(
        "supplier_key", "supplier_cnpj", "supplier_legal_name", "economic_group_key"
    )
    rows = curated["fact_rfi"].drop("economic_group_key").join(suppliers, "supplier_key")
    rows = calendar_dates(
        rows,
        _calendar(curated),
        {
            "assessment_calendar_key": "assessment_date",
            "last_approval_calendar_key": "last_approval_date",
            "expiration_calendar_key": "expiration_date",
        },
    )
    return rows.select(
        "rfi_key", "risk_assessment_id", "assessment_date", "last_approval_date", "expiration_date",
        "homologation_result", "homologation_status", "financial_risk", "labor_risk", "credit_rating",
        "final_risk", "interest_to_revenue_ratio", "revenue_trend", "net_margin", "labor_cases_index",
        "supplier_key", "supplier_cnpj", "supplier_legal_name", "economic_group_key",
    )


def fiscal_periods(curated: dict[str, DataFrame]) -> DataFrame:
    """Distinct (fiscal year, period end): bounded by the calendar, in practice one row per year."""
    periods = curated["fact_supplier_financial"].select("financial_year", "financial_period_calendar_key").distinct()
    return calendar_dates(
        periods, _calendar(curated), {"financial_period_calendar_key": "period_end"}, "inner"
    ).select(F.col("financial_year").alias("period_year"), "period_end")


def annualized_contracts(curated: dict[str, DataFrame]) -> DataFrame:
    """Yearly equivalent of the contracts active in each fiscal year, per supplier.

    Contracts are expanded to the years they touch and summed by (supplier, year) with a partial
    aggregate, BEFORE meeting the financial facts: contracts of one supplier are never paired
    with its yearly rows, and a supplier with a third of all contracts shuffles one row per task
    and year.
    """
    contracts = curated["dim_contract"].select(
        "supplier_key", "total_value", "validity_start_calendar_key", "validity_end_calendar_key"
    )
    dated = calendar_dates(
        contracts,
        _calendar(curated),
        {"validity_start_calendar_key": "start_date", "validity_end_calendar_key": "end_date"},
        "inner",
    )
    active = overlapped_periods(dated, "start_date", "end_date", fiscal_periods(curated))
    days = days_between("start_date", "end_date") + 1
    yearly = safe_ratio(F.col("total_value"), days) * 365.25
    return active.groupBy("supplier_key", F.col("period_year").alias("financial_year")).agg(
        F.sum(yearly).alias("annualized_contract_value")
    )


def supplier_financials_view(curated: dict[str, DataFrame]) -> DataFrame:
    suppliers = curated["dim_supplier"].select(
        "supplier_key", "supplier_cnpj", "supplier_legal_name", "supplier_hierarchy",
        F.col("economic_group_key").alias("__group"),
    )
    groups = curated["dim_economic_group"].select("economic_group_key", "economic_group_legal_name")
    rows = (
        curated["fact_supplier_financial"]
        .join(suppliers, "supplier_key")
        .join(groups, "economic_group_key", "left")
        .join(annualized_contracts(curated), ["supplier_key", "financial_year"], "left")
    )
    rows = calendar_dates(
        rows, _calendar(curated), {"financial_period_calendar_key": "financial_period_end_date"}
    )
    revenue, annual = F.col("gross_revenue"), F.col("annualized_contract_value")
    return rows.select(
        "financial_snapshot_key", "financial_year", "financial_period_end_date", "gross_revenue",
        "total_cost", "payroll_cost", "gross_profit", "debt_interest", "net_income",
        safe_ratio(F.col("gross_profit"), revenue).alias("gross_margin"),
        safe_ratio(F.col("net_income"), revenue).alias("net_margin"),
        or_zero(annual).alias("annualized_contract_value"),
        safe_ratio(or_zero(annual), revenue).alias("financial_dependency_ratio"),
        safe_ratio(revenue, annual).alias("revenue_to_contract_coverage_ratio"),
        "supplier_key", "supplier_cnpj", "supplier_legal_name", "supplier_hierarchy",
        F.col("__group").alias("economic_group_key"), "economic_group_legal_name",
    )


VIEWS = {
    "vw_suppliers": suppliers_view,
    "vw_contracts": contracts_view,
    "vw_spending": spending_view,
    "vw_renewals": renewals_view,
    "vw_rfi": rfi_view,
    "vw_supplier_financials": supplier_financials_view,
}


def register_views(
    spark: SparkSession, curated: dict[str, DataFrame], report: DataFrame, index: DataFrame, context: DataFrame
) -> list[str]:
    """Temp views for SQL users: the eight `vw_*` and `analytics_run_context`."""
    frames = {name: build(curated) for name, build in VIEWS.items()}
    frames["vw_quality_reconciliation"] = quality_reconciliation_view(report)
    frames["vw_quality_exceptions"] = quality_exceptions_view(index)
    frames["analytics_run_context"] = context
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
    return sorted(frames)
