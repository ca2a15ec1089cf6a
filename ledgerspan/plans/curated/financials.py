"""`fact_supplier_financial`: one row per legal entity and fiscal year."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerspan.functions.text import prefixed_key
from ledgerspan.operators.lookup import calendar_roles
from ledgerspan.operators.reshape import unpivot_years
from ledgerspan.operators.rules import Rule, annotate, not_negative, parsed
from ledgerspan.operators.uniqueness import flag_repeated
from ledgerspan.plans.curated.resolution import ERRORS, missing, with_supplier
from ledgerspan.plans.staging.companies import YEARS
from ledgerspan.sources.raw import LINEAGE

# Yearly measure in the source -> published measure.
MEASURES = {
    "faturamento": "gross_revenue",
    "custo": "total_cost",
    "custo_folha": "payroll_cost",
    "lucro_bruto": "gross_profit",
    "juros_divida": "debt_interest",
    "lucro_liquido": "net_income",
}
ORDERED_MEASURES = (
    ("payroll_cost", "total_cost"),
    ("total_cost", "gross_revenue"),
    ("gross_profit", "gross_revenue"),
    ("net_income", "gross_profit"),
)
FINANCIAL_COLUMNS = (
    "financial_snapshot_key", "supplier_key", "economic_group_key", "financial_period_calendar_key",
    "financial_year", *MEASURES.values(), *LINEAGE,
)


def yearly_figures(companies: DataFrame) -> DataFrame:
    kept = ("cnpj", *[c for c in LINEAGE if c in companies.columns])
    rows = unpivot_years(companies, kept, MEASURES, YEARS)
    return rows.withColumns(
        {
            "financial_period_end_date": F.make_date("financial_year", F.lit(12), F.lit(31)),
            "financial_snapshot_key": prefixed_key("FIN-", "cnpj", "financial_year"),
        }
    )


def expected_revenue(companies: DataFrame) -> DataFrame:
    """Key and revenue of every company-year for reconciliation; empty without the yearly columns."""
    needed = {"cnpj", *[f"faturamento_{y}" for y in YEARS]}
    if not needed.issubset(companies.columns):
        return companies.sparkSession.createDataFrame([], "financial_snapshot_key string, gross_revenue double")
    rows = unpivot_years(companies, ["cnpj"], {"faturamento": "gross_revenue"}, YEARS)
    return rows.select(
        prefixed_key("FIN-", "cnpj", "financial_year").alias("financial_snapshot_key"), "gross_revenue"
    )


def measure_rules() -> list[Rule]:
    rules = [
        r
        for c in MEASURES.values()
        for r in (parsed(c, "ausente ou inválida"), not_negative(c, "não pode ser negativa"))
    ]
    return rules + [Rule(F.col(a) > F.col(b), f"{a} maior que {b}") for a, b in ORDERED_MEASURES]


def resolve_financials(companies: DataFrame, suppliers: DataFrame, calendar: DataFrame) -> DataFrame:
    salt = ("source_file", "source_row_number", "financial_year")
    rows = flag_repeated(yearly_figures(companies), ["financial_snapshot_key"], "__repeated", salt_on=salt)
    rows = with_supplier(rows, suppliers, "cnpj")
    rows = calendar_roles(rows, calendar, ["financial_period_end_date"])
    rules = [
        Rule(F.col("__repeated"), "financial_snapshot_key duplicada na fonte curated"),
        missing("supplier_key", "cnpj", "dim_supplier"),
        missing("financial_period_end_calendar_key", "financial_period_end_date", "dim_calendar"),
        *measure_rules(),
    ]
    return (
        annotate(rows, rules, ERRORS)
        .drop("__repeated")
        .withColumnRenamed("financial_period_end_calendar_key", "financial_period_calendar_key")
    )
