"""Risk scoring of companies: yearly inputs, points, rating and approval outcome."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from ledgerspan.functions.numbers import RISK_LABEL_ORDER, highest_risk, round4
from ledgerspan.operators.reshape import unpivot_years
from ledgerspan.plans.staging.companies import YEARS

# Thresholds of the scoring model.
INTEREST_POINTS = ((0.045, 2), (0.025, 1))
TREND_POINTS = ((-0.08, 2), (0.0, 1))
MARGIN_POINTS = ((0.03, 2), (0.08, 1))
DECLINING = "Em decadência"
FINANCIAL_LEVELS = ((4, "Alto"), (2, "Médio"))
LABOR_LEVELS = ((8, "Alto"), (3, "Médio"))
LOWEST = "Baixo"
RATING_BY_POINTS = ("AAA", "AA", "A", "BBB", "BB", "B", "CCC", "CC")
APPROVAL_MONTHS = 48
SIZE_BANDS = ((360_000, "Microempresa"), (3_600_000, "Pequeno"), (10_000_000, "Médio"))
LARGEST = "Grande"
STAGE_BANDS = ((7, "Jovem"), (15, "Em crescimento"), (35, "Madura"))
OLDEST = "Consolidada"


def _first_match(cases: list[tuple[Column, object]], default) -> Column:
    (condition, value), *rest = cases
    chain = F.when(condition, F.lit(value))
    for condition, value in rest:
        chain = chain.when(condition, F.lit(value))
    return chain.otherwise(F.lit(default))


def risk_inputs(companies: DataFrame) -> DataFrame:
    """Unrounded yearly inputs per company; last year's revenue comes from the same wide row."""
    rows = unpivot_years(
        companies,
        ["cnpj", "cenario_financeiro", "processos_trabalhistas", "num_total_func"],
        {"faturamento": "revenue", "juros_divida": "interest", "lucro_liquido": "net_income"},
        YEARS,
        previous={"faturamento": "previous_revenue"},
    )
    revenue = F.nullif(F.col("revenue"), F.lit(0.0))
    previous = F.nullif(F.col("previous_revenue"), F.lit(0.0))
    staff = F.greatest(F.col("num_total_func").cast("double"), F.lit(1.0))
    return rows.select(
        "cnpj",
        "financial_year",
        "cenario_financeiro",
        (F.col("interest") / revenue).alias("interest_to_revenue_ratio"),
        F.when(F.col("financial_year") == YEARS[0], F.lit(0.0))
        .otherwise(F.col("revenue") / previous - 1)
        .alias("revenue_trend"),
        (F.col("net_income") / revenue).alias("net_margin"),
        (F.col("processos_trabalhistas").cast("double") / staff * 100).alias("labor_cases_index"),
    )


def rounded_inputs(inputs: DataFrame) -> DataFrame:
    """Published precision: four places. Scoring itself uses the unrounded inputs."""
    names = ("interest_to_revenue_ratio", "revenue_trend", "net_margin", "labor_cases_index")
    return inputs.withColumns({n: round4(F.col(n)) for n in names})


def financial_points() -> Column:
    interest, trend, margin = (
        F.col(c) for c in ("interest_to_revenue_ratio", "revenue_trend", "net_margin")
    )
    return (
        _first_match([(interest >= t, p) for t, p in INTEREST_POINTS], 0)
        + _first_match([(trend <= t, p) for t, p in TREND_POINTS], 0)
        + _first_match([(margin <= t, p) for t, p in MARGIN_POINTS], 0)
        + _first_match([(F.col("cenario_financeiro") == DECLINING, 1)], 0)
    )


def financial_risk(points: Column) -> Column:
    return _first_match([(points >= t, level) for t, level in FINANCIAL_LEVELS], LOWEST)


def labor_risk(cases_per_100: Column) -> Column:
    return _first_match([(cases_per_100 > t, level) for t, level in LABOR_LEVELS], LOWEST)


def credit_rating(points: Column) -> Column:
    ratings = F.array(*[F.lit(r) for r in RATING_BY_POINTS])
    return F.element_at(ratings, F.least(points, F.lit(len(RATING_BY_POINTS) - 1)).cast("int") + 1)


def score(inputs: DataFrame) -> DataFrame:
    scored = inputs.withColumn("financial_points", financial_points().cast("bigint"))
    return scored.withColumns(
        {
            "financial_risk": financial_risk(F.col("financial_points")),
            "labor_risk": labor_risk(F.col("labor_cases_index")),
            "credit_rating": credit_rating(F.col("financial_points")),
        }
    ).withColumn("final_risk", highest_risk("financial_risk", "labor_risk", RISK_LABEL_ORDER))


def approval_outcome(scored: DataFrame, reference: date) -> DataFrame:
    """Assessed on 1 January; approved for four years unless the final risk is high."""
    assessed = F.make_date("financial_year", F.lit(1), F.lit(1))
    approved = F.col("final_risk") != "Alto"
    expires = F.when(approved, F.date_sub(F.add_months(assessed, APPROVAL_MONTHS), 1))
    return scored.withColumns(
        {
            "assessment_date": assessed,
            "homologation_result": F.when(approved, "Aprovada").otherwise("Reprovada"),
            "expiration_date": expires,
            "homologation_status": F.when(~approved, "Negada")
            .when(expires < F.lit(reference), "Expirada")
            .otherwise("Ativa"),
        }
    )


def company_size(revenue: Column) -> Column:
    return _first_match([(revenue < limit, name) for limit, name in SIZE_BANDS], LARGEST)


def company_stage(age: Column) -> Column:
    return _first_match([(age <= limit, name) for limit, name in STAGE_BANDS], OLDEST)
