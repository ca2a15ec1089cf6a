"""Supplier approval and risk assessments (grain: risk_assessment_id)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from ledgerspan.functions.dates import lenient_date
from ledgerspan.functions.numbers import RISK_ORDER, highest_risk, lenient_double
from ledgerspan.functions.text import (
    CNPJ_FORMAT, CNPJ_ROOT_FORMAT, RISK_ID_FORMAT, code, digits_only, enum_slug, group_root, member, strip_upper,
)
from ledgerspan.operators.rules import Rule, annotate, formatted, not_negative, one_of, parsed, required, valid_alone, valid_by_flags
from ledgerspan.operators.uniqueness import flag_repeated
from ledgerspan.sources.raw import conform

# Accepted states of an assessment.
RESULTS = ("aprovada", "reprovada")
STATUSES = ("ativa", "expirada", "negada")
RATINGS = ("AAA", "AA", "A", "BBB", "BB", "B", "CCC", "CC", "D")
SCORES = ("interest_to_revenue_ratio", "revenue_trend", "net_margin", "labor_cases_index")


def normalize_risk(raw: DataFrame) -> DataFrame:
    enums = ("homologation_result", "homologation_status", "financial_risk", "labor_risk", "final_risk")
    rows = conform(raw, "risk").withColumns(
        {
            "risk_assessment_id": code("risk_assessment_id"),
            "supplier_cnpj": digits_only("supplier_cnpj"),
            **{c: enum_slug(c) for c in enums},
            "credit_rating": strip_upper("credit_rating"),
            **{c: lenient_date(c) for c in ("assessment_date", "last_approval_date", "expiration_date")},
            **{c: lenient_double(c) for c in SCORES},
        }
    )
    return rows.withColumn("supplier_cnpj8", group_root("supplier_cnpj"))


def content_rules() -> list[Rule]:
    return [
        required("risk_assessment_id"),
        formatted("risk_assessment_id", RISK_ID_FORMAT, "risk_assessment_id deve seguir o padrão RSK#########"),
        Rule(F.col("__repeated"), "risk_assessment_id duplicado", True),
        required("supplier_cnpj"),
        formatted("supplier_cnpj", CNPJ_FORMAT, "supplier_cnpj deve conter 14 dígitos"),
        formatted("supplier_cnpj8", CNPJ_ROOT_FORMAT, "supplier_cnpj8 inválido"),
        parsed("assessment_date", "ausente ou inválida"),
        one_of("homologation_result", RESULTS),
        one_of("homologation_status", STATUSES),
        *[one_of(c, RISK_ORDER) for c in ("financial_risk", "labor_risk", "final_risk")],
        one_of("credit_rating", RATINGS),
        *[parsed(c) for c in SCORES],
        not_negative("interest_to_revenue_ratio"),
        not_negative("labor_cases_index"),
    ]


def derived_risk_rule() -> Rule:
    expected = highest_risk("financial_risk", "labor_risk")
    return Rule(
        expected.isNotNull() & (F.col("final_risk") != expected),
        "final_risk divergente dos riscos financeiro e trabalhista",
    )


def approval_rules() -> list[Rule]:
    """An approved assessment is dated and not high risk; a refused one is high risk and undated."""
    status, final = F.col("homologation_status"), F.col("final_risk")
    approved, expires = F.col("last_approval_date"), F.col("expiration_date")
    passed = F.col("homologation_result") == "aprovada"
    refused = F.col("homologation_result") == "reprovada"
    return [
        Rule(passed & ~member("homologation_status", ("ativa", "expirada")), "homologação aprovada com status inválido"),
        Rule(passed & (final == "alto"), "homologação aprovada com risco final alto"),
        Rule(passed & approved.isNull(), "homologação aprovada sem data de aprovação"),
        Rule(passed & expires.isNull(), "homologação aprovada sem data de expiração"),
        Rule(refused & (status != "negada"), "homologação reprovada com status inválido"),
        Rule(refused & (final != "alto"), "homologação reprovada sem risco final alto"),
        Rule(refused & approved.isNotNull(), "homologação reprovada com data de aprovação"),
        Rule(refused & expires.isNotNull(), "homologação reprovada com data de expiração"),
    ]


def chronology_rules() -> list[Rule]:
    approved, expires = F.col("last_approval_date"), F.col("expiration_date")
    return [
        Rule(approved > F.col("assessment_date"), "data de aprovação posterior à avaliação"),
        Rule(expires <= approved, "data de expiração anterior ou igual à aprovação"),
    ]


def reference_date_rules(reference: Column) -> list[Rule]:
    status, expires = F.col("homologation_status"), F.col("expiration_date")
    return [
        Rule((status == "ativa") & (expires < reference), "homologação ativa expirada na data de referência"),
        Rule(
            (status == "expirada") & (expires >= reference),
            "homologação expirada sem expiração na data de referência",
        ),
    ]


def all_rules(reference_date: date | None = None) -> list[Rule]:
    reference = F.lit(reference_date) if reference_date else F.col("load_date")
    return [
        *content_rules(),
        derived_risk_rule(),
        *approval_rules(),
        *chronology_rules(),
        *reference_date_rules(reference),
    ]


def flag_copies(rows: DataFrame, among: DataFrame | None = None) -> DataFrame:
    return flag_repeated(rows, ["risk_assessment_id"], "__repeated", exempt=F.col("risk_assessment_id") == "", among=among)


def stage_risk(raw: DataFrame, reference_date: date | None = None) -> DataFrame:
    """Normalised assessments with `validation_errors`.

    Without a reference date the load date of the row's own batch is used.
    """
    return annotate(flag_copies(normalize_risk(raw)), all_rules(reference_date)).drop("__repeated")


def valid_risk(raw: DataFrame, reference_date: date | None = None) -> DataFrame:
    """The rows that `stage_risk` accepts."""
    every, rules = normalize_risk(raw), all_rules(reference_date)
    rows = flag_copies(valid_alone(every, rules), every)
    return valid_by_flags(rows, rules).drop("__repeated")
