"""Contracts: identity, dates, money and closure rules (grain: contract_id)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerspan.functions.dates import lenient_date
from ledgerspan.functions.numbers import money
from ledgerspan.functions.text import (
    CNPJ_FORMAT, CONTRACT_ID_FORMAT, code, digits_only, enum_slug, strip, strip_to_null,
)
from ledgerspan.operators.rules import Rule, annotate, formatted, not_negative, one_of, parsed, required, valid_alone, valid_by_flags
from ledgerspan.operators.uniqueness import flag_repeated
from ledgerspan.sources.raw import conform

# Accepted states of a contract.
STATUSES = ("ativo", "vencido", "encerrado")
TYPES = ("novo_contrato", "contrato_renovado")
MONEY_COLUMNS = ("original_value", "total_value", "balance_value")


def normalize_contracts(raw: DataFrame) -> DataFrame:
    return conform(raw, "contracts").withColumns(
        {
            "contract_id": code("contract_id"),
            "supplier_cnpj": digits_only("supplier_cnpj"),
            "contract_name": strip("contract_name"),
            "supplier_name": strip("supplier_name"),
            **{c: enum_slug(c) for c in ("contract_category", "contract_type", "contract_status", "final_risk")},
            "closure_reason": strip_to_null("closure_reason"),
            **{c: lenient_date(c) for c in ("validity_start_date", "validity_end_date", "risk_evaluation_date")},
            **{c: money(c) for c in MONEY_COLUMNS},
        }
    )


def identity_rules() -> list[Rule]:
    return [
        required("contract_id"),
        formatted("contract_id", CONTRACT_ID_FORMAT, "contract_id deve seguir o padrão CS########"),
        Rule(F.col("__repeated"), "contract_id duplicado", True),
        required("supplier_cnpj"),
        formatted("supplier_cnpj", CNPJ_FORMAT, "supplier_cnpj deve conter 14 dígitos"),
        *[required(c) for c in ("contract_name", "supplier_name", "contract_category", "final_risk")],
        one_of("contract_status", STATUSES),
        one_of("contract_type", TYPES),
    ]


def interval_rules() -> list[Rule]:
    return [
        parsed("validity_start_date", "ausente ou inválida"),
        parsed("validity_end_date", "ausente ou inválida"),
        Rule(F.col("validity_start_date") > F.col("validity_end_date"), "vigência inicial posterior à final"),
    ]


def money_rules() -> list[Rule]:
    rules = [r for c in MONEY_COLUMNS for r in (parsed(c), not_negative(c))]
    return rules + [
        Rule(F.col("total_value") < F.col("original_value"), "total_value não pode ser menor que original_value"),
        Rule(F.col("balance_value") > F.col("total_value"), "balance_value não pode superar total_value"),
    ]


def closure_rules() -> list[Rule]:
    closed, reason = F.col("contract_status") == "encerrado", F.col("closure_reason")
    return [
        Rule(closed & F.col("risk_evaluation_date").isNull(), "encerrado sem data de avaliação de risco"),
        Rule(closed & reason.isNull(), "encerrado sem motivo de encerramento"),
        Rule(~closed & reason.isNotNull(), "motivo de encerramento em contrato não encerrado"),
    ]


def all_rules() -> list[Rule]:
    return [*identity_rules(), *interval_rules(), *money_rules(), *closure_rules()]


def flag_copies(rows: DataFrame, among: DataFrame | None = None) -> DataFrame:
    return flag_repeated(rows, ["contract_id"], "__repeated", exempt=F.col("contract_id") == "", among=among)


def stage_contracts(raw: DataFrame) -> DataFrame:
    """Normalised contracts with `validation_errors`; one shuffle, for the repeated ids."""
    return annotate(flag_copies(normalize_contracts(raw)), all_rules()).drop("__repeated")


def valid_contracts(raw: DataFrame) -> DataFrame:
    """The rows that `stage_contracts` accepts."""
    every = normalize_contracts(raw)
    rows = flag_copies(valid_alone(every, all_rules()), every)
    return valid_by_flags(rows, all_rules()).drop("__repeated")
