"""Payments (grain: payment_id)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerspan.functions.dates import lenient_date
from ledgerspan.functions.numbers import money
from ledgerspan.functions.text import (
    CNPJ_FORMAT, CNPJ_ROOT_FORMAT, CONTRACT_ID_FORMAT, COST_CENTER_FORMAT, PAYMENT_ID_FORMAT,
    code, digits_only, enum_slug, group_root, strip, strip_upper,
)
from ledgerspan.operators.lookup import flag_member_unique
from ledgerspan.operators.narrow import with_flags
from ledgerspan.operators.rules import Rule, annotate_met, formatted, parsed, positive, required, valid_alone, valid_by_flags, with_alone
from ledgerspan.operators.uniqueness import flag_repeated
from ledgerspan.sources.raw import conform


def normalize_payments(raw: DataFrame) -> DataFrame:
    rows = conform(raw, "payments").withColumns(
        {
            "payment_id": code("payment_id"),
            "contract_id": code("contract_id"),
            "supplier_cnpj": digits_only("supplier_cnpj"),
            "supplier_name": strip("supplier_name"),
            "payment_date": lenient_date("payment_date"),
            "payment_value": money("payment_value"),
            "cost_center": strip_upper("cost_center"),
            "payment_category": enum_slug("payment_category"),
        }
    )
    return rows.withColumn("supplier_cnpj8", group_root("supplier_cnpj"))


def payment_rules() -> list[Rule]:
    return [
        required("payment_id"),
        formatted("payment_id", PAYMENT_ID_FORMAT, "payment_id deve seguir o padrão PAG########"),
        Rule(F.col("__repeated"), "payment_id duplicado", True),
        required("contract_id"),
        formatted("contract_id", CONTRACT_ID_FORMAT, "contract_id deve seguir o padrão CS########"),
        Rule((F.col("contract_id") != "") & ~F.col("__known"), "contract_id não encontrado em stg_contratos", True),
        formatted("supplier_cnpj", CNPJ_FORMAT, "supplier_cnpj inválido"),
        formatted("supplier_cnpj8", CNPJ_ROOT_FORMAT, "supplier_cnpj8 inválido"),
        required("supplier_name"),
        parsed("payment_date", "ausente ou inválida"),
        parsed("payment_value"),
        positive("payment_value"),
        formatted("cost_center", COST_CENTER_FORMAT, "cost_center inválido"),
        required("payment_category"),
    ]


def flag_copies(rows: DataFrame, among: DataFrame | None = None) -> DataFrame:
    return flag_repeated(rows, ["payment_id"], "__repeated", exempt=F.col("payment_id") == "", among=among)


def stage_payments(raw: DataFrame, valid_contracts: DataFrame) -> DataFrame:
    """Normalised payments with `validation_errors`; `valid_contracts` has unique contract_id."""
    def flagged(rows: DataFrame) -> DataFrame:
        rows = flag_copies(rows)
        return flag_member_unique(rows, "contract_id", valid_contracts, "contract_id", "__known")

    rows = with_flags(with_alone(normalize_payments(raw), payment_rules()), ["payment_id", "contract_id"], flagged, {"__repeated": False, "__known": True})
    return annotate_met(rows, payment_rules()).drop("__known", "__repeated")


def valid_payments(raw: DataFrame, valid_contracts: DataFrame) -> DataFrame:
    """The rows that `stage_payments` accepts. Those valid by themselves move to their contracts, and of these the ones
    with a contract to the repeated ids."""
    every = normalize_payments(raw)
    rows = flag_member_unique(valid_alone(every, payment_rules()), "contract_id", valid_contracts, "contract_id", "__known")
    rows = flag_copies(rows.where("__known"), every)
    return valid_by_flags(rows, payment_rules()).drop("__known", "__repeated")
