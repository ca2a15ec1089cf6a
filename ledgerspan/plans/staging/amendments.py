"""Amendments: renewals and top-ups (grain: derived amendment_id)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerspan.functions.dates import lenient_date
from ledgerspan.functions.numbers import amendment_id, lenient_double, money
from ledgerspan.functions.text import CONTRACT_ID_FORMAT, code, enum_slug
from ledgerspan.operators.intervals import flag_contained
from ledgerspan.operators.lookup import flag_member_unique
from ledgerspan.operators.narrow import with_flags
from ledgerspan.operators.rules import Rule, annotate_met, formatted, one_of, parsed, positive, required, valid_alone, valid_by_flags, with_alone
from ledgerspan.operators.uniqueness import flag_repeated
from ledgerspan.sources.raw import conform

# Kinds of amendment.
RENEWAL, TOP_UP = "renovacao", "aporte"


def normalize_amendments(raw: DataFrame) -> DataFrame:
    rows = conform(raw, "amendments").withColumns(
        {
            "contract_id": code("contract_id"),
            "amendment_type": enum_slug("amendment_type"),
            "validity_start_date": lenient_date("validity_start_date"),
            "validity_end_date": lenient_date("validity_end_date"),
            "amendment_value": money("amendment_value"),
            "amendment_sequence": lenient_double("amendment_sequence"),
        }
    )
    return rows.withColumn("amendment_id", amendment_id("contract_id", "amendment_sequence"))


def row_rules() -> list[Rule]:
    start, end, sequence = (F.col(c) for c in ("validity_start_date", "validity_end_date", "amendment_sequence"))
    return [
        required("contract_id"),
        formatted("contract_id", CONTRACT_ID_FORMAT, "contract_id deve seguir o padrão CS########"),
        Rule((F.col("contract_id") != "") & ~F.col("__known"), "contract_id não encontrado em stg_contratos", True),
        one_of("amendment_type", (RENEWAL, TOP_UP)),
        parsed("validity_start_date", "ausente ou inválida"),
        parsed("validity_end_date", "ausente ou inválida"),
        Rule(start > end, "vigência inicial posterior à final"),
        parsed("amendment_value"),
        positive("amendment_value"),
        parsed("amendment_sequence", "ausente ou inválida"),
        Rule(sequence % 1 != 0, "amendment_sequence deve ser inteira"),
        positive("amendment_sequence", "deve ser positiva"),
        Rule(F.col("__repeated"), "evento de aditamento duplicado", True),
    ]


def flag_inside_renewal(rows: DataFrame, flag: str = "__inside", among: DataFrame | None = None) -> DataFrame:
    """Top-ups whose window lies inside one renewal; rows with unusable dates take no part."""
    usable = F.col("validity_start_date") <= F.col("validity_end_date")
    return flag_contained(
        rows,
        "contract_id",
        "validity_start_date",
        "validity_end_date",
        inner=usable & (F.col("amendment_type") == TOP_UP),
        outer=usable & (F.col("amendment_type") == RENEWAL),
        flag=flag,
        among=among,
    )


def flag_copies(rows: DataFrame, among: DataFrame | None = None) -> DataFrame:
    exempt = (F.col("contract_id") == "") | F.col("amendment_sequence").isNull()
    return flag_repeated(rows, ["contract_id", "amendment_sequence"], "__repeated", exempt=exempt, among=among)


def all_rules() -> list[Rule]:
    usable = F.col("validity_start_date") <= F.col("validity_end_date")
    outside = (F.col("amendment_type") == TOP_UP) & usable & ~F.col("__inside")
    return [*row_rules(), Rule(outside, "aporte fora da vigência de uma renovação", True)]


def stage_amendments(raw: DataFrame, valid_contracts: DataFrame) -> DataFrame:
    """Normalised amendments with `validation_errors`; `valid_contracts` has unique contract_id."""
    def flagged(rows: DataFrame) -> DataFrame:
        rows = flag_copies(flag_inside_renewal(rows))
        return flag_member_unique(rows, "contract_id", valid_contracts, "contract_id", "__known")

    columns = ["contract_id", "amendment_type", "validity_start_date", "validity_end_date", "amendment_sequence"]
    rows = with_flags(with_alone(normalize_amendments(raw), all_rules()), columns, flagged, {"__inside": False, "__repeated": False, "__known": True})
    return annotate_met(rows, all_rules()).drop("__known", "__repeated", "__inside")


def valid_amendments(raw: DataFrame, valid_contracts: DataFrame) -> DataFrame:
    """The rows that `stage_amendments` accepts. Those valid by themselves move to their contracts, of these the ones
    with a contract to the repeated events, and what is left to the renewals."""
    every = normalize_amendments(raw)
    rows = flag_member_unique(valid_alone(every, all_rules()), "contract_id", valid_contracts, "contract_id", "__known")
    rows = flag_copies(rows.where("__known"), every)
    rows = flag_inside_renewal(rows.where("NOT __repeated"), among=every)
    return valid_by_flags(rows, all_rules()).drop("__known", "__repeated", "__inside")
