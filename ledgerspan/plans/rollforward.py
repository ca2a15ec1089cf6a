"""Moving a snapshot forward: expiries, closures, reassessments, new rows with free ids."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from ledgerspan.operators.intervals import as_of_in_year
from ledgerspan.operators.lookup import remap
from ledgerspan.operators.ordering import dense_positions
from ledgerspan.operators.uniqueness import latest_per_key

# Fixed value: reason written on contracts that are closed by a refused assessment.
CLOSURE_REASON = "Homologação negada por risco final alto"


def risk_as_of(events: DataFrame, assessments: DataFrame, event_date: str) -> DataFrame:
    """Assessment that applies to each event of a supplier: same year first, else the latest before."""
    return as_of_in_year(
        events,
        assessments,
        key="supplier_cnpj",
        event_date=event_date,
        fact_key="supplier_cnpj",
        fact_date="assessment_date",
        tie="risk_assessment_id",
        columns={
            "risk_assessment_id": "as_of_assessment_id",
            "assessment_date": "as_of_assessment_date",
            "homologation_result": "as_of_result",
            "final_risk": "as_of_final_risk",
        },
    )


def close_unapproved(contracts: DataFrame, assessments: DataFrame, reference: date) -> DataFrame:
    """Running contracts that aren't closed yet and whose supplier has no current approval end the day
    before `reference`.

    The assessment is looked up once per supplier (all contracts share the reference date), so a
    supplier with many contracts costs one lookup.
    """
    suppliers = contracts.select("supplier_cnpj").distinct().withColumn("__today", F.lit(reference))
    current = risk_as_of(suppliers, assessments, "__today").select(
        F.col("supplier_cnpj").alias("__supplier"), "as_of_result", "as_of_assessment_date", "as_of_final_risk"
    )
    rows = contracts.join(current, F.col("supplier_cnpj") == F.col("__supplier"), "left").drop("__supplier")
    running = (F.col("contract_status") != "encerrado") & (F.col("validity_end_date") >= F.lit(reference))
    refused = F.coalesce(F.col("as_of_result") != "aprovada", F.lit(True))
    closed = F.coalesce(running & refused, F.lit(False))
    updates: dict[str, Column] = {
        "contract_status": F.lit("encerrado"),
        "validity_end_date": F.date_sub(F.lit(reference), 1),
        "risk_evaluation_date": F.col("as_of_assessment_date"),
        "final_risk": F.coalesce("as_of_final_risk", "final_risk"),
        "closure_reason": F.lit(CLOSURE_REASON),
    }
    flagged = rows.withColumn("__closed", closed)
    return flagged.withColumns(
        {name: F.when(F.col("__closed"), value).otherwise(F.col(name)) for name, value in updates.items()}
    ).drop("__closed", "as_of_result", "as_of_assessment_date", "as_of_final_risk")


def expire_assessments(assessments: DataFrame, reference: date) -> DataFrame:
    """Approved assessments that ran out before `reference` become expired."""
    over = (F.col("homologation_result") == "aprovada") & (F.col("expiration_date") < F.lit(reference))
    return assessments.withColumn(
        "homologation_status", F.when(over, "expirada").otherwise(F.col("homologation_status"))
    )


def expire_contracts(contracts: DataFrame, reference: date) -> DataFrame:
    over = (F.col("contract_status") == "ativo") & (F.col("validity_end_date") < F.lit(reference))
    return contracts.withColumn("contract_status", F.when(over, "vencido").otherwise(F.col("contract_status")))


def reassessment_candidates(assessments: DataFrame) -> DataFrame:
    """Latest expired approval of each supplier."""
    expired = assessments.where(
        (F.col("homologation_result") == "aprovada") & (F.col("homologation_status") == "expirada")
    )
    return latest_per_key(expired, ["supplier_cnpj"], "assessment_date", "risk_assessment_id")


def highest_number(df: DataFrame, column: str) -> DataFrame:
    """Largest numeric suffix of an id, one row; 0 when there is none."""
    suffix = F.regexp_extract(F.coalesce(column, F.lit("")), r"(\d+)$", 1).try_cast("bigint")
    return df.agg(F.coalesce(F.max(suffix), F.lit(0)).alias("highest_number"))


def renumber(
    new: DataFrame, current: DataFrame, column: str, prefix: str, digits: int, *order: str
) -> DataFrame:
    """Give `new` rows ids after the highest of `current`, in the given order.

    `<column>` gets the new id and `old_<column>` keeps the one it had, so dependants can be remapped.
    """
    start = highest_number(current, column).scalar()
    placed = dense_positions(new, *[F.col(c) for c in order], name="__n")
    number = F.col("__n") + start
    padded = F.when(F.length(number.cast("string")) > digits, number.cast("string")).otherwise(
        F.lpad(number.cast("string"), digits, "0")
    )
    return placed.withColumns(
        {f"old_{column}": F.col(column), column: F.concat(F.lit(prefix), padded)}
    ).drop("__n")


def remap_amendments(amendments: DataFrame, renumbered_contracts: DataFrame) -> DataFrame:
    return remap(amendments, "contract_id", renumbered_contracts, "old_contract_id", "contract_id")
