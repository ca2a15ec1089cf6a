"""Reconciliation of every published table with its source, exception index and quality gate."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerspan.functions.numbers import EXACT_SUM
from ledgerspan.operators.reshape import date_spine, key_set_comparison, union_all
from ledgerspan.plans.curated.calendar import covered_dates
from ledgerspan.plans.curated.categories import category_codes
from ledgerspan.plans.curated.resolution import ERRORS


@dataclass(frozen=True)
class Control:
    """A published table, its source, its exceptions, and the money that must add up."""

    entity: str
    source: str
    exceptions: str
    business_key: str
    money: str | None = None


# The six direct controls.
DIRECT_CONTROLS = (
    Control("dim_supplier", "stg_empresas", "dim_supplier_resolution_exceptions", "cnpj"),
    Control("dim_contract", "stg_contratos", "dim_contract_resolution_exceptions", "contract_id"),
    Control("fact_spending", "stg_pagamentos", "fact_spending_exceptions", "payment_id", "payment_value"),
    Control("fact_rfi", "stg_homologacoes_risco", "fact_rfi_exceptions", "risk_assessment_id"),
    Control("fact_renewal", "stg_aditamentos", "fact_renewal_exceptions", "amendment_id", "amendment_value"),
    Control(
        "fact_supplier_financial", "stg_empresas_financial", "fact_supplier_financial_exceptions",
        "financial_snapshot_key", "gross_revenue",
    ),
)
REPORT_COLUMNS = (
    "entity", "reconciliation_type", "source_table", "curated_table", "exception_table",
    "source_row_count", "published_row_count", "exception_row_count", "match_rate", "row_count_delta",
    "source_monetary_total", "curated_monetary_total", "exception_monetary_total", "monetary_delta",
    "is_row_count_reconciled", "is_monetary_reconciled",
)
INDEX_COLUMNS = (
    "batch_id", "entity", "exception_file", "business_key_type", "business_key", "exception_cause",
    "source_file", "source_row_number", "load_date", "source_batch_id",
)


@dataclass(frozen=True)
class Thresholds:
    min_match_rate: float = 0.95
    financial_tolerance: Decimal = Decimal("0.00")


class QualityGateError(ValueError):
    """The batch is written, but at least one entity does not meet its thresholds."""


def match_rate(published: Column, source: Column) -> Column:
    return F.when(source == 0, F.lit(1.0)).otherwise(published.cast("double") / source.cast("double"))


SOURCE, PUBLISHED, REJECTED = "s", "p", "x"  # sides of a control


def side_rows(entity: str, df: DataFrame, side: Column | str, money: str | None) -> DataFrame:
    """(entity, side, n, m) of the rows of one side, or of several where `side` is a column."""
    tag = F.lit(side) if isinstance(side, str) else side
    value = F.col(money) if money else F.lit(None)
    return df.select(F.lit(entity).alias("entity"), tag.alias("side"), F.lit(1).cast("bigint").alias("n"), value.cast(EXACT_SUM).alias("m"))


def known_side(spark: SparkSession, entity: str, side: str, rows: int, total: Decimal | str | None = None) -> DataFrame:
    """A side whose rows and total are known already, from the write that made it."""
    return spark.range(1).select(
        F.lit(entity).alias("entity"), F.lit(side).alias("side"), F.lit(rows).cast("bigint").alias("n"), F.lit(None if total is None else str(total)).cast(EXACT_SUM).alias("m")
    )


def resolved_rows(control: Control, resolved: DataFrame) -> DataFrame:
    """Published and rejected rows of a table in one scan of it."""
    return side_rows(control.entity, resolved, F.when(F.col(ERRORS) == "", PUBLISHED).otherwise(REJECTED), control.money)


def direct_controls(sides: list[DataFrame], controls: Sequence[Control] = DIRECT_CONTROLS) -> DataFrame:
    """One report row per control, from one aggregate over all rows of all sides."""
    spark = sides[0].sparkSession
    zero = [F.struct(F.lit(c.entity).alias("entity"), F.lit(SOURCE).alias("side"), F.lit(0).cast("bigint").alias("n"), F.lit(0 if c.money else None).cast(EXACT_SUM).alias("m")) for c in controls]
    every = union_all([spark.range(1).select(F.inline(F.array(*zero))), *sides])
    here = lambda value, side: F.sum(F.when(F.col("side") == side, F.col(value)))
    names = [F.lit(x) for c in controls for x in (c.entity, c.source)]
    rejects = [F.lit(x) for c in controls for x in (c.entity, c.exceptions)]
    with_money = F.col("entity").isin(*[c.entity for c in controls if c.money])
    sums = {f"n{s}": F.coalesce(here("n", s), F.lit(0)) for s in (SOURCE, PUBLISHED, REJECTED)} | {f"m{s}": here("m", s) for s in (SOURCE, PUBLISHED, REJECTED)}
    rows = every.groupBy("entity").agg(*[c.alias(n) for n, c in sums.items()])
    rows = rows.withColumns({m: F.when(with_money, F.coalesce(F.col(m), F.lit(0)).cast(EXACT_SUM)) for m in ("ms", "mp", "mx")})
    rows = rows.withColumn("md", (F.col("ms") - F.col("mp") - F.col("mx")).cast(EXACT_SUM))
    return rows.select(
        "entity",
        F.lit("direct").alias("reconciliation_type"),
        F.element_at(F.create_map(*names), F.col("entity")).alias("source_table"),
        F.col("entity").alias("curated_table"),
        F.element_at(F.create_map(*rejects), F.col("entity")).alias("exception_table"),
        F.col("ns").alias("source_row_count"),
        F.col("np").alias("published_row_count"),
        F.col("nx").alias("exception_row_count"),
        match_rate(F.col("np"), F.col("ns")).alias("match_rate"),
        (F.col("ns") - F.col("np") - F.col("nx")).alias("row_count_delta"),
        F.col("ms").cast("string").alias("source_monetary_total"),
        F.col("mp").cast("string").alias("curated_monetary_total"),
        F.col("mx").cast("string").alias("exception_monetary_total"),
        F.col("md").cast("string").alias("monetary_delta"),
        (F.col("ns") == F.col("np") + F.col("nx")).alias("is_row_count_reconciled"),
        F.coalesce(F.col("md") == 0, F.lit(True)).alias("is_monetary_reconciled"),
    )


def direct_control(control: Control, source: DataFrame, published: DataFrame, rejected: DataFrame) -> DataFrame:
    """One report row of tables that are kept apart."""
    sides = zip((source, published, rejected), (SOURCE, PUBLISHED, REJECTED))
    return direct_controls([side_rows(control.entity, df, side, control.money) for df, side in sides], [control])


def derived_control(
    entity: str, source_table: str, expected: DataFrame, actual: DataFrame, key: str
) -> DataFrame:
    """Expected against actual key set of a derived dimension, one report row."""
    sizes = key_set_comparison(expected, actual, key)
    exp, act, common = (F.col(c) for c in ("expected_count", "actual_count", "common_count"))
    none = F.lit(None).cast("string")
    return sizes.select(
        F.lit(entity).alias("entity"),
        F.lit("derived").alias("reconciliation_type"),
        F.lit(source_table).alias("source_table"),
        F.lit(entity).alias("curated_table"),
        none.alias("exception_table"),
        exp.alias("source_row_count"),
        act.alias("published_row_count"),
        F.lit(0).cast("bigint").alias("exception_row_count"),
        match_rate(common, exp).alias("match_rate"),
        (exp - act).alias("row_count_delta"),
        none.alias("source_monetary_total"),
        none.alias("curated_monetary_total"),
        none.alias("exception_monetary_total"),
        none.alias("monetary_delta"),
        ((exp == common) & (act == common)).alias("is_row_count_reconciled"),
        F.lit(True).alias("is_monetary_reconciled"),
    )


def derived_controls(staged: dict[str, DataFrame], curated: dict[str, DataFrame]) -> list[DataFrame]:
    """Groups, categories and calendar. Load dates do not count as business dates here."""
    return [
        derived_control(
            "dim_economic_group", "dim_supplier", curated["dim_supplier"], curated["dim_economic_group"],
            "economic_group_key",
        ),
        derived_control(
            "dim_category", "stg_contratos + stg_pagamentos",
            category_codes(staged["contracts"], staged["payments"]), curated["dim_category"], "category_code",
        ),
        derived_control(
            "dim_calendar", "stagings do lote",
            date_spine(covered_dates(staged, with_load_date=False)), curated["dim_calendar"], "calendar_date",
        ),
    ]


def reconciliation_report(sources: list[DataFrame], staged: dict[str, DataFrame], curated: dict[str, DataFrame], resolved: dict[str, DataFrame]) -> DataFrame:
    """Nine control rows; `sources` are source sides of the direct controls, `resolved` by entity hold published and rejected rows."""
    direct = direct_controls([*sources, *[resolved_rows(c, resolved[c.entity]) for c in DIRECT_CONTROLS]])
    return union_all([direct, *derived_controls(staged, curated)])


def apply_thresholds(report: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    tolerance = F.lit(limits.financial_tolerance)
    beyond = F.abs(F.col("monetary_delta").try_cast(EXACT_SUM)) > tolerance
    reasons = F.concat_ws(
        "; ",
        F.when(~F.col("is_row_count_reconciled"), "contagem não reconciliada"),
        F.when(F.col("match_rate") < limits.min_match_rate, "match rate abaixo do limiar"),
        F.when(~F.col("is_monetary_reconciled") & beyond, "diferença financeira acima da tolerância"),
    )
    return report.withColumn("failure_reasons", reasons).select(
        *report.columns,
        F.when(F.col("failure_reasons") == "", "approved").otherwise("failed").alias("status"),
        "failure_reasons",
    )


def exception_index(rejected: dict[str, DataFrame], batch_id: str) -> DataFrame:
    """Every rejected row of the six exception tables in one shape: key, cause, lineage."""
    def shaped(control: Control) -> DataFrame:
        rows = rejected[control.exceptions]
        present = set(rows.columns)
        lineage = {"source_file": "string", "source_row_number": "bigint", "load_date": "date"}
        optional = [
            (F.col(c) if c in present else F.lit(None)).cast(t).alias(c) for c, t in lineage.items()
        ]
        own_batch = (F.col("batch_id") if "batch_id" in present else F.lit(None)).cast("string")
        return rows.select(
            F.lit(batch_id).alias("batch_id"),
            F.lit(control.entity).alias("entity"),
            F.lit(f"{control.exceptions}_{batch_id}.parquet").alias("exception_file"),
            F.lit(control.business_key).alias("business_key_type"),
            F.col(control.business_key).cast("string").alias("business_key"),
            F.col(ERRORS).alias("exception_cause"),
            *optional,
            own_batch.alias("source_batch_id"),
        )

    return union_all([shaped(c) for c in DIRECT_CONTROLS]).select(*INDEX_COLUMNS)


def failed_entities(report: DataFrame) -> list[str]:
    """Names of failed entities; the report has nine rows, so this is a bounded collect."""
    return [r.entity for r in report.where(F.col("status") == "failed").select("entity").collect()]


def enforce_gate(report: DataFrame) -> None:
    """Raise after the report is written when an entity failed."""
    failed = failed_entities(report)
    if failed:
        raise QualityGateError(f"Quality gate reprovado: {', '.join(failed)}.")


def coverage(name: str, source: DataFrame, published: DataFrame, rejected: DataFrame, factor: int = 1) -> DataFrame:
    """source rows (times `factor`) = published rows + exceptions."""
    control = Control(name, "", "", "")
    row = direct_control(control, source, published, rejected)
    return row.select(
        "entity",
        (F.col("source_row_count") * factor).alias("source_row_count"),
        F.col("published_row_count").alias("fact_row_count"),
        "exception_row_count",
        (F.col("source_row_count") * factor == F.col("published_row_count") + F.col("exception_row_count")).alias("is_reconciled"),
    )


def require_reconciled(report: DataFrame) -> None:
    """Raise when a control of one row (`is_..._reconciled` columns) fails."""
    row = report.first().asDict()
    failed = [name for name, value in row.items() if name.startswith("is_") and name.endswith("reconciled") and not value]
    if failed:
        numbers = ", ".join(f"{k}={v}" for k, v in row.items() if not k.startswith("is_"))
        raise QualityGateError(f"Publicação recusada ({', '.join(failed)}): {numbers}.")


def spending_reconciliation(payments: DataFrame, fact: DataFrame, rejected: DataFrame) -> DataFrame:
    """Rows and cents of payments against fact plus exceptions."""
    control = Control("fact_spending", "stg_pagamentos", "fact_spending_exceptions", "payment_id", "payment_value")
    row = direct_control(control, payments, fact, rejected)
    return row.select(
        "source_row_count",
        F.col("published_row_count").alias("fact_row_count"),
        "exception_row_count",
        F.col("source_monetary_total").alias("source_payment_value"),
        F.col("curated_monetary_total").alias("fact_payment_value"),
        F.col("exception_monetary_total").alias("exception_payment_value"),
        "is_row_count_reconciled",
        F.col("is_monetary_reconciled").alias("is_payment_value_reconciled"),
    )


def snapshot_integrity(
    companies: DataFrame, contracts: DataFrame, amendments: DataFrame, payments: DataFrame
) -> DataFrame:
    """Six checks on a whole RAW snapshot: three references and three unique ids, with violations.

    Every table is read once: its keys go into one tagged union, and one aggregate counts for each key how
    often its owner has it and how often others refer to it. A null key refers to nothing.
    """
    contract, company, payment = "Cód_Contrato", "CNPJ", "Cód_Pagamento"

    def keys(df: DataFrame, *uses: tuple[str, str, str]) -> DataFrame:
        """Each use is a kind of key, its column and whether the table owns it or refers to it."""
        used = [F.struct(F.lit(kind).alias("kind"), F.col(f"`{c}`").cast("string").alias("key"), F.lit(role).alias("role")) for kind, c, role in uses]
        return df.select(F.inline(F.array(*used)))

    tagged = union_all(
        [
            keys(companies, ("company", company, "owner")),
            keys(contracts, ("contract", contract, "owner"), ("company", company, "contracts")),
            keys(amendments, ("contract", contract, "amendments")),
            keys(payments, ("payment", payment, "owner"), ("contract", contract, "payments")),
        ]
    )
    count = lambda role: F.count_if(F.col("role") == role).alias(role)
    per_key = tagged.groupBy("kind", "key").agg(*[count(r) for r in ("owner", "contracts", "amendments", "payments")])
    lost = (F.col("owner") == 0) | F.col("key").isNull()
    refers = lambda role: F.coalesce(F.sum(F.when(lost, F.col(role))), F.lit(0))
    repeated = lambda kind: F.count_if((F.col("kind") == kind) & (F.col("owner") > 1))
    checks = {
        "contratos sem fornecedor": refers("contracts"),
        "aditamentos sem contrato": refers("amendments"),
        "pagamentos sem contrato": refers("payments"),
        "empresas duplicadas": repeated("company"),
        "contratos duplicados": repeated("contract"),
        "pagamentos duplicados": repeated("payment"),
    }
    totals = per_key.agg(*[c.alias(f"c{i}") for i, c in enumerate(checks.values())])
    rows = F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(f"c{i}").alias("violations")) for i, n in enumerate(checks)])
    return totals.select(F.inline(rows)).select("check_name", "violations", (F.col("violations") == 0).alias("passed"))
