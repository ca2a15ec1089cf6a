"""One batch from a RAW snapshot to judged curated tables: a driver function over lazy plans.

Every table is written once and read back by the steps that need it, so no step recomputes another
one and a lost executor costs only the tasks it was running. Valid and rejected rows of a table are one write, parted
by `is_valid`; rows and money are observed on the way and serve the controls. All tables of a try lie below a
folder of its own, and the manifest of the run, written last, is what readers follow.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ledgerspan.operators.lookup import assert_unique
from ledgerspan.plans import curated as C, quality as Q, staging as S
from ledgerspan.plans.analytics.views import register_views
from ledgerspan.plans.curated.contracts import CONTRACT_COLUMNS
from ledgerspan.plans.curated.financials import FINANCIAL_COLUMNS, expected_revenue
from ledgerspan.plans.curated.renewals import RENEWAL_COLUMNS
from ledgerspan.functions.numbers import exact_sum
from ledgerspan.plans.curated.resolution import ERRORS
from ledgerspan.plans.curated.risk import RFI_COLUMNS
from ledgerspan.plans.curated.spending import SPENDING_COLUMNS
from ledgerspan.plans.curated.suppliers import SUPPLIER_COLUMNS, publish_names
from ledgerspan.session import tune
from ledgerspan.sources.published import (
    STAGING_SCHEMAS, VALID, attempt, exists, publish_json, publish_stage, read_json, read_split, read_table, run_context, typed, write_split, write_table,
)
from ledgerspan.sources.records import read_source
from ledgerspan.sources.snapshots import MANIFEST_NAMES, open_snapshot, source_paths

# Staging table of each source.
STAGING_TABLES = {
    "companies": "stg_empresas",
    "risk": "stg_homologacoes_risco",
    "contracts": "stg_contratos",
    "amendments": "stg_aditamentos",
    "payments": "stg_pagamentos",
}
CURATED_TABLES = (
    "dim_supplier", "dim_economic_group", "dim_calendar", "dim_category", "dim_contract", "fact_spending",
    "fact_rfi", "fact_renewal", "fact_supplier_financial",
)


# Columns of the tables whose rejected rows are kept beside them.
PUBLISHED_COLUMNS = {
    "dim_supplier": SUPPLIER_COLUMNS,
    "dim_contract": CONTRACT_COLUMNS,
    "fact_spending": SPENDING_COLUMNS,
    "fact_rfi": RFI_COLUMNS,
    "fact_renewal": RENEWAL_COLUMNS,
    "fact_supplier_financial": FINANCIAL_COLUMNS,
}
POINTER = "etl_manifest.json"
# Money that a source's control adds up.
STAGED_MONEY = {"payments": "payment_value", "amendments": "amendment_value"}


class Run:
    """The folder of one try at a run, the tables in it and their schemas."""

    def __init__(self, spark: SparkSession, folder: str, run_id: str, schemas: dict[str, T.StructType] | None = None):
        self.spark, self.folder, self.run_id, self.schemas = spark, folder, run_id, schemas or {}

    def path(self, layer: str, table: str) -> str:
        return f"{self.folder}/{layer}/{table}"

    def split(self, layer: str, table: str, valid: bool | None = None) -> DataFrame:
        return read_split(self.spark, self.path(layer, table), self.schemas[f"{layer}/{table}"], valid)

    def staged(self, source: str) -> DataFrame:
        table = STAGING_TABLES[source]
        rows = self.split("staging", table, True).drop("validation_errors")
        return typed(rows, table) if table in STAGING_SCHEMAS else rows

    def rejected_at_staging(self, source: str) -> DataFrame:
        return self.split("staging", STAGING_TABLES[source], False)

    def curated(self, table: str) -> DataFrame:
        if table in PUBLISHED_COLUMNS:
            return self.split("curated", table, True).select(*PUBLISHED_COLUMNS[table])
        return read_table(self.spark, self.path("curated", table))

    def rejected(self, table: str) -> DataFrame:
        return self.split("curated", table, False)

    def publish(self, table: str, rows: DataFrame, source: tuple[int, str | None] | None = None) -> None:
        """Write resolved and rejected rows of a table at once.

        With `source`, its rows and total, the stored rows must account for both, and what was observed by the write
        must be what is stored: one scan of the table. A failure ends the try, so nothing of it becomes visible.
        """
        money = {c.entity: c.money for c in Q.DIRECT_CONTROLS}[table]
        totals = {side: exact_sum(F.when(F.col(VALID) == flag, F.col(money))) for side, flag in (("valid total", True), ("invalid total", False))} if money else {}
        seen = write_split(rows, self.path("curated", table), F.col(ERRORS) == "", totals)
        self.schemas[f"curated/{table}"] = rows.schema
        if source is not None:
            control = next(c for c in Q.DIRECT_CONTROLS if c.entity == table)
            sides = [Q.known_side(self.spark, table, Q.SOURCE, *source), Q.resolved_rows(control, self.split("curated", table))]
            stored = Q.direct_controls(sides, [control])
            Q.require_reconciled(stored)
            row = stored.first()
            if (row["published_row_count"], row["exception_row_count"]) != (seen["valid"], seen["invalid"]):
                raise Q.QualityGateError(f"Publicação recusada: {table} tem {row['published_row_count']} linhas, escritas {seen['valid']}.")


def stage_all(run: Run, snapshot: str, manifest: dict) -> dict[str, dict]:
    batch, as_of = manifest["snapshot_id"], date.fromisoformat(manifest["as_of_date"])
    results = {}

    def stage(source: str, build) -> None:
        rows = build(read_source(run.spark, source_paths(snapshot, manifest)[source], load_date=as_of, batch_id=batch))
        table, money = STAGING_TABLES[source], STAGED_MONEY.get(source)
        results[MANIFEST_NAMES[source]] = publish_stage(
            rows,
            table,
            run.path("staging", table),
            source_file=manifest["sources"][MANIFEST_NAMES[source]]["path"].rsplit("/", 1)[-1],
            batch_id=batch,
            totals={money: exact_sum(F.when(F.col(VALID), F.col(money)))} if money else None,
        )
        run.schemas[f"staging/{table}"] = T.StructType.fromJson(results[MANIFEST_NAMES[source]].pop("stored_schema"))

    stage("companies", S.stage_companies)
    stage("risk", lambda raw: S.stage_risk(raw, as_of))
    stage("contracts", S.stage_contracts)
    contracts = run.staged("contracts")
    stage("amendments", lambda raw: S.stage_amendments(raw, contracts))
    stage("payments", lambda raw: S.stage_payments(raw, contracts))
    return results


def source_totals(run: Run, staging: dict[str, dict]) -> dict[str, tuple[int, str | None]]:
    """Rows and total of the source of every controlled table: as staging observed them, and of the yearly figures one scan."""
    yearly = expected_revenue(run.staged("companies")).agg(F.count("*").alias("n"), exact_sum("gross_revenue").cast("string").alias("m")).first()
    by_table = {STAGING_TABLES[s]: (staging[MANIFEST_NAMES[s]]["row_counts"]["valid"], staging[MANIFEST_NAMES[s]]["totals"].get(STAGED_MONEY.get(s))) for s in STAGING_TABLES}
    by_table["stg_empresas_financial"] = (yearly["n"], yearly["m"])
    return {c.entity: by_table[c.source] for c in Q.DIRECT_CONTROLS}


def publish_curated(run: Run, totals: dict[str, tuple[int, str | None]]) -> None:
    staged = {s: run.staged(s) for s in STAGING_TABLES}
    # Exceptions keep the staging name of the key; published rows carry the published one.
    resolved = C.resolve_suppliers(staged["companies"])
    suppliers = publish_names(resolved.withColumn("__cnpj", F.col("cnpj"))).withColumnRenamed("__cnpj", "cnpj")
    run.publish("dim_supplier", suppliers)
    supplier = run.curated("dim_supplier")
    write_table(C.economic_groups(supplier), run.path("curated", "dim_economic_group"))
    write_table(C.build_calendar(staged, check=True), run.path("curated", "dim_calendar"))
    write_table(C.build_categories(staged["contracts"], staged["payments"]), run.path("curated", "dim_category"))
    category, calendar = run.curated("dim_category"), run.curated("dim_calendar")
    assert_unique(supplier, "supplier_cnpj", "dim_supplier")
    assert_unique(category, "category_code", "dim_category")
    financials = C.resolve_financials(staged["companies"], supplier, calendar)
    run.publish("fact_supplier_financial", financials, totals["fact_supplier_financial"])
    run.publish("dim_contract", C.resolve_contracts(staged["contracts"], supplier, category, calendar))
    contract = run.curated("dim_contract")
    assert_unique(contract, "contract_id", "dim_contract")
    spending = C.resolve_spending(staged["payments"], contract, supplier, category, calendar)
    run.publish("fact_spending", spending, totals["fact_spending"])
    run.publish("fact_rfi", C.resolve_rfi(staged["risk"], supplier, calendar), totals["fact_rfi"])
    run.publish("fact_renewal", C.resolve_renewals(staged["amendments"], contract, calendar), totals["fact_renewal"])


def judge(run: Run, batch_id: str, limits: Q.Thresholds, totals: dict[str, tuple[int, str | None]]) -> DataFrame:
    """Write the reconciliation report and the exception index; return the report as stored."""
    sources = [Q.known_side(run.spark, entity, Q.SOURCE, *known) for entity, known in totals.items()]
    staged = {s: run.staged(s) for s in STAGING_TABLES}
    curated = {t: run.curated(t) for t in CURATED_TABLES}
    resolved = {c.entity: run.split("curated", c.entity) for c in Q.DIRECT_CONTROLS}
    ids = {"pipeline_run_id": F.lit(run.run_id), "source_snapshot_id": F.lit(batch_id)}
    report = Q.apply_thresholds(Q.reconciliation_report(sources, staged, curated, resolved), limits)
    write_table(report.withColumns(ids).coalesce(1), run.path("curated", "reconciliation_report"))
    rejected = {c.exceptions: run.rejected(c.entity) for c in Q.DIRECT_CONTROLS}
    index = Q.exception_index(rejected, batch_id).withColumn("pipeline_run_id", F.lit(run.run_id))
    write_table(index, run.path("curated", "exception_index"))
    return run.curated("reconciliation_report")


def run_batch(
    spark: SparkSession,
    snapshot: str,
    *,
    out_dir: str,
    run_id: str,
    limits: Q.Thresholds = Q.Thresholds(),
) -> dict:
    """Stage, publish and judge a snapshot. The manifest is written before a failed gate raises.

    A run that has a manifest is refused. A try that fails before it leaves nothing visible and can be repeated.
    """
    tune(spark)
    base = f"{out_dir.rstrip('/')}/{run_id}"
    with attempt(spark, base, POINTER) as folder:
        raw = open_snapshot(spark, snapshot)
        run = Run(spark, folder, run_id)
        staging = stage_all(run, snapshot, raw)
        totals = source_totals(run, staging)
        publish_curated(run, totals)
        report = judge(run, raw["snapshot_id"], limits, totals)
        failed = Q.failed_entities(report)
        manifest = {
            "pipeline_run_id": run_id,
            "source_snapshot_id": raw["snapshot_id"],
            "scenario_id": raw["scenario_id"],
            "raw_manifest": snapshot,
            "as_of_date": raw["as_of_date"],
            "directories": {"staging": f"{folder}/staging", "curated": f"{folder}/curated"},
            "staging": staging,
            "curated": {"quality": {"quality_passed": not failed, "failed_entities": failed}, "source_totals": totals},
            "schemas": {name: schema.jsonValue() for name, schema in run.schemas.items()},
        }
        publish_json(spark, manifest, f"{base}/{POINTER}")
    Q.enforce_gate(report)
    return manifest


def open_run(spark: SparkSession, run_dir: str) -> tuple[Run, dict]:
    """The tables of a published run, and its manifest."""
    pointer = f"{run_dir.rstrip('/')}/{POINTER}"
    if not exists(spark, pointer):
        raise FileNotFoundError(f"Pipeline run sem manifesto: {run_dir}.")
    manifest = read_json(spark, pointer)
    schemas = {name: T.StructType.fromJson(schema) for name, schema in manifest["schemas"].items()}
    folder = manifest["directories"]["curated"].removesuffix("/curated")
    return Run(spark, folder, manifest["pipeline_run_id"], schemas), manifest


def open_analytics(spark: SparkSession, run_dir: str) -> list[str]:
    """Register the analytic views of an approved run; SQL users then query `vw_*`."""
    tune(spark)
    run, manifest = open_run(spark, run_dir)
    if not manifest["curated"]["quality"]["quality_passed"]:
        raise Q.QualityGateError("O quality gate curated não foi aprovado para este pipeline run.")
    context = run_context(
        spark,
        pipeline_run_id=manifest["pipeline_run_id"],
        source_snapshot_id=manifest["source_snapshot_id"],
        scenario_id=manifest["scenario_id"],
        as_of_date=date.fromisoformat(manifest["as_of_date"]),
        etl_manifest_path=f"{run_dir}/{POINTER}",
        curated_dir=manifest["directories"]["curated"],
    )
    curated = {t: run.curated(t) for t in CURATED_TABLES}
    return register_views(
        spark, curated, run.curated("reconciliation_report"), run.curated("exception_index"), context
    )
