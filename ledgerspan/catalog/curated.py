"""V23-V29, T06-T14, Q01-Q08, VW5, VW6, K06, D09: curated tables and their reconciliation.

Curated builders run inside the query on staged tables that the batch published before.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, functions as F

from ledgerspan.catalog import adapters as A, oracle as O
from ledgerspan.catalog.batch import Batch
from ledgerspan.catalog.registry import query
from ledgerspan.catalog.rules import staged
from ledgerspan.catalog.scalars import CALENDAR_SQL
from ledgerspan.plans import curated as C, quality as Q
from ledgerspan.plans.analytics import dashboards, kpis, views
from ledgerspan.plans.curated.contracts import CONTRACT_COLUMNS
from ledgerspan.plans.curated.financials import FINANCIAL_COLUMNS, expected_revenue
from ledgerspan.plans.curated.renewals import RENEWAL_COLUMNS
from ledgerspan.plans.curated.resolution import ERRORS, exceptions, published
from ledgerspan.plans.curated.risk import RFI_COLUMNS
from ledgerspan.plans.curated.spending import SPENDING_COLUMNS
from ledgerspan.plans.curated.suppliers import SUPPLIER_COLUMNS, publish_names
from ledgerspan.sources.raw import LINEAGE

RUN_ID = "run-1"


def without_lineage(columns) -> list[str]:
    return [c for c in columns if c not in LINEAGE]


def resolution_entry(name: str, key: str, cte: str, build_rows, reads=()) -> None:
    @query(name, O.sql(f"SELECT {key}, {ERRORS} FROM {cte}"))
    def build(spark, sf):
        return build_rows(Batch(spark, sf, reads)).select(key, ERRORS)


# Group and supplier rules fire on rows that staging would have rejected, so they see all of them.
@query("v23_single_head_office", O.sql(f"SELECT cnpj, {ERRORS} FROM res_supplier", stg_companies="SELECT * FROM val_companies"))
def v23(spark, sf):
    annotated = Batch(spark, sf).table("val_companies", lambda: staged(spark, sf, "companies"))
    return C.resolve_suppliers(annotated).select("cnpj", ERRORS)


resolution_entry("v24_supplier_resolution", "cnpj", "res_supplier", lambda b: C.resolve_suppliers(b.staged("companies")))
resolution_entry("v25_contract_resolution", "contract_id", "res_contract", Batch.resolve_contracts)
resolution_entry("v26_payment_resolution", "payment_id", "res_spending", Batch.resolve_spending, ["payments"])
resolution_entry("v27_risk_resolution", "risk_assessment_id", "res_rfi", Batch.resolve_rfi, ["risk"])
resolution_entry("v28_amendment_resolution", "amendment_id", "res_renewal", Batch.resolve_renewals, ["amendments"])
resolution_entry("v29_financial_resolution", "financial_snapshot_key", "res_financial", Batch.resolve_financials)


@query(
    "t06_dim_supplier",
    O.sql(
        "SELECT supplier_key, cnpj AS supplier_cnpj, cnpj8 AS supplier_cnpj8, economic_group_key, parent_supplier_key,"
        " cnpj_matriz AS parent_supplier_cnpj, razao_social AS supplier_legal_name, hierarquia AS supplier_hierarchy,"
        " porte_empresa AS company_size, atividade_economica AS economic_activity, ano_fundacao AS foundation_year,"
        " idade_empresa AS company_age_years, estagio_empresa AS company_stage, cenario_financeiro AS financial_scenario FROM cur_supplier"
    ),
)
def t06(spark, sf):
    rows = C.resolve_suppliers(Batch(spark, sf).staged("companies"))
    return published(publish_names(rows), without_lineage(SUPPLIER_COLUMNS))


@query(
    "t07_dim_economic_group",
    O.sql(
        "SELECT economic_group_key, cnpj8 AS economic_group_cnpj8, supplier_key AS matrix_supplier_key,"
        " razao_social AS economic_group_legal_name FROM cur_supplier WHERE hierarquia = 'Matriz'"
    ),
)
def t07(spark, sf):
    return Batch(spark, sf).dim_economic_group().drop(*LINEAGE)


@query("t08_dim_calendar", O.sql(f"SELECT {CALENDAR_SQL} FROM (SELECT calendar_date AS d FROM cal)"))
def t08(spark, sf):
    return C.build_calendar(Batch(spark, sf, ()).all_seen())


@query("t09_dim_category", O.sql("SELECT * FROM cur_category"))
def t09(spark, sf):
    batch = Batch(spark, sf, ())
    return C.build_categories(batch.seen("contracts"), batch.seen("payments"))




def fact_entry(name: str, columns, cte: str, build_rows, types: dict[str, str], reads=()) -> None:
    names = without_lineage(columns)
    typed = " ".join(c + types.get(c, ":i" if c.endswith("calendar_key") else "") for c in names)

    @query(name, O.sql(f"SELECT {O.show(typed)} FROM {cte}"))
    def build(spark, sf):
        return published(build_rows(Batch(spark, sf, reads)), names)


fact_entry("t10_dim_contract", CONTRACT_COLUMNS, "cur_contract", Batch.resolve_contracts, {"original_value": ":n", "total_value": ":n", "balance_value": ":n"})
fact_entry("t11_fact_spending", SPENDING_COLUMNS, "cur_spending", Batch.resolve_spending, {"payment_value": ":n"}, ["payments"])
fact_entry("t12_fact_rfi", RFI_COLUMNS, "cur_rfi", Batch.resolve_rfi, {}, ["risk"])
fact_entry("t13_fact_renewal", RENEWAL_COLUMNS, "cur_renewal", Batch.resolve_renewals, {"amendment_value": ":n"}, ["amendments"])
fact_entry("t14_fact_supplier_financial", FINANCIAL_COLUMNS, "cur_financial", Batch.resolve_financials, {"financial_year": ":i"})


# ---- reconciliation
def direct_sql(entity: str, source_name: str, exc: str, source: str, resolved: str, money: str | None) -> str:
    total = f"coalesce(sum(CAST({money} AS DECIMAL(38,2))), 0)" if money else "NULL"
    return f"""SELECT '{entity}' AS entity, 'direct' AS reconciliation_type, '{source_name}' AS source_table, '{entity}' AS curated_table,
  '{exc}' AS exception_table, ns AS source_row_count, np AS published_row_count, nx AS exception_row_count,
  CASE WHEN ns = 0 THEN 1.0 ELSE CAST(np AS DOUBLE) / CAST(ns AS DOUBLE) END AS match_rate, ns - np - nx AS row_count_delta,
  CAST(ms AS VARCHAR) AS source_monetary_total, CAST(mp AS VARCHAR) AS curated_monetary_total, CAST(mx AS VARCHAR) AS exception_monetary_total,
  CAST(CAST(ms - mp - mx AS DECIMAL(38,2)) AS VARCHAR) AS monetary_delta, ns = np + nx AS is_row_count_reconciled, coalesce(ms - mp - mx = 0, true) AS is_monetary_reconciled
FROM (SELECT count(*) AS ns, CAST({total} AS DECIMAL(38,2)) AS ms FROM {source}),
  (SELECT count(*) AS np, CAST({total} AS DECIMAL(38,2)) AS mp FROM {resolved} WHERE {ERRORS} = ''),
  (SELECT count(*) AS nx, CAST({total} AS DECIMAL(38,2)) AS mx FROM {resolved} WHERE {ERRORS} <> '')"""


def derived_sql(entity: str, source: str, expected: str, actual: str) -> str:
    return f"""SELECT '{entity}' AS entity, 'derived' AS reconciliation_type, '{source}' AS source_table, '{entity}' AS curated_table,
  CAST(NULL AS VARCHAR) AS exception_table, e AS source_row_count, a AS published_row_count, CAST(0 AS BIGINT) AS exception_row_count,
  CASE WHEN e = 0 THEN 1.0 ELSE CAST(c AS DOUBLE) / CAST(e AS DOUBLE) END AS match_rate, e - a AS row_count_delta,
  CAST(NULL AS VARCHAR) AS source_monetary_total, CAST(NULL AS VARCHAR) AS curated_monetary_total, CAST(NULL AS VARCHAR) AS exception_monetary_total,
  CAST(NULL AS VARCHAR) AS monetary_delta, e = c AND a = c AS is_row_count_reconciled, true AS is_monetary_reconciled
FROM (SELECT count(x.k) AS e, count(y.k) AS a, count(*) FILTER (x.k IS NOT NULL AND y.k IS NOT NULL) AS c
  FROM (SELECT DISTINCT k FROM ({expected}) WHERE k IS NOT NULL) x FULL JOIN (SELECT DISTINCT k FROM ({actual}) WHERE k IS NOT NULL) y ON x.k = y.k)"""


DIRECT = [
    ("dim_supplier", "stg_empresas", "dim_supplier_resolution_exceptions", "stg_companies", "res_supplier", None),
    ("dim_contract", "stg_contratos", "dim_contract_resolution_exceptions", "stg_contracts", "res_contract", None),
    ("fact_spending", "stg_pagamentos", "fact_spending_exceptions", "stg_payments", "res_spending", "payment_value"),
    ("fact_rfi", "stg_homologacoes_risco", "fact_rfi_exceptions", "stg_risk", "res_rfi", None),
    ("fact_renewal", "stg_aditamentos", "fact_renewal_exceptions", "stg_amendments", "res_renewal", "amendment_value"),
    ("fact_supplier_financial", "stg_empresas_financial", "fact_supplier_financial_exceptions", "yearly_figures", "res_financial", "gross_revenue"),
]
DERIVED = [
    ("dim_economic_group", "dim_supplier", "SELECT economic_group_key AS k FROM cur_supplier", "SELECT economic_group_key AS k FROM cur_supplier WHERE hierarquia = 'Matriz'"),
    ("dim_category", "stg_contratos + stg_pagamentos", "SELECT category_code AS k FROM cat_codes", "SELECT category_code AS k FROM cur_category"),
    ("dim_calendar", "stagings do lote", "SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS k FROM business_bounds", "SELECT calendar_date AS k FROM cal"),
]
DIRECT_SQL = "\nUNION ALL ".join(direct_sql(*d) for d in DIRECT)
DERIVED_SQL = "\nUNION ALL ".join(derived_sql(*d) for d in DERIVED)
REPORT = {"report": DIRECT_SQL + "\nUNION ALL " + DERIVED_SQL}
REPORT["judged"] = """SELECT *, CASE WHEN failure_reasons = '' THEN 'approved' ELSE 'failed' END AS status FROM (SELECT *, concat_ws('; ',
  CASE WHEN NOT is_row_count_reconciled THEN 'contagem não reconciliada' END,
  CASE WHEN match_rate < 0.95 THEN 'match rate abaixo do limiar' END,
  CASE WHEN NOT is_monetary_reconciled AND abs(CAST(monetary_delta AS DECIMAL(38,2))) > 0 THEN 'diferença financeira acima da tolerância' END) AS failure_reasons
FROM report)"""
INDEX_PARTS = [
    ("dim_supplier", "dim_supplier_resolution_exceptions", "cnpj", "res_supplier"),
    ("dim_contract", "dim_contract_resolution_exceptions", "contract_id", "res_contract"),
    ("fact_spending", "fact_spending_exceptions", "payment_id", "res_spending"),
    ("fact_rfi", "fact_rfi_exceptions", "risk_assessment_id", "res_rfi"),
    ("fact_renewal", "fact_renewal_exceptions", "amendment_id", "res_renewal"),
    ("fact_supplier_financial", "fact_supplier_financial_exceptions", "financial_snapshot_key", "res_financial"),
]
INDEX = {
    "exc_index": "\nUNION ALL ".join(
        f"SELECT '{A.BATCH_ID}' AS batch_id, '{e}' AS entity, '{x}_{A.BATCH_ID}.parquet' AS exception_file, '{k}' AS business_key_type,"
        f" {k} AS business_key, {ERRORS} AS exception_cause, '{A.LOAD_DATE}' AS load_date, '{A.BATCH_ID}' AS source_batch_id FROM {r} WHERE {ERRORS} <> ''"
        for e, x, k, r in INDEX_PARTS
    )
}
COLUMNS = ", ".join(Q.REPORT_COLUMNS)


def source_sides(batch: Batch) -> list[DataFrame]:
    sources = batch.sources()
    return [Q.side_rows(c.entity, sources[c.source], Q.SOURCE, c.money) for c in Q.DIRECT_CONTROLS]


def report(spark, sf) -> DataFrame:
    batch = Batch(spark, sf)
    return Q.reconciliation_report(source_sides(batch), batch.all_staged(), batch.curated(), batch.resolved())


def judged(spark, sf) -> DataFrame:
    rows = Q.apply_thresholds(report(spark, sf), Q.Thresholds(0.95, Decimal("0.00")))
    return rows.withColumns({"pipeline_run_id": F.lit(RUN_ID), "source_snapshot_id": F.lit(A.BATCH_ID)})


def index(spark, sf) -> DataFrame:
    return Q.exception_index(Batch(spark, sf).rejected(), A.BATCH_ID)


@query("q01_direct_controls", O.sql(f"SELECT {COLUMNS} FROM report", report=DIRECT_SQL))
def q01(spark, sf):
    batch = Batch(spark, sf)
    resolved = batch.resolved()
    return Q.direct_controls([*source_sides(batch), *[Q.resolved_rows(c, resolved[c.entity]) for c in Q.DIRECT_CONTROLS]])


@query("q02_derived_controls", O.sql(f"SELECT {COLUMNS} FROM report", report=DERIVED_SQL))
def q02(spark, sf):
    batch = Batch(spark, sf)
    return Q.union_all(Q.derived_controls(batch.all_staged(), batch.curated()))


@query("q03_thresholds", O.sql("SELECT entity, match_rate, status, failure_reasons FROM judged", **REPORT))
def q03(spark, sf):
    return judged(spark, sf).select("entity", "match_rate", "status", "failure_reasons")


INDEX_SHOWN = "batch_id, entity, exception_file, business_key_type, business_key, exception_cause, load_date, source_batch_id"


@query("q04_exception_index", O.sql(f"SELECT {INDEX_SHOWN} FROM exc_index", **INDEX))
def q04(spark, sf):
    return index(spark, sf).drop("source_file", "source_row_number")


@query("q05_gate", O.sql("SELECT count(*) FILTER (status = 'failed') AS failed_entities, count(*) FILTER (status = 'failed') = 0 AS quality_passed FROM judged", **REPORT))
def q05(spark, sf):
    return judged(spark, sf).agg(
        F.count_if(F.col("status") == "failed").alias("failed_entities"),
        (F.count_if(F.col("status") == "failed") == 0).alias("quality_passed"),
    )


@query(
    "q06_spending_reconciliation",
    O.sql(
        "SELECT source_row_count, published_row_count AS fact_row_count, exception_row_count, source_monetary_total AS source_payment_value,"
        " curated_monetary_total AS fact_payment_value, exception_monetary_total AS exception_payment_value, is_row_count_reconciled,"
        " is_monetary_reconciled AS is_payment_value_reconciled FROM report",
        report=direct_sql(*DIRECT[2]),
    ),
)
def q06(spark, sf):
    batch = Batch(spark, sf)
    rows = batch.spending()
    return Q.spending_reconciliation(batch.staged("payments"), published(rows, SPENDING_COLUMNS), exceptions(rows))


@query(
    "q07_fact_coverage",
    O.sql(
        "\nUNION ALL ".join(
            f"SELECT '{e}' AS entity, n * {f} AS source_row_count, p AS fact_row_count, x AS exception_row_count, n * {f} = p + x AS is_reconciled"
            f" FROM (SELECT count(*) AS n FROM {s}), (SELECT count(*) FILTER ({ERRORS} = '') AS p, count(*) FILTER ({ERRORS} <> '') AS x FROM {r})"
            for e, s, r, f in (
                ("fact_rfi", "stg_risk", "res_rfi", 1), ("fact_renewal", "stg_amendments", "res_renewal", 1),
                ("fact_supplier_financial", "stg_companies", "res_financial", 5),
            )
        )
    ),
)
def q07(spark, sf):
    batch = Batch(spark, sf)
    curated, rejected = batch.curated(), batch.rejected()
    parts = [("fact_rfi", "risk", 1), ("fact_renewal", "amendments", 1), ("fact_supplier_financial", "companies", 5)]
    return Q.union_all([Q.coverage(e, batch.staged(s), curated[e], rejected[f"{e}_exceptions"], n) for e, s, n in parts])


@query(
    "q08_snapshot_integrity",
    O.sql(
        "\nUNION ALL ".join(
            f"SELECT {O.lit(name)} AS check_name, count(*) AS violations, count(*) = 0 AS passed FROM ({body})"
            for name, body in (
                ("contratos sem fornecedor", 'SELECT 1 FROM raw_contracts c WHERE NOT EXISTS (SELECT 1 FROM raw_companies s WHERE s."CNPJ" = c."CNPJ")'),
                ("aditamentos sem contrato", 'SELECT 1 FROM raw_amendments a WHERE NOT EXISTS (SELECT 1 FROM raw_contracts c WHERE c."Cód_Contrato" = a."Cód_Contrato")'),
                ("pagamentos sem contrato", 'SELECT 1 FROM raw_payments p WHERE NOT EXISTS (SELECT 1 FROM raw_contracts c WHERE c."Cód_Contrato" = p."Cód_Contrato")'),
                ("empresas duplicadas", 'SELECT "CNPJ" FROM raw_companies GROUP BY 1 HAVING count(*) > 1'),
                ("contratos duplicados", 'SELECT "Cód_Contrato" FROM raw_contracts GROUP BY 1 HAVING count(*) > 1'),
                ("pagamentos duplicados", 'SELECT "Cód_Pagamento" FROM raw_payments GROUP BY 1 HAVING count(*) > 1'),
            )
        )
    ),
)
def q08(spark, sf):
    return Q.snapshot_integrity(*[A.raw(spark, sf, s) for s in ("companies", "contracts", "amendments", "payments")])


VIEW5 = (
    "source_snapshot_id, pipeline_run_id, entity, reconciliation_type, source_table, curated_table, source_row_count, published_row_count, exception_row_count,"
    " match_rate, row_count_delta, source_monetary_total, curated_monetary_total, exception_monetary_total, monetary_delta, status, failure_reasons"
)


@query("vw5_quality_reconciliation", O.sql(f"SELECT {VIEW5} FROM (SELECT *, '{RUN_ID}' AS pipeline_run_id, '{A.BATCH_ID}' AS source_snapshot_id FROM judged)", **REPORT))
def vw5(spark, sf):
    return views.quality_reconciliation_view(judged(spark, sf))


def exceptions_view(spark, sf) -> DataFrame:
    return views.quality_exceptions_view(index(spark, sf).withColumn("pipeline_run_id", F.lit(RUN_ID)))


@query(
    "vw6_quality_exceptions",
    O.sql(
        f"SELECT '{RUN_ID}' AS pipeline_run_id, batch_id AS source_snapshot_id, entity, business_key_type, business_key, exception_cause, load_date, source_batch_id FROM exc_index",
        **INDEX,
    ),
)
def vw6(spark, sf):
    return exceptions_view(spark, sf).drop("source_file", "source_row_number")


@query(
    "k06_data_quality",
    O.sql(
        "SELECT r.entity, r.status, r.match_rate, r.row_count_delta, r.monetary_delta, r.failure_reasons, coalesce(e.n, 0) AS exception_count"
        " FROM judged r LEFT JOIN (SELECT entity, count(*) AS n FROM exc_index GROUP BY 1) e ON r.entity = e.entity",
        **REPORT,
        **INDEX,
    ),
)
def k06(spark, sf):
    return kpis.data_quality(views.quality_reconciliation_view(judged(spark, sf)), exceptions_view(spark, sf))


@query("d09_exceptions_by_entity", O.sql("SELECT entity, cause, count(*) AS exception_count FROM (SELECT entity, unnest(string_split(exception_cause, '; ')) AS cause FROM exc_index) GROUP BY ALL", **INDEX))
def d09(spark, sf):
    return dashboards.exceptions_by_entity(exceptions_view(spark, sf))


@query("a05_count_by_entity", O.sql("SELECT entity, count(*) AS n FROM exc_index GROUP BY 1", **INDEX))
def a05(spark, sf):
    return exceptions_view(spark, sf).groupBy("entity").agg(F.count("*").alias("n"))


@query("u05_expected_revenue", O.sql("SELECT financial_snapshot_key, gross_revenue FROM yearly_figures"))
def u05(spark, sf):
    return expected_revenue(Batch(spark, sf).staged("companies"))


@query("s04_valid_invalid_split", O.sql("SELECT 'invalid' AS side, payment_id, validation_errors FROM val_payments WHERE validation_errors <> '' UNION ALL SELECT 'valid', payment_id, '' FROM stg_payments"))
def s04(spark, sf):
    from ledgerspan.operators.rules import accepted, rejected

    # staged once, both sides are read from there
    annotated = Batch(spark, sf).table("val_payment_ids", lambda: staged(spark, sf, "payments").select("payment_id", "validation_errors"))
    valid = accepted(annotated).select(F.lit("valid").alias("side"), "payment_id", F.lit("").alias("validation_errors"))
    invalid = rejected(annotated)
    return valid.unionByName(invalid.select(F.lit("invalid").alias("side"), "payment_id", "validation_errors"))
