"""Dimensions, facts, reconciliation and gate on hand-made rows."""

from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F
from pytest import approx, raises
from raw_rows import LINEAGE_SCHEMA, table

from ledgerspan.operators.reshape import union_all
from ledgerspan.plans import curated as C, quality as Q
from ledgerspan.plans.curated.calendar import EmptyCalendarError
from ledgerspan.plans.curated.financials import MEASURES, expected_revenue
from ledgerspan.plans.curated.resolution import ERRORS
from ledgerspan.plans.curated.suppliers import SUPPLIER_COLUMNS, publish_names
from ledgerspan.plans.staging.companies import YEARS

COMPANY = (
    "cnpj string, cnpj8 string, cnpj_matriz string, razao_social string, hierarquia string, porte_empresa string,"
    " atividade_economica string, ano_fundacao bigint, idade_empresa bigint, estagio_empresa string, cenario_financeiro string"
)
HEAD, BRANCH, OTHER = "11222333000199", "11222333000299", "99888777000155"
D = date(2026, 2, 15)


def company(cnpj, kind, parent):
    return (cnpj, cnpj[:8], parent, f"Empresa {cnpj[-4:]}", kind, "Grande", "TI", 2000, 26, "Madura", "Estável")


def errors(df, key):
    return {r[key]: r[ERRORS] for r in df.collect()}


def test_suppliers_and_groups(spark):
    rows = table(spark, COMPANY, company(HEAD, "Matriz", HEAD), company(BRANCH, "Filial", HEAD), company(OTHER, "Matriz", OTHER))
    resolved = C.resolve_suppliers(rows)
    assert set(errors(resolved, "cnpj").values()) == {""}
    suppliers = publish_names(resolved).select(*SUPPLIER_COLUMNS)
    keys = {r.supplier_cnpj: r.parent_supplier_key for r in suppliers.collect()}
    assert keys == {HEAD: None, BRANCH: f"SUP-{HEAD}", OTHER: None}
    assert C.economic_groups(suppliers).count() == 2


def test_branch_without_head_and_two_heads(spark):
    lonely = C.resolve_suppliers(table(spark, COMPANY, company(BRANCH, "Filial", HEAD)))
    assert errors(lonely, "cnpj")[BRANCH] == "cnpj_matriz não encontrado como matriz; grupo econômico sem matriz única"
    double = C.resolve_suppliers(table(spark, COMPANY, company(HEAD, "Matriz", HEAD), company(BRANCH, "Matriz", BRANCH)))
    assert set(errors(double, "cnpj").values()) == {"grupo econômico sem matriz única"}


def staged_dates(spark, first=date(2025, 12, 31), last=date(2027, 1, 2)):
    lineage = [F.lit(D).alias("load_date")]
    one = spark.range(1)
    day = lambda d, n: F.lit(d).cast("date").alias(n)
    return {
        "contracts": one.select(day(first, "validity_start_date"), day(last, "validity_end_date"), day(None, "risk_evaluation_date"), F.lit("consultoria").alias("contract_category"), *lineage),
        "amendments": one.select(day(D, "validity_start_date"), day(D, "validity_end_date"), *lineage),
        "payments": one.select(day(D, "payment_date"), F.lit("categoria_nova").alias("payment_category"), *lineage),
        "risk": one.select(day(D, "assessment_date"), day(None, "last_approval_date"), day(None, "expiration_date"), *lineage),
    }


def test_calendar_covers_all_dates(spark):
    days = {r.calendar_date: r for r in C.build_calendar(staged_dates(spark)).collect()}
    assert len(days) == 368 and min(days) == date(2025, 12, 31) and max(days) == date(2027, 1, 2)
    eve = days[date(2026, 12, 31)]
    assert (eve.calendar_key, eve.is_year_end, eve.month_name, eve.year_quarter) == (20261231, True, "dezembro", "2026-T4")
    assert days[date(2026, 8, 1)].is_weekend and days[date(2026, 8, 1)].day_name == "sabado"
    assert days[date(2027, 1, 1)].calendar_week == 53


def test_empty_calendar_is_refused(spark):
    empty = {name: df.where("false") for name, df in staged_dates(spark).items()}
    with raises(EmptyCalendarError):
        C.build_calendar(empty, check=True)


def test_categories(spark):
    staged = staged_dates(spark)
    rows = {r.category_code: r for r in C.build_categories(staged["contracts"], staged["payments"]).collect()}
    assert rows["consultoria"].category_group == "servicos_profissionais" and rows["consultoria"].is_taxonomy_mapped
    new = rows["categoria_nova"]
    assert (new.category_name, new.category_family, new.is_taxonomy_mapped) == ("Categoria nova", "nao_classificada", False)


CONTRACT = (
    "contract_id string, contract_name string, supplier_cnpj string, contract_category string, validity_start_date date,"
    " validity_end_date date, original_value decimal(18,2), total_value decimal(18,2), balance_value decimal(18,2),"
    " contract_type string, contract_status string, risk_evaluation_date date, final_risk string, closure_reason string"
)
PAYMENT = (
    "payment_id string, contract_id string, supplier_cnpj string, payment_date date, payment_value decimal(18,2),"
    " cost_center string, payment_category string"
)


def contract(contract_id="CS00000001", cnpj=HEAD):
    m = Decimal("1000.00")
    return (contract_id, "x", cnpj, "consultoria", D, D, m, m, Decimal("500.00"), "novo_contrato", "ativo", None, "baixo", None)


def payment(payment_id="PAG00000001", contract_id="CS00000001", value="500.00", day=D, cnpj=HEAD, category="consultoria"):
    return (payment_id, contract_id, cnpj, day, Decimal(value), "CC-200", category)


def dims(spark):
    suppliers = spark.createDataFrame(
        [(HEAD, f"SUP-{HEAD}", "GRP-1"), (OTHER, f"SUP-{OTHER}", "GRP-2")],
        "supplier_cnpj string, supplier_key string, economic_group_key string",
    )
    categories = spark.createDataFrame([("consultoria", "CAT-consultoria"), ("outra", "CAT-outra")], "category_code string, category_key string")
    calendar = spark.createDataFrame([(D, 20260215)], "calendar_date date, calendar_key bigint")
    return suppliers, categories, calendar


def published_contracts(spark):
    rows = C.resolve_contracts(table(spark, CONTRACT, contract()), *dims(spark))
    return rows.where(F.col(ERRORS) == "")


def test_contract_and_spending_keys(spark):
    suppliers, categories, calendar = dims(spark)
    contracts = published_contracts(spark)
    row = contracts.first()
    assert (row.contract_key, row.validity_start_calendar_key, row.risk_evaluation_calendar_key) == ("CON-CS00000001", 20260215, None)
    rows = table(
        spark, PAYMENT, payment(), payment("PAG00000002", "CS00000009", "250.00"), payment("PAG00000003", cnpj=OTHER),
        payment("PAG00000004", category="outra"), payment("PAG00000005", day=date(2030, 1, 1)),
    )
    resolved = C.resolve_spending(rows, contracts, suppliers, categories, calendar)
    assert errors(resolved, "payment_id") == {
        "PAG00000001": "",
        "PAG00000002": "contract_id não encontrado em dim_contract",
        "PAG00000003": "supplier_key divergente do contrato",
        "PAG00000004": "category_key divergente do contrato",
        "PAG00000005": "payment_date não encontrado em dim_calendar",
    }
    fact, rejected = resolved.where(F.col(ERRORS) == ""), resolved.where(F.col(ERRORS) != "")
    check = Q.spending_reconciliation(rows, fact, rejected).first()
    assert (check.source_payment_value, check.fact_payment_value) == ("2250.00", "500.00")
    assert check.is_row_count_reconciled and check.is_payment_value_reconciled


def test_contract_with_unknown_supplier(spark):
    rows = C.resolve_contracts(table(spark, CONTRACT, contract(cnpj="00000000000000")), *dims(spark))
    assert errors(rows, "contract_id") == {"CS00000001": "supplier_cnpj não encontrado em dim_supplier"}


def test_risk_and_renewal_facts(spark):
    suppliers, _, calendar = dims(spark)
    risk = table(
        spark,
        "risk_assessment_id string, supplier_cnpj string, assessment_date date, last_approval_date date, expiration_date date",
        ("RSK000000001", HEAD, D, D, None), ("RSK000000002", "0", D, None, date(2031, 1, 1)),
    )
    found = errors(C.resolve_rfi(risk, suppliers, calendar), "rfi_key")
    assert found == {
        "RFI-RSK000000001": "",
        "RFI-RSK000000002": "supplier_cnpj não encontrado em dim_supplier; expiration_date não encontrado em dim_calendar",
    }
    events = table(
        spark,
        "amendment_id string, contract_id string, amendment_type string, validity_start_date date, validity_end_date date,"
        " amendment_value decimal(18,2), amendment_sequence bigint",
        ("AMD-CS00000001-0001", "CS00000001", "renovacao", D, D, Decimal("500.00"), 1),
        ("AMD-CS00000001-0002", "CS00000001", "aporte", D, D, Decimal("100.00"), 2),
        ("AMD-CS00000009-0001", "CS00000009", "aporte", D, D, Decimal("100.00"), 1),
    )
    out = {r.renewal_key: r for r in C.resolve_renewals(events, published_contracts(spark), calendar).collect()}
    assert out["RNL-AMD-CS00000001-0001"].is_renewal and not out["RNL-AMD-CS00000001-0002"].is_renewal
    assert out["RNL-AMD-CS00000009-0001"][ERRORS] == "contract_id não encontrado em dim_contract"


FIGURES = dict(zip(MEASURES, (1000.0, 700.0, 200.0, 300.0, 50.0, 200.0)))


def figures(spark, cnpj=HEAD, **changes):
    values = {f"{m}_{y}": v for m, v in FIGURES.items() for y in YEARS} | changes
    return table(spark, "cnpj string, " + ", ".join(f"{c} double" for c in values), (cnpj, *values.values()))


def test_financial_fact(spark):
    suppliers, _, _ = dims(spark)
    calendar = spark.createDataFrame([(date(y, 12, 31), y * 10000 + 1231) for y in YEARS], "calendar_date date, calendar_key bigint")
    good = C.resolve_financials(figures(spark), suppliers, calendar).collect()
    assert len(good) == 5 and {r[ERRORS] for r in good} == {""}
    assert {r.financial_period_calendar_key for r in good} == {y * 10000 + 1231 for y in YEARS}
    unknown = C.resolve_financials(figures(spark, cnpj="0"), suppliers, calendar)
    assert {r[ERRORS] for r in unknown.collect()} == {"cnpj não encontrado em dim_supplier"}
    odd = errors(C.resolve_financials(figures(spark, custo_folha_2022=900.0, lucro_liquido_2023=-1.0), suppliers, calendar), "financial_snapshot_key")
    assert odd[f"FIN-{HEAD}-2022"] == "payroll_cost maior que total_cost"
    assert odd[f"FIN-{HEAD}-2023"] == "net_income não pode ser negativa"


def test_expected_revenue_without_yearly_columns(spark):
    assert expected_revenue(table(spark, "cnpj string", (HEAD,))).isEmpty()
    assert expected_revenue(figures(spark)).count() == 5


def test_controls_thresholds_and_gate(spark):
    control = Q.DIRECT_CONTROLS[2]
    source = table(spark, PAYMENT, payment(), payment("PAG00000002", value="250.00"))
    nothing, everything = source.where("false"), source
    good = Q.apply_thresholds(Q.direct_control(control, source, everything, nothing))
    Q.enforce_gate(good)
    bad = Q.apply_thresholds(Q.direct_control(control, source, nothing, everything))
    row = bad.first()
    assert (row.status, row.failure_reasons, row.source_monetary_total) == ("failed", "match rate abaixo do limiar", "750.00")
    assert row.match_rate == approx(0.0) and row.is_row_count_reconciled
    with raises(Q.QualityGateError, match="fact_spending"):
        Q.enforce_gate(union_all([good, bad]))
    lost = Q.apply_thresholds(Q.direct_control(control, source, nothing, nothing)).first()
    assert "contagem não reconciliada" in lost.failure_reasons and "diferença financeira" in lost.failure_reasons
    empty = Q.direct_control(control, nothing, nothing, nothing).first()
    assert empty.match_rate == 1.0


def test_exception_index_keeps_key_and_cause(spark):
    bad = table(spark, PAYMENT, payment()).withColumn(ERRORS, F.lit("causa"))
    empty = {c.exceptions: spark.createDataFrame([], f"{c.business_key} string, {ERRORS} string, {LINEAGE_SCHEMA}") for c in Q.DIRECT_CONTROLS}
    row = Q.exception_index({**empty, "fact_spending_exceptions": bad}, "20260730_120000").collect()
    assert [(r.entity, r.business_key, r.exception_cause, r.source_row_number) for r in row] == [("fact_spending", "PAG00000001", "causa", 2)]


def test_load_date_outside_business_dates_fails_the_calendar_control(spark):
    staged = {n: df.withColumn("load_date", F.lit(date(2030, 1, 1))) for n, df in staged_dates(spark).items()}
    calendar = C.build_calendar(staged)
    groups = spark.createDataFrame([("g",)], "economic_group_key string")
    curated = {"dim_supplier": groups, "dim_economic_group": groups, "dim_calendar": calendar, "dim_category": C.build_categories(staged["contracts"], staged["payments"])}
    found = {r.entity: r.is_row_count_reconciled for r in union_all(Q.derived_controls(staged, curated)).collect()}
    assert found == {"dim_economic_group": True, "dim_category": True, "dim_calendar": False}


def test_spending_reconciliation_builds_no_table_that_it_does_not_read(spark, monkeypatch):
    from ledgerspan.catalog.all import QUERIES
    from ledgerspan.catalog.batch import Batch

    asked, table_of = set(), Batch.table
    monkeypatch.setattr(Batch, "table", lambda self, name, build: (asked.add(name), table_of(self, name, build))[1])
    row = QUERIES["q06_spending_reconciliation"](spark, "/root/testdata/sf0.001").first()
    assert row["source_row_count"] == row["fact_row_count"] + row["exception_row_count"] > 0
    assert {"stg_payments", "res_spending"} <= asked and not asked & {"res_rfi", "res_renewal", "res_financial"}
