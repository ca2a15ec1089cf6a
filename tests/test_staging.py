"""Staging rules on hand-made rows."""

from datetime import date
from decimal import Decimal

from raw_rows import REFERENCE, raw
from pytest import raises

from ledgerspan.operators.rules import accepted, rejected, rule_counts
from ledgerspan.plans.staging import stage_amendments, stage_companies, stage_contracts, stage_payments, stage_risk
from ledgerspan.plans.staging.companies import VALIDATED_MEASURES, YEARS
from ledgerspan.sources.published import conform_to_schema
from ledgerspan.sources.raw import SOURCE_COLUMNS, SourceContractError

CONTRACT = dict(zip(SOURCE_COLUMNS["contracts"], (
    "CS00000001", " Contrato de Serviços ", "13.241.241/0001-55", "Fornecedor Exemplo S.A.", "Serviços de Infraestrutura",
    "2026-01-01", "2026-12-31", "1000.00", "1200.00", "300.00", "Contrato Renovado", "Ativo", "", "Médio", "",
)))
PAYMENT = dict(zip(SOURCE_COLUMNS["payments"], (
    "PAG00000001", "CS00000001", "13.241.241/0001-55", "Fornecedor Exemplo S.A.", "2026-07-15", "450.00", "CC-300",
    "Licença de Software",
)))
RISK = dict(zip(SOURCE_COLUMNS["risk"], (
    "RSK000000001", "13.241.241/0001-55", "2026-01-01", "2026-01-01", "2029-12-31", "Aprovada", "Ativa", "Baixo",
    "Médio", "AA", "Médio", "0.02", "0.04", "0.10", "1.2",
)))


def rows_of(spark, base, *changes):
    return raw(spark, list(base), *[tuple({**base, **c}.values()) for c in changes])


def errors(df):
    return [r.validation_errors for r in df.orderBy("source_row_number").collect()]


def amendments(spark, *rows):
    return raw(spark, list(SOURCE_COLUMNS["amendments"]), *rows)


def known(spark):
    return spark.createDataFrame([("CS00000001",)], "contract_id string")


def test_contract_is_normalised(spark):
    row = stage_contracts(rows_of(spark, CONTRACT, {})).first()
    assert (row.contract_name, row.supplier_cnpj) == ("Contrato de Serviços", "13241241000155")
    assert (row.contract_category, row.contract_status, row.final_risk) == ("servicos_de_infraestrutura", "ativo", "medio")
    assert (row.total_value, row.closure_reason) == (Decimal("1200.00"), None)
    assert row.validation_errors == ""


def test_contract_interval_and_sign(spark):
    found = errors(stage_contracts(rows_of(spark, CONTRACT, {"Vigência Inicio": "2027-01-01", "Valor_Total": "-1"})))[0]
    assert "vigência inicial posterior à final" in found and "total_value não pode ser negativo" in found


def test_closed_contract_needs_date_and_reason(spark):
    found = errors(stage_contracts(rows_of(spark, CONTRACT, {"Status": "Encerrado"})))[0]
    assert found == "encerrado sem data de avaliação de risco; encerrado sem motivo de encerramento"


def test_every_copy_of_a_contract_is_flagged(spark):
    assert errors(stage_contracts(rows_of(spark, CONTRACT, {}, {}, {"Cód_Contrato": "CS00000002"}))) == [
        "contract_id duplicado", "contract_id duplicado", "",
    ]


def test_blank_ids_are_missing_not_repeated(spark):
    found = errors(stage_contracts(rows_of(spark, CONTRACT, {"Cód_Contrato": " "}, {"Cód_Contrato": None})))
    assert found == ["contract_id ausente; contract_id deve seguir o padrão CS########"] * 2


def test_trailing_newline_does_not_pass_a_format(spark):
    # trimmed for ids, but a cost centre with an inner newline must fail
    found = errors(stage_payments(rows_of(spark, PAYMENT, {"Centro_Custo": "CC-300\nX"}), known(spark)))
    assert found == ["cost_center inválido"]


def test_missing_column_is_refused(spark):
    with raises(SourceContractError, match="Saldo"):
        stage_contracts(rows_of(spark, CONTRACT, {}).drop("Saldo"))


def test_contract_schema_on_write(spark):
    valid = conform_to_schema(accepted(stage_contracts(rows_of(spark, CONTRACT, {}))), "stg_contratos")
    assert dict(valid.dtypes)["balance_value"] == "decimal(18,2)"


def test_amendment_ids_and_types(spark):
    rows = amendments(
        spark,
        ("CS00000001", "Renovação", "2026-01-01", "2026-12-31", "1200.50", "1"),
        ("CS00000001", "Aporte", "2026-06-01", "2026-12-31", "300.00", "2"),
    )
    out = stage_amendments(rows, known(spark)).orderBy("source_row_number").collect()
    assert [r.amendment_id for r in out] == ["AMD-CS00000001-0001", "AMD-CS00000001-0002"]
    assert [r.validation_errors for r in out] == ["", ""]


def test_amendment_collects_three_errors(spark):
    rows = amendments(spark, ("CS00000009", "Renovação", "2026-12-31", "2026-01-01", "0", "1"))
    assert errors(stage_amendments(rows, known(spark))) == [
        "contract_id não encontrado em stg_contratos; vigência inicial posterior à final; amendment_value deve ser positivo"
    ]


def test_repeated_event_and_top_up_outside_renewal(spark):
    rows = amendments(
        spark,
        ("CS00000001", "Renovação", "2026-01-01", "2026-12-31", "1200.50", "1"),
        ("CS00000001", "Aporte", "2027-01-01", "2027-02-01", "300.00", "1"),
    )
    assert errors(stage_amendments(rows, known(spark))) == [
        "evento de aditamento duplicado",
        "evento de aditamento duplicado; aporte fora da vigência de uma renovação",
    ]


def test_large_sequence_keeps_all_digits(spark):
    rows = amendments(spark, ("CS00000001", "Renovação", "2026-01-01", "2026-12-31", "1.00", "12345"))
    assert stage_amendments(rows, known(spark)).first().amendment_id == "AMD-CS00000001-12345"


def test_payment_rules(spark):
    bad = {"Cód_Contrato": "CS00000009", "Data_Pagamento": "data-inválida", "Valor_Pago": "0"}
    found = errors(stage_payments(rows_of(spark, PAYMENT, {}, {**bad, "Cód_Pagamento": "PAG00000002"}), known(spark)))
    assert found == [
        "",
        "contract_id não encontrado em stg_contratos; payment_date ausente ou inválida; payment_value deve ser positivo",
    ]


def test_valid_and_invalid_make_the_source(spark):
    staged = stage_payments(rows_of(spark, PAYMENT, {}, {}, {"Cód_Pagamento": "PAG00000003"}), known(spark))
    assert (accepted(staged).count(), rejected(staged).count()) == (1, 2)
    assert [tuple(r) for r in rule_counts(staged).collect()] == [("payment_id duplicado", 2)]


def test_risk_rules(spark):
    bad = {"CNPJ": "invalido", "Status_Homologacao": "Negada", "Risco_Final": "Alto", "Id_Avaliacao_Risco": "RSK000000002"}
    out = stage_risk(rows_of(spark, RISK, {}, bad), REFERENCE).orderBy("source_row_number").collect()
    assert (out[0].validation_errors, out[0].supplier_cnpj8) == ("", "13241241")
    for message in (
        "supplier_cnpj deve conter 14 dígitos",
        "homologação aprovada com status inválido",
        "homologação aprovada com risco final alto",
    ):
        assert message in out[1].validation_errors


def test_status_against_reference_date(spark):
    rows = rows_of(spark, RISK, {"Data_Expiracao": "2026-07-01"}, {"Status_Homologacao": "Expirada", "Id_Avaliacao_Risco": "RSK000000002"})
    assert errors(stage_risk(rows, REFERENCE)) == [
        "homologação ativa expirada na data de referência",
        "homologação expirada sem expiração na data de referência",
    ]


def company(cnpj="11222333000199", kind="Matriz", parent="11222333000199", **changes):
    base = dict(zip(SOURCE_COLUMNS["companies"], (cnpj, cnpj[:8], parent, "Empresa", kind, "1000.00", "Grande", "8", "2", "10", "1")))
    base.update({f"{m.title()}_{y}": "100.0" for m in (*VALIDATED_MEASURES, "custo_folha") for y in YEARS})
    return {**base, **changes}


def companies(spark, *rows):
    return raw(spark, list(rows[0]), *[tuple(r.values()) for r in rows])


def test_companies_valid_and_repeated(spark):
    assert errors(stage_companies(companies(spark, company()))) == [""]
    assert errors(stage_companies(companies(spark, company(), company()))) == ["cnpj duplicado"] * 2


def test_branch_is_checked_against_its_head_office(spark):
    branch = company("11222333000299", "Filial", Capital_Social="5000.00")
    orphan = company("99888777000199", "Filial", "99888777000155")
    found = errors(stage_companies(companies(spark, company(), branch, orphan)))
    assert found == ["", "capital_social maior que o valor da matriz", "cnpj_matriz não encontrado ou não é matriz"]


def test_fractional_headcount_is_a_row_error(spark):
    assert "num_func_clt ausente ou inválido" in errors(stage_companies(companies(spark, company(Num_Func_CLT="8.5"))))[0]


def test_dates_with_a_time_are_dates(spark):
    row = stage_contracts(
        rows_of(spark, CONTRACT, {"Status": "Encerrado", "Data_Avaliacao_Risco": "2026-03-01 00:00:00", "Motivo_Encerramento": "x"})
    ).first()
    assert (row.risk_evaluation_date, row.validation_errors) == (date(2026, 3, 1), "")


def test_flags_move_wide_rows_once(spark):
    import re

    from ledgerspan.operators.narrow import with_flags
    from ledgerspan.operators.uniqueness import flag_repeated
    from ledgerspan.plans.staging.amendments import stage_amendments
    from ledgerspan.plans.staging.payments import stage_payments

    known = spark.createDataFrame([("CS00000001",)], "contract_id string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for source, build, wide in (("amendments", stage_amendments, "amendment_value"), ("payments", stage_payments, "payment_value")):
            from ledgerspan.sources.raw import SOURCE_COLUMNS

            staged = build(raw(spark, SOURCE_COLUMNS[source], tuple("x" for _ in SOURCE_COLUMNS[source])), known)
            plan = spark._jvm.PythonSQLUtils.explainString(staged._jdf.queryExecution(), "formatted")
            inputs = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*?)\]\n", plan)
            assert len(inputs) > 3 and sum(wide in i for i in inputs) <= 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    rows = spark.createDataFrame([("b", "f", i, i % 7 if i < 20 else 99, "wide") for i in range(500)], "batch_id string, source_file string, source_row_number long, k long, w string")
    flagging = lambda df: flag_repeated(df, ["k"], "again")
    got = {r["source_row_number"]: (r["again"], r["w"]) for r in with_flags(rows, ["k"], flagging, {"again": False}).collect()}
    assert got == {i: (True, "wide") for i in range(500)}
    bare = rows.drop("batch_id").where("k < 7").limit(1)
    assert [r["again"] for r in with_flags(bare, ["k"], flagging, {"again": False}).collect()] == [False]
