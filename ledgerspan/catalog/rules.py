"""The rule engine on the five RAW adapters.

Each V entry evaluates the named rules on every row of its source and returns the row key with the
text of the rules that fired.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerspan.catalog import adapters as A, oracle as O
from ledgerspan.catalog.batch import REFERENCE, Batch
from ledgerspan.catalog.registry import query
from ledgerspan.operators.lookup import flag_member_unique
from ledgerspan.operators.rules import Rule, annotate, rule_counts
from ledgerspan.operators.uniqueness import flag_repeated
from ledgerspan.plans import staging as S
from ledgerspan.plans.staging import amendments, companies, contracts, payments, risk
from ledgerspan.sources.published import stage_counts
from ledgerspan.sources.raw import conform

YEARLY = [f"{m}_{y}" for m in ("faturamento", "custo", "lucro_bruto", "juros_divida", "lucro_liquido") for y in A.YEARS]
FIGURES = ["capital_social", *YEARLY]
COUNTS = ["num_func_clt", "num_func_pj", "num_total_func", "processos_trabalhistas"]


def flagged(spark: SparkSession, sf: str, source: str, *flags: str) -> DataFrame:
    """Normalised rows with only the flags the chosen rules look at."""
    raw = A.raw(spark, sf, source)
    if source == "contracts":
        rows = contracts.normalize_contracts(raw)
        return flag_repeated(rows, ["contract_id"], "__repeated", exempt=F.col("contract_id") == "") if flags else rows
    if source == "companies":
        rows = companies.normalize_companies(raw)
        if "repeated" in flags:
            rows = flag_repeated(rows, ["cnpj"], "__repeated", exempt=F.col("cnpj") == "")
        return companies.with_head_office(rows) if "head" in flags else rows
    if source == "risk":
        rows = risk.normalize_risk(raw)
        key = "risk_assessment_id"
        return flag_repeated(rows, [key], "__repeated", exempt=F.col(key) == "") if flags else rows
    if source == "payments":
        rows = payments.normalize_payments(raw)
        if "repeated" in flags:
            rows = flag_repeated(rows, ["payment_id"], "__repeated", exempt=F.col("payment_id") == "")
    else:
        rows = amendments.normalize_amendments(raw)
        if "inside" in flags:
            rows = amendments.flag_inside_renewal(rows)
        if "repeated" in flags:
            exempt = (F.col("contract_id") == "") | F.col("amendment_sequence").isNull()
            rows = flag_repeated(rows, ["contract_id", "amendment_sequence"], "__repeated", exempt=exempt)
    if "known" in flags:
        rows = flag_member_unique(rows, "contract_id", Batch(spark, sf).staged("contracts"), "contract_id", "__known")
    return rows


def contract_rules() -> list[Rule]:
    return [
        *contracts.identity_rules(), *contracts.interval_rules(), *contracts.money_rules(),
        *contracts.closure_rules(),
    ]


def amendment_rules() -> list[Rule]:
    usable = F.col("validity_start_date") <= F.col("validity_end_date")
    outside = (F.col("amendment_type") == "aporte") & usable & ~F.col("__inside")
    return [*amendments.row_rules(), Rule(outside, "aporte fora da vigência de uma renovação")]


def risk_rules() -> list[Rule]:
    return [
        *risk.content_rules(), risk.derived_risk_rule(), *risk.approval_rules(), *risk.chronology_rules(),
        *risk.reference_date_rules(F.lit(REFERENCE)),
    ]


def company_rules() -> list[Rule]:
    return [*companies.identity_rules(), *companies.figure_rules(), *companies.hierarchy_rules()]


ALL_RULES: dict[str, Callable[[], list[Rule]]] = {
    "contracts": contract_rules,
    "amendments": amendment_rules,
    "payments": payments.payment_rules,
    "risk": risk_rules,
    "companies": company_rules,
}
KEYS = {
    "contracts": "contract_id", "amendments": "amendment_id", "payments": "payment_id",
    "risk": "risk_assessment_id", "companies": "cnpj",
}


def rule_entry(name: str, source: str, messages: list[str], *flags: str) -> None:
    @query(name, O.rule_query(source, messages, KEYS[source]))
    def build(spark, sf):
        chosen = [r for r in ALL_RULES[source]() if r.message in messages]
        return annotate(flagged(spark, sf, source, *flags), chosen).select(KEYS[source], "validation_errors")


INVALID, BAD_DATE = "ausente ou inválido", "ausente ou inválida"
MONEY = ["original_value", "total_value", "balance_value"]
SCORES = ["interest_to_revenue_ratio", "revenue_trend", "net_margin", "labor_cases_index"]
CONTRACT_FORMAT = "contract_id deve seguir o padrão CS########"

rule_entry("v01_required_contracts", "contracts", [f"{c} ausente" for c in ("contract_id", "supplier_cnpj", "contract_name", "supplier_name", "contract_category", "final_risk")])
rule_entry("v01_required_payments", "payments", [f"{c} ausente" for c in ("payment_id", "contract_id", "supplier_name", "payment_category")])
rule_entry("v01_required_companies", "companies", [f"{c} ausente" for c in ("cnpj", "cnpj8", "razao_social")])
rule_entry("v01_required_risk", "risk", [f"{c} ausente" for c in ("risk_assessment_id", "supplier_cnpj")])
rule_entry("v02_format_contracts", "contracts", [CONTRACT_FORMAT, "supplier_cnpj deve conter 14 dígitos"])
rule_entry("v02_format_payments", "payments", ["payment_id deve seguir o padrão PAG########", CONTRACT_FORMAT, "supplier_cnpj inválido", "supplier_cnpj8 inválido", "cost_center inválido"])
rule_entry("v02_format_companies", "companies", ["cnpj deve conter 14 dígitos", "cnpj8 deve conter 8 dígitos"])
rule_entry("v02_format_risk", "risk", ["risk_assessment_id deve seguir o padrão RSK#########", "supplier_cnpj deve conter 14 dígitos", "supplier_cnpj8 inválido"])
rule_entry("v03_unique_contracts", "contracts", ["contract_id duplicado"], "repeated")
rule_entry("v03_unique_payments", "payments", ["payment_id duplicado"], "repeated")
rule_entry("v03_unique_companies", "companies", ["cnpj duplicado"], "repeated")
rule_entry("v03_unique_risk", "risk", ["risk_assessment_id duplicado"], "repeated")
rule_entry("v04_unique_event", "amendments", ["evento de aditamento duplicado"], "repeated")
rule_entry("v05_enum_contracts", "contracts", ["contract_status inválido", "contract_type inválido"])
rule_entry("v05_enum_amendments", "amendments", ["amendment_type inválido"])
rule_entry("v05_enum_companies", "companies", ["hierarquia inválida", "porte_empresa inválido"])
rule_entry("v05_enum_risk", "risk", ["homologation_result inválido", "homologation_status inválido", "financial_risk inválido", "labor_risk inválido", "final_risk inválido", "credit_rating inválido"])
rule_entry("v06_parse_contracts", "contracts", [f"validity_start_date {BAD_DATE}", f"validity_end_date {BAD_DATE}", *[f"{c} {INVALID}" for c in MONEY]])
rule_entry("v06_parse_amendments", "amendments", [f"validity_start_date {BAD_DATE}", f"validity_end_date {BAD_DATE}", f"amendment_value {INVALID}", f"amendment_sequence {BAD_DATE}"])
rule_entry("v06_parse_payments", "payments", [f"payment_date {BAD_DATE}", f"payment_value {INVALID}"])
rule_entry("v06_parse_risk", "risk", [f"assessment_date {BAD_DATE}", *[f"{c} {INVALID}" for c in SCORES]])
rule_entry("v06_parse_companies", "companies", [f"{c} {INVALID}" for c in [*FIGURES, *COUNTS]])
rule_entry("v07_sign_contracts", "contracts", [f"{c} não pode ser negativo" for c in MONEY])
rule_entry("v07_sign_amendments", "amendments", ["amendment_value deve ser positivo", "amendment_sequence deve ser positiva"])
rule_entry("v07_sign_payments", "payments", ["payment_value deve ser positivo"])
rule_entry("v07_sign_risk", "risk", ["interest_to_revenue_ratio não pode ser negativo", "labor_cases_index não pode ser negativo"])
rule_entry("v07_sign_companies", "companies", [f"{c} não pode ser negativo" for c in [*FIGURES, *COUNTS]])
rule_entry("v08_interval_contracts", "contracts", ["vigência inicial posterior à final"])
rule_entry("v08_interval_amendments", "amendments", ["vigência inicial posterior à final"])
rule_entry("v09_money_order", "contracts", ["total_value não pode ser menor que original_value", "balance_value não pode superar total_value"])
rule_entry("v10_headcount_sum", "companies", ["total de funcionários divergente de clt + pj"])
rule_entry("v11_whole_sequence", "amendments", ["amendment_sequence deve ser inteira"])
rule_entry("v12_closure", "contracts", ["encerrado sem data de avaliação de risco", "encerrado sem motivo de encerramento", "motivo de encerramento em contrato não encerrado"])
rule_entry("v13_approval_states", "risk", [m for _, m in O.RULES["risk"] if m.startswith(("homologação aprovada", "homologação reprovada"))])
rule_entry("v14_derived_risk", "risk", ["final_risk divergente dos riscos financeiro e trabalhista"])
rule_entry("v15_chronology", "risk", ["data de aprovação posterior à avaliação", "data de expiração anterior ou igual à aprovação"])
rule_entry("v16_reference_date", "risk", ["homologação ativa expirada na data de referência", "homologação expirada sem expiração na data de referência"])
rule_entry("v17_root_prefix", "companies", ["cnpj8 divergente do cnpj"])
rule_entry("v18_parent_reference", "companies", ["matriz deve referenciar o próprio cnpj", "filial sem cnpj_matriz"])
rule_entry("v19_parent_exists", "companies", ["cnpj_matriz não encontrado ou não é matriz"], "head")
rule_entry("v20_branch_within_head", "companies", [f"{c} maior que o valor da matriz" for c in [*FIGURES, "num_total_func"]], "head")
rule_entry("v21_reference_amendments", "amendments", ["contract_id não encontrado em stg_contratos"], "known")
rule_entry("v21_reference_payments", "payments", ["contract_id não encontrado em stg_contratos"], "known")
rule_entry("v22_top_up_in_renewal", "amendments", ["aporte fora da vigência de uma renovação"], "inside")


def staged(spark, sf, source: str) -> DataFrame:
    raw = A.raw(spark, sf, source)
    if source == "contracts":
        return S.stage_contracts(raw)
    if source == "companies":
        return S.stage_companies(raw)
    if source == "risk":
        return S.stage_risk(raw, REFERENCE)
    valid = Batch(spark, sf).staged("contracts")
    return S.stage_amendments(raw, valid) if source == "amendments" else S.stage_payments(raw, valid)


STAGED_COLUMNS = {
    "contracts": "contract_id contract_name supplier_cnpj supplier_name contract_category validity_start_date:d validity_end_date:d original_value:n total_value:n balance_value:n contract_type contract_status risk_evaluation_date:d final_risk closure_reason validation_errors",
    "amendments": "amendment_id contract_id amendment_type validity_start_date:d validity_end_date:d amendment_value:n amendment_sequence validation_errors",
    "payments": "payment_id contract_id supplier_cnpj supplier_cnpj8 supplier_name payment_date:d payment_value:n cost_center payment_category validation_errors",
    "risk": "risk_assessment_id supplier_cnpj supplier_cnpj8 assessment_date:d last_approval_date:d expiration_date:d homologation_result homologation_status financial_risk labor_risk credit_rating final_risk interest_to_revenue_ratio revenue_trend net_margin labor_cases_index validation_errors",
    "companies": "cnpj cnpj8 cnpj_matriz razao_social hierarquia porte_empresa ano_fundacao idade_empresa estagio_empresa "
    + " ".join([*FIGURES, *[f"custo_folha_{y}" for y in A.YEARS], *COUNTS])
    + " validation_errors",
}
TABLES = (
    ("t01_stg_companies", "companies"), ("t02_stg_contracts", "contracts"), ("t03_stg_amendments", "amendments"),
    ("t04_stg_payments", "payments"), ("t05_stg_risk", "risk"),
)


def table_entry(name: str, source: str) -> None:
    columns = STAGED_COLUMNS[source]

    @query(name, O.sql(f"SELECT {O.show(columns)} FROM val_{source}"))
    def build(spark, sf):
        return staged(spark, sf, source).select(*[c.split(":")[0] for c in columns.split()])


for _name, _source in TABLES:
    table_entry(_name, _source)


@query("a08_rule_counts", O.sql("SELECT message, count(*) AS violations FROM (SELECT unnest(string_split(validation_errors, '; ')) AS message FROM val_contracts WHERE validation_errors <> '') GROUP BY message"))
def a08(spark, sf):
    return rule_counts(staged(spark, sf, "contracts"))


@query(
    "v30_error_accumulation",
    O.sql("SELECT validation_errors, count(*) AS n FROM val_risk GROUP BY ALL"),
)
def v30(spark, sf):
    return staged(spark, sf, "risk").groupBy("validation_errors").agg(F.count("*").alias("n"))


@query("s05_renamed_columns", O.sql('SELECT "Cód_Pagamento" AS payment_id, "Valor_Pago" AS payment_value, "Data_Pagamento" AS payment_date FROM raw_payments'))
def s05(spark, sf):
    return conform(A.raw(spark, sf, "payments"), "payments").select("payment_id", "payment_value", "payment_date")


@query("s11_stage_counts", O.sql("SELECT count(*) AS source, count(*) FILTER (validation_errors = '') AS valid, count(*) FILTER (validation_errors <> '') AS invalid FROM val_payments"))
def s11(spark, sf):
    return stage_counts(staged(spark, sf, "payments"))
