"""SQL building blocks for the expected results: CTEs over the test tables.

Everything here is written for the reference results only; no query reads it.
"""

from __future__ import annotations

import re

from ledgerspan.catalog import adapters as A

def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def select(columns: dict[str, str], source: str, where: str | None = None) -> str:
    listed = ",\n  ".join(f'{e} AS "{c}"' for c, e in columns.items())
    return f"SELECT {listed}\nFROM {source}" + (f"\nWHERE {where}" if where else "")


def blank_code(x: str) -> str:
    return f"coalesce(upper(trim({x})), '')"


def digits(x: str) -> str:
    return f"coalesce(regexp_replace({x}, '[^0-9]', '', 'g'), '')"


def slug(x: str) -> str:
    folded = f"translate(lower(trim({x})), 'áàãâéêíóôõúç', 'aaaaeeiooouc')"
    return f"coalesce(trim(regexp_replace({folded}, '[^a-z0-9]+', '_', 'g'), '_'), '')"


def lenient_date(x: str) -> str:
    return f"CASE WHEN regexp_matches(trim({x}), '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN try_cast(substr(trim({x}), 1, 10) AS DATE) END"


def money(x: str) -> str:
    return f"try_cast({x} AS DECIMAL(18,2))"


def number(x: str) -> str:
    return f"try_cast({x} AS DOUBLE)"


def full(x: str, pattern: str) -> str:
    return f"coalesce(regexp_full_match({x}, '{pattern}'), false)"


def errors(rules: list[tuple[str, str]]) -> str:
    return "concat_ws('; ', " + ", ".join(f"CASE WHEN {c} THEN {lit(m)} END" for c, m in rules) + ")"


def absent(c: str) -> tuple[str, str]:
    return (f"{c} IS NULL OR {c} = ''", f"{c} ausente")


def isin(c: str, values: list[str]) -> str:
    return f"coalesce({c} IN ({', '.join(lit(v) for v in values)}), false)"


CTES: dict[str, str] = {}
RULES: dict[str, list[tuple[str, str]]] = {}

for _name, _spec in A.RAW.items():
    CTES[f"raw_{_name}"] = select(_spec["columns"], _spec["table"], _spec.get("where"))
for _name, _spec in A.CURATED.items():
    CTES[_name] = select(_spec["columns"], _spec["table"], _spec.get("where"))

CTES["n_contracts"] = select(
    {
        "contract_id": blank_code('"Cód_Contrato"'),
        "contract_name": 'trim("Nome_Contrato")',
        "supplier_cnpj": digits('"CNPJ"'),
        "supplier_name": 'trim("Fornecedor")',
        "contract_category": slug('"Escopo"'),
        "validity_start_date": lenient_date('"Vigência Inicio"'),
        "validity_end_date": lenient_date('"Vigência Fim"'),
        "original_value": money('"Valor_Original"'),
        "total_value": money('"Valor_Total"'),
        "balance_value": money('"Saldo"'),
        "contract_type": slug('"Tipo_Contrato"'),
        "contract_status": slug('"Status"'),
        "risk_evaluation_date": lenient_date('"Data_Avaliacao_Risco"'),
        "final_risk": slug('"Risco_Final"'),
        "closure_reason": "nullif(trim(\"Motivo_Encerramento\"), '')",
    },
    "raw_contracts",
)
_money3 = ["original_value", "total_value", "balance_value"]
RULES["contracts"] = [
    ("contract_id = ''", "contract_id ausente"),
    (f"NOT {full('contract_id', 'CS[0-9]{8}')}", "contract_id deve seguir o padrão CS########"),
    ("contract_id <> '' AND count(*) OVER (PARTITION BY contract_id) > 1", "contract_id duplicado"),
    ("supplier_cnpj = ''", "supplier_cnpj ausente"),
    (f"NOT {full('supplier_cnpj', '[0-9]{14}')}", "supplier_cnpj deve conter 14 dígitos"),
    *[absent(c) for c in ("contract_name", "supplier_name", "contract_category", "final_risk")],
    (f"NOT {isin('contract_status', ['ativo', 'vencido', 'encerrado'])}", "contract_status inválido"),
    (f"NOT {isin('contract_type', ['novo_contrato', 'contrato_renovado'])}", "contract_type inválido"),
    ("validity_start_date IS NULL", "validity_start_date ausente ou inválida"),
    ("validity_end_date IS NULL", "validity_end_date ausente ou inválida"),
    ("validity_start_date > validity_end_date", "vigência inicial posterior à final"),
    *[
        r
        for c in _money3
        for r in ((f"{c} IS NULL", f"{c} ausente ou inválido"), (f"{c} < 0", f"{c} não pode ser negativo"))
    ],
    ("total_value < original_value", "total_value não pode ser menor que original_value"),
    ("balance_value > total_value", "balance_value não pode superar total_value"),
    ("contract_status = 'encerrado' AND risk_evaluation_date IS NULL", "encerrado sem data de avaliação de risco"),
    ("contract_status = 'encerrado' AND closure_reason IS NULL", "encerrado sem motivo de encerramento"),
    ("contract_status <> 'encerrado' AND closure_reason IS NOT NULL", "motivo de encerramento em contrato não encerrado"),
]

CTES["n_amendments_base"] = select(
    {
        "contract_id": blank_code('"Cód_Contrato"'),
        "amendment_type": slug('"Tipo_Aditamento"'),
        "validity_start_date": lenient_date('"Vigência_Inicio"'),
        "validity_end_date": lenient_date('"Vigência_Fim"'),
        "amendment_value": money('"Valor"'),
        "amendment_sequence": number('"Sequencia_Aditamento"'),
    },
    "raw_amendments",
)
CTES["n_amendments"] = """SELECT *,
  CASE WHEN contract_id <> '' AND amendment_sequence % 1 = 0
    THEN 'AMD-' || contract_id || '-' || lpad(CAST(CAST(amendment_sequence AS BIGINT) AS VARCHAR), CAST(greatest(4, length(CAST(CAST(amendment_sequence AS BIGINT) AS VARCHAR))) AS INT), '0') ELSE '' END AS amendment_id
FROM n_amendments_base"""
CTES["f_amendments"] = """SELECT n.*,
  n.contract_id IN (SELECT contract_id FROM stg_contracts) AS is_known,
  EXISTS (SELECT 1 FROM n_amendments r WHERE r.contract_id = n.contract_id AND r.amendment_type = 'renovacao'
    AND r.validity_start_date <= r.validity_end_date AND r.validity_start_date <= n.validity_start_date
    AND r.validity_end_date >= n.validity_end_date) AS is_inside
FROM n_amendments n"""
RULES["amendments"] = [
    ("contract_id = ''", "contract_id ausente"),
    (f"NOT {full('contract_id', 'CS[0-9]{8}')}", "contract_id deve seguir o padrão CS########"),
    ("contract_id <> '' AND NOT is_known", "contract_id não encontrado em stg_contratos"),
    (f"NOT {isin('amendment_type', ['renovacao', 'aporte'])}", "amendment_type inválido"),
    ("validity_start_date IS NULL", "validity_start_date ausente ou inválida"),
    ("validity_end_date IS NULL", "validity_end_date ausente ou inválida"),
    ("validity_start_date > validity_end_date", "vigência inicial posterior à final"),
    ("amendment_value IS NULL", "amendment_value ausente ou inválido"),
    ("amendment_value <= 0", "amendment_value deve ser positivo"),
    ("amendment_sequence IS NULL", "amendment_sequence ausente ou inválida"),
    ("amendment_sequence % 1 <> 0", "amendment_sequence deve ser inteira"),
    ("amendment_sequence <= 0", "amendment_sequence deve ser positiva"),
    (
        "contract_id <> '' AND amendment_sequence IS NOT NULL"
        " AND count(*) OVER (PARTITION BY contract_id, amendment_sequence) > 1",
        "evento de aditamento duplicado",
    ),
    (
        "amendment_type = 'aporte' AND validity_start_date <= validity_end_date AND NOT is_inside",
        "aporte fora da vigência de uma renovação",
    ),
]

CTES["n_payments"] = select(
    {
        "payment_id": blank_code('"Cód_Pagamento"'),
        "contract_id": blank_code('"Cód_Contrato"'),
        "supplier_cnpj": digits('"CNPJ"'),
        "supplier_cnpj8": f"substr({digits(chr(34) + 'CNPJ' + chr(34))}, 1, 8)",
        "supplier_name": 'trim("Fornecedor")',
        "payment_date": lenient_date('"Data_Pagamento"'),
        "payment_value": money('"Valor_Pago"'),
        "cost_center": 'upper(trim("Centro_Custo"))',
        "payment_category": slug('"Categoria"'),
    },
    "raw_payments",
)
CTES["f_payments"] = (
    "SELECT *, contract_id IN (SELECT contract_id FROM stg_contracts) AS is_known FROM n_payments"
)
RULES["payments"] = [
    ("payment_id = ''", "payment_id ausente"),
    (f"NOT {full('payment_id', 'PAG[0-9]{8}')}", "payment_id deve seguir o padrão PAG########"),
    ("payment_id <> '' AND count(*) OVER (PARTITION BY payment_id) > 1", "payment_id duplicado"),
    ("contract_id = ''", "contract_id ausente"),
    (f"NOT {full('contract_id', 'CS[0-9]{8}')}", "contract_id deve seguir o padrão CS########"),
    ("contract_id <> '' AND NOT is_known", "contract_id não encontrado em stg_contratos"),
    (f"NOT {full('supplier_cnpj', '[0-9]{14}')}", "supplier_cnpj inválido"),
    (f"NOT {full('supplier_cnpj8', '[0-9]{8}')}", "supplier_cnpj8 inválido"),
    absent("supplier_name"),
    ("payment_date IS NULL", "payment_date ausente ou inválida"),
    ("payment_value IS NULL", "payment_value ausente ou inválido"),
    ("payment_value <= 0", "payment_value deve ser positivo"),
    (f"NOT {full('cost_center', 'CC-[0-9]{3}')}", "cost_center inválido"),
    absent("payment_category"),
]

_scores = ["interest_to_revenue_ratio", "revenue_trend", "net_margin", "labor_cases_index"]
_levels = ["baixo", "medio", "alto"]
CTES["n_risk"] = select(
    {
        "risk_assessment_id": blank_code('"Id_Avaliacao_Risco"'),
        "supplier_cnpj": digits('"CNPJ"'),
        "supplier_cnpj8": f"substr({digits(chr(34) + 'CNPJ' + chr(34))}, 1, 8)",
        "assessment_date": lenient_date('"Data_Avaliacao"'),
        "last_approval_date": lenient_date('"Data_Ultima_Homologacao"'),
        "expiration_date": lenient_date('"Data_Expiracao"'),
        "homologation_result": slug('"Resultado_Homologacao"'),
        "homologation_status": slug('"Status_Homologacao"'),
        "financial_risk": slug('"Risco_Financeiro"'),
        "labor_risk": slug('"Risco_Trabalhista"'),
        "credit_rating": 'upper(trim("Rating_Credito"))',
        "final_risk": slug('"Risco_Final"'),
        "interest_to_revenue_ratio": number('"Indice_Juros_Sobre_Receita"'),
        "revenue_trend": number('"Tendencia_Faturamento"'),
        "net_margin": number('"Margem_Liquida"'),
        "labor_cases_index": number('"Indice_Processos_Trabalhistas"'),
    },
    "raw_risk",
)
CTES["f_risk"] = """SELECT *, CASE
    WHEN financial_risk NOT IN ('baixo', 'medio', 'alto') OR labor_risk NOT IN ('baixo', 'medio', 'alto') THEN NULL
    WHEN financial_risk = 'alto' OR labor_risk = 'alto' THEN 'alto'
    WHEN financial_risk = 'medio' OR labor_risk = 'medio' THEN 'medio' ELSE 'baixo' END AS expected_risk
FROM n_risk"""
_ref = f"DATE '{A.RISK_REFERENCE}'"
RULES["risk"] = [
    ("risk_assessment_id = ''", "risk_assessment_id ausente"),
    (f"NOT {full('risk_assessment_id', 'RSK[0-9]{9}')}", "risk_assessment_id deve seguir o padrão RSK#########"),
    ("risk_assessment_id <> '' AND count(*) OVER (PARTITION BY risk_assessment_id) > 1", "risk_assessment_id duplicado"),
    ("supplier_cnpj = ''", "supplier_cnpj ausente"),
    (f"NOT {full('supplier_cnpj', '[0-9]{14}')}", "supplier_cnpj deve conter 14 dígitos"),
    (f"NOT {full('supplier_cnpj8', '[0-9]{8}')}", "supplier_cnpj8 inválido"),
    ("assessment_date IS NULL", "assessment_date ausente ou inválida"),
    (f"NOT {isin('homologation_result', ['aprovada', 'reprovada'])}", "homologation_result inválido"),
    (f"NOT {isin('homologation_status', ['ativa', 'expirada', 'negada'])}", "homologation_status inválido"),
    *[(f"NOT {isin(c, _levels)}", f"{c} inválido") for c in ("financial_risk", "labor_risk", "final_risk")],
    (f"NOT {isin('credit_rating', ['AAA', 'AA', 'A', 'BBB', 'BB', 'B', 'CCC', 'CC', 'D'])}", "credit_rating inválido"),
    *[(f"{c} IS NULL", f"{c} ausente ou inválido") for c in _scores],
    ("interest_to_revenue_ratio < 0", "interest_to_revenue_ratio não pode ser negativo"),
    ("labor_cases_index < 0", "labor_cases_index não pode ser negativo"),
    ("final_risk <> expected_risk", "final_risk divergente dos riscos financeiro e trabalhista"),
    (
        f"homologation_result = 'aprovada' AND NOT {isin('homologation_status', ['ativa', 'expirada'])}",
        "homologação aprovada com status inválido",
    ),
    ("homologation_result = 'aprovada' AND final_risk = 'alto'", "homologação aprovada com risco final alto"),
    ("homologation_result = 'aprovada' AND last_approval_date IS NULL", "homologação aprovada sem data de aprovação"),
    ("homologation_result = 'aprovada' AND expiration_date IS NULL", "homologação aprovada sem data de expiração"),
    ("homologation_result = 'reprovada' AND homologation_status <> 'negada'", "homologação reprovada com status inválido"),
    ("homologation_result = 'reprovada' AND final_risk <> 'alto'", "homologação reprovada sem risco final alto"),
    ("homologation_result = 'reprovada' AND last_approval_date IS NOT NULL", "homologação reprovada com data de aprovação"),
    ("homologation_result = 'reprovada' AND expiration_date IS NOT NULL", "homologação reprovada com data de expiração"),
    ("last_approval_date > assessment_date", "data de aprovação posterior à avaliação"),
    ("expiration_date <= last_approval_date", "data de expiração anterior ou igual à aprovação"),
    (f"homologation_status = 'ativa' AND expiration_date < {_ref}", "homologação ativa expirada na data de referência"),
    (
        f"homologation_status = 'expirada' AND expiration_date >= {_ref}",
        "homologação expirada sem expiração na data de referência",
    ),
]

_yearly = [f"{m}_{y}" for m in ("faturamento", "custo", "lucro_bruto", "juros_divida", "lucro_liquido") for y in A.YEARS]
_fin = ["capital_social", *_yearly]
_counts = ["num_func_clt", "num_func_pj", "num_total_func", "processos_trabalhistas"]
_compared = [*_fin, "num_total_func"]
_numbers = [*_fin, *[f"custo_folha_{y}" for y in A.YEARS]]
CTES["n_companies"] = select(
    {
        **{c: digits(f'"{r}"') for c, r in (("cnpj", "CNPJ"), ("cnpj8", "CNPJ8"), ("cnpj_matriz", "CNPJ_Matriz"))},
        "razao_social": 'trim("Razao_Social")',
        "hierarquia": 'trim("Hierarquia")',
        "porte_empresa": 'trim("Porte_Empresa")',
        "atividade_economica": '"Atividade_Economica"',
        "ano_fundacao": 'try_cast("Ano_Fundacao" AS BIGINT)',
        "idade_empresa": 'try_cast("Idade_Empresa" AS BIGINT)',
        "estagio_empresa": '"Estagio_Empresa"',
        "cenario_financeiro": '"Cenario_Financeiro"',
        **{c: number(f'"{c}"') for c in _numbers},
        **{c: f'try_cast("{c}" AS BIGINT)' for c in _counts},
    },
    "raw_companies",
)
CTES["n_heads"] = (
    "SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY cnpj) AS copies FROM n_companies WHERE hierarquia = 'Matriz')"
    " WHERE copies = 1"
)
CTES["f_companies"] = (
    "SELECT c.*, h.cnpj AS head_cnpj, "
    + ", ".join(f"h.{c} AS head_{c}" for c in _compared)
    + " FROM n_companies c LEFT JOIN n_heads h ON c.hierarquia = 'Filial' AND c.cnpj_matriz = h.cnpj"
)
RULES["companies"] = [
    ("cnpj = ''", "cnpj ausente"),
    (f"NOT {full('cnpj', '[0-9]{14}')}", "cnpj deve conter 14 dígitos"),
    ("cnpj <> '' AND count(*) OVER (PARTITION BY cnpj) > 1", "cnpj duplicado"),
    ("cnpj8 = ''", "cnpj8 ausente"),
    (f"NOT {full('cnpj8', '[0-9]{8}')}", "cnpj8 deve conter 8 dígitos"),
    ("cnpj8 <> substr(cnpj, 1, 8)", "cnpj8 divergente do cnpj"),
    absent("razao_social"),
    (f"NOT {isin('hierarquia', ['Matriz', 'Filial'])}", "hierarquia inválida"),
    (f"NOT {isin('porte_empresa', ['Microempresa', 'Pequeno', 'Médio', 'Grande'])}", "porte_empresa inválido"),
    *[
        r
        for c in [*_fin, *_counts]
        for r in ((f"{c} IS NULL", f"{c} ausente ou inválido"), (f"{c} < 0", f"{c} não pode ser negativo"))
    ],
    ("num_func_clt + num_func_pj <> num_total_func", "total de funcionários divergente de clt + pj"),
    ("hierarquia = 'Matriz' AND cnpj_matriz <> cnpj", "matriz deve referenciar o próprio cnpj"),
    ("hierarquia = 'Filial' AND cnpj_matriz = ''", "filial sem cnpj_matriz"),
    ("hierarquia = 'Filial' AND head_cnpj IS NULL", "cnpj_matriz não encontrado ou não é matriz"),
    *[(f"hierarquia = 'Filial' AND {c} > head_{c}", f"{c} maior que o valor da matriz") for c in _compared],
]
FLAGGED = {
    "contracts": "n_contracts", "amendments": "f_amendments", "payments": "f_payments", "risk": "f_risk",
    "companies": "f_companies",
}
for _name, _source in FLAGGED.items():
    CTES[f"val_{_name}"] = f"SELECT *, {errors(RULES[_name])} AS validation_errors FROM {_source}"
    CTES[f"stg_{_name}"] = f"SELECT * FROM val_{_name} WHERE validation_errors = ''"


def rule_query(source: str, messages: list[str], key: str) -> str:
    """Row key and the text of the selected rules only."""
    chosen = [r for r in RULES[source] if r[1] in messages]
    missing = set(messages).difference(m for _, m in RULES[source])
    assert not missing, missing
    return sql(f"SELECT {key}, {errors(chosen)} AS validation_errors FROM {FLAGGED[source]}")


# ---- curated, from the valid staged rows
LOAD = f"DATE '{A.LOAD_DATE}'"
CTES["all_dates"] = f"""SELECT unnest([validity_start_date, validity_end_date, risk_evaluation_date]) AS d FROM stg_contracts
UNION ALL SELECT unnest([validity_start_date, validity_end_date]) FROM stg_amendments
UNION ALL SELECT payment_date FROM stg_payments
UNION ALL SELECT unnest([assessment_date, last_approval_date, expiration_date]) FROM stg_risk"""
CTES["cal_bounds"] = f"SELECT least(min(d), {LOAD}) AS lo, greatest(max(d), {LOAD}) AS hi FROM all_dates"
CTES["business_bounds"] = "SELECT min(d) AS lo, max(d) AS hi FROM all_dates"
CTES["cal"] = """SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS calendar_date FROM cal_bounds"""
CTES["cal_keys"] = "SELECT calendar_date, year(calendar_date) * 10000 + month(calendar_date) * 100 + day(calendar_date) AS calendar_key FROM cal"
TAXONOMY_VALUES = [
    ("aquisicao_de_equipamentos", "Aquisição de equipamentos", "capex_focused", "operacoes_e_suprimentos", "equipamentos"),
    ("consultoria", "Consultoria", "opex_focused", "servicos_profissionais", "consultoria"),
    ("licenca_de_software", "Licença de software", "opex_focused", "tecnologia", "software_e_licencas"),
    ("manutencao_e_suporte", "Manutenção e suporte", "opex_focused", "tecnologia", "suporte_tecnologico"),
    ("outsourcing_de_ti", "Outsourcing de TI", "opex_focused", "tecnologia", "servicos_de_ti"),
    ("servicos_de_infraestrutura", "Serviços de infraestrutura", "opex_focused", "tecnologia", "infraestrutura_tecnologica"),
    ("servicos_de_logistica", "Serviços de logística", "opex_focused", "operacoes_e_suprimentos", "logistica"),
    ("treinamento_e_capacitacao", "Treinamento e capacitação", "opex_focused", "servicos_profissionais", "treinamento_e_capacitacao"),
]
CTES["taxonomy"] = (
    "SELECT * FROM (VALUES "
    + ", ".join("(" + ", ".join(lit(x) for x in row) + ")" for row in TAXONOMY_VALUES)
    + ") t(code, name, macro, grp, family)"
)


def classified(codes: str) -> str:
    return f"""SELECT 'CAT-' || category_code AS category_key, category_code,
  coalesce(name, upper(substr(replace(category_code, '_', ' '), 1, 1)) || lower(substr(replace(category_code, '_', ' '), 2))) AS category_name,
  coalesce(macro, 'nao_classificada') AS category_macro_group,
  coalesce(grp, 'nao_classificada') AS category_group,
  coalesce(family, 'nao_classificada') AS category_family,
  code IS NOT NULL AS is_taxonomy_mapped
FROM ({codes}) LEFT JOIN taxonomy ON category_code = code"""


CTES["cat_codes"] = """SELECT DISTINCT category_code FROM (
  SELECT trim(contract_category) AS category_code FROM stg_contracts
  UNION ALL SELECT trim(payment_category) FROM stg_payments) WHERE category_code <> ''"""
CTES["cur_category"] = classified("SELECT category_code FROM cat_codes")
CTES["dim_category"] = classified(f"SELECT DISTINCT {A.choose('o_orderkey', A.CODES)} AS category_code FROM orders")
CTES["dim_calendar"] = (
    f"SELECT CAST(g AS DATE) AS calendar_date, {A.date_key('g')} AS calendar_key"
    " FROM (SELECT unnest(generate_series(a, b, INTERVAL 1 DAY)) AS g FROM (SELECT min(d) AS a, max(d) AS b FROM ("
    + " UNION ALL ".join(f"SELECT {d} AS d FROM {name}" for name, dates in A.KEYED_DATES.items() for d in dates)
    + ")))"
)
CTES["fact_supplier_financial"] = select(
    A.FINANCIAL_COLUMNS, f"(SELECT *, unnest([{', '.join(str(y) for y in A.FISCAL_YEARS)}]) AS y FROM supplier)"
)

ERR = "curated_validation_errors"
CTES["res_supplier"] = f"""SELECT *, {errors([
    (f"NOT {full('cnpj', '[0-9]{14}')}", "cnpj inválido"),
    (f"NOT {full('cnpj8', '[0-9]{8}')}", "cnpj8 inválido"),
    ("cnpj8 <> substr(cnpj, 1, 8)", "cnpj8 divergente do cnpj"),
    ("count(*) OVER (PARTITION BY cnpj) > 1", "cnpj duplicado na fonte curated"),
    ("razao_social = ''", "razao_social ausente"),
    (f"NOT {isin('hierarquia', ['Matriz', 'Filial'])}", "hierarquia inválida"),
    ("hierarquia = 'Matriz' AND cnpj_matriz <> cnpj", "matriz deve referenciar o próprio cnpj"),
    ("hierarquia = 'Filial' AND NOT has_head", "cnpj_matriz não encontrado como matriz"),
    (f"{full('cnpj8', '[0-9]{8}')} AND offices <> 1", "grupo econômico sem matriz única"),
])} AS {ERR},
  'SUP-' || cnpj AS supplier_key, 'GRP-' || cnpj8 AS economic_group_key,
  CASE WHEN hierarquia = 'Filial' THEN 'SUP-' || cnpj_matriz END AS parent_supplier_key
FROM (SELECT c.*, c.cnpj_matriz IN (SELECT cnpj FROM stg_companies WHERE hierarquia = 'Matriz') AS has_head,
  (SELECT count(*) FROM stg_companies h WHERE h.hierarquia = 'Matriz' AND h.cnpj8 = c.cnpj8) AS offices FROM stg_companies c)"""
CTES["cur_supplier"] = f"SELECT * FROM res_supplier WHERE {ERR} = ''"
CTES["res_contract"] = f"""SELECT *, {errors([
    ("count(*) OVER (PARTITION BY contract_id) > 1", "contract_id duplicado na fonte curated"),
    ("supplier_key IS NULL", "supplier_cnpj não encontrado em dim_supplier"),
    ("category_key IS NULL", "contract_category não encontrado em dim_category"),
    ("validity_start_calendar_key IS NULL", "validity_start_date não encontrado em dim_calendar"),
    ("validity_end_calendar_key IS NULL", "validity_end_date não encontrado em dim_calendar"),
    ("risk_evaluation_date IS NOT NULL AND risk_evaluation_calendar_key IS NULL", "risk_evaluation_date não encontrado em dim_calendar"),
])} AS {ERR}, 'CON-' || contract_id AS contract_key
FROM (SELECT c.*, s.supplier_key, s.economic_group_key, k.category_key, a.calendar_key AS validity_start_calendar_key,
    b.calendar_key AS validity_end_calendar_key, r.calendar_key AS risk_evaluation_calendar_key
  FROM stg_contracts c LEFT JOIN cur_supplier s ON c.supplier_cnpj = s.cnpj
  LEFT JOIN cur_category k ON c.contract_category = k.category_code
  LEFT JOIN cal_keys a ON c.validity_start_date = a.calendar_date
  LEFT JOIN cal_keys b ON c.validity_end_date = b.calendar_date
  LEFT JOIN cal_keys r ON c.risk_evaluation_date = r.calendar_date)"""
CTES["cur_contract"] = f"SELECT * FROM res_contract WHERE {ERR} = ''"
CTES["res_spending"] = f"""SELECT *, {errors([
    ("count(*) OVER (PARTITION BY payment_id) > 1", "payment_id duplicado na fonte curated"),
    ("contract_key IS NULL", "contract_id não encontrado em dim_contract"),
    ("supplier_key IS NULL", "supplier_cnpj não encontrado em dim_supplier"),
    ("category_key IS NULL", "payment_category não encontrado em dim_category"),
    ("payment_calendar_key IS NULL", "payment_date não encontrado em dim_calendar"),
    ("payment_value IS NULL", "payment_value ausente ou inválido"),
    ("payment_value <= 0", "payment_value deve ser positivo"),
    ("supplier_key <> contract_supplier_key", "supplier_key divergente do contrato"),
    ("category_key <> contract_category_key", "category_key divergente do contrato"),
])} AS {ERR}, 'SPN-' || payment_id AS spending_key
FROM (SELECT p.*, c.contract_key, c.supplier_key AS contract_supplier_key, c.category_key AS contract_category_key,
    s.supplier_key, s.economic_group_key, k.category_key, d.calendar_key AS payment_calendar_key
  FROM stg_payments p LEFT JOIN cur_contract c ON p.contract_id = c.contract_id
  LEFT JOIN cur_supplier s ON p.supplier_cnpj = s.cnpj
  LEFT JOIN cur_category k ON p.payment_category = k.category_code
  LEFT JOIN cal_keys d ON p.payment_date = d.calendar_date)"""
CTES["cur_spending"] = f"SELECT * FROM res_spending WHERE {ERR} = ''"
CTES["res_rfi"] = f"""SELECT *, {errors([
    ("count(*) OVER (PARTITION BY risk_assessment_id) > 1", "risk_assessment_id duplicado na fonte curated"),
    ("supplier_key IS NULL", "supplier_cnpj não encontrado em dim_supplier"),
    ("assessment_calendar_key IS NULL", "assessment_date não encontrado em dim_calendar"),
    ("last_approval_date IS NOT NULL AND last_approval_calendar_key IS NULL", "last_approval_date não encontrado em dim_calendar"),
    ("expiration_date IS NOT NULL AND expiration_calendar_key IS NULL", "expiration_date não encontrado em dim_calendar"),
])} AS {ERR}, 'RFI-' || risk_assessment_id AS rfi_key
FROM (SELECT r.*, s.supplier_key, s.economic_group_key, a.calendar_key AS assessment_calendar_key,
    l.calendar_key AS last_approval_calendar_key, e.calendar_key AS expiration_calendar_key
  FROM stg_risk r LEFT JOIN cur_supplier s ON r.supplier_cnpj = s.cnpj
  LEFT JOIN cal_keys a ON r.assessment_date = a.calendar_date
  LEFT JOIN cal_keys l ON r.last_approval_date = l.calendar_date
  LEFT JOIN cal_keys e ON r.expiration_date = e.calendar_date)"""
CTES["cur_rfi"] = f"SELECT * FROM res_rfi WHERE {ERR} = ''"
CTES["res_renewal"] = f"""SELECT *, {errors([
    ("count(*) OVER (PARTITION BY amendment_id) > 1", "amendment_id duplicado na fonte curated"),
    ("contract_key IS NULL", "contract_id não encontrado em dim_contract"),
    ("validity_start_calendar_key IS NULL", "validity_start_date não encontrado em dim_calendar"),
    ("validity_end_calendar_key IS NULL", "validity_end_date não encontrado em dim_calendar"),
    ("amendment_value IS NULL", "amendment_value ausente ou inválido"),
    ("amendment_value <= 0", "amendment_value deve ser positivo"),
])} AS {ERR}, 'RNL-' || amendment_id AS renewal_key, amendment_type = 'renovacao' AS is_renewal
FROM (SELECT m.*, c.contract_key, c.supplier_key, c.economic_group_key, c.category_key,
    a.calendar_key AS validity_start_calendar_key, b.calendar_key AS validity_end_calendar_key
  FROM stg_amendments m LEFT JOIN cur_contract c ON m.contract_id = c.contract_id
  LEFT JOIN cal_keys a ON m.validity_start_date = a.calendar_date
  LEFT JOIN cal_keys b ON m.validity_end_date = b.calendar_date)"""
CTES["cur_renewal"] = f"SELECT * FROM res_renewal WHERE {ERR} = ''"
_measures = {
    "faturamento": "gross_revenue", "custo": "total_cost", "custo_folha": "payroll_cost",
    "lucro_bruto": "gross_profit", "juros_divida": "debt_interest", "lucro_liquido": "net_income",
}
CTES["yearly_figures"] = "\nUNION ALL ".join(
    f"SELECT cnpj, {y} AS financial_year, DATE '{y}-12-31' AS financial_period_end_date, 'FIN-' || cnpj || '-{y}' AS financial_snapshot_key, "
    + ", ".join(f"{s}_{y} AS {t}" for s, t in _measures.items())
    + " FROM stg_companies"
    for y in A.YEARS
)
CTES["res_financial"] = f"""SELECT *, {errors([
    ("count(*) OVER (PARTITION BY financial_snapshot_key) > 1", "financial_snapshot_key duplicada na fonte curated"),
    ("supplier_key IS NULL", "cnpj não encontrado em dim_supplier"),
    ("financial_period_calendar_key IS NULL", "financial_period_end_date não encontrado em dim_calendar"),
    *[r for t in _measures.values() for r in ((f"{t} IS NULL", f"{t} ausente ou inválida"), (f"{t} < 0", f"{t} não pode ser negativa"))],
    ("payroll_cost > total_cost", "payroll_cost maior que total_cost"),
    ("total_cost > gross_revenue", "total_cost maior que gross_revenue"),
    ("gross_profit > gross_revenue", "gross_profit maior que gross_revenue"),
    ("net_income > gross_profit", "net_income maior que gross_profit"),
])} AS {ERR}
FROM (SELECT f.*, s.supplier_key, s.economic_group_key, d.calendar_key AS financial_period_calendar_key
  FROM yearly_figures f LEFT JOIN cur_supplier s ON f.cnpj = s.cnpj
  LEFT JOIN cal_keys d ON f.financial_period_end_date = d.calendar_date)"""
CTES["cur_financial"] = f"SELECT * FROM res_financial WHERE {ERR} = ''"

# ---- analytic views on the curated adapters
CTES["vw_suppliers"] = """SELECT s.supplier_key, s.supplier_cnpj, s.supplier_legal_name, s.supplier_hierarchy, s.company_size,
  s.economic_activity, s.economic_group_key, g.economic_group_legal_name, s.parent_supplier_key, s.financial_scenario
FROM dim_supplier s LEFT JOIN dim_economic_group g USING (economic_group_key)"""
_cat = "k.category_key, k.category_code, k.category_name, k.category_macro_group, k.category_group, k.category_family"
CTES["vw_contracts"] = f"""SELECT c.contract_key, c.contract_id, c.contract_name, c.contract_type, c.contract_status, c.final_risk,
  c.original_value, c.total_value, c.balance_value, s.supplier_key, s.supplier_legal_name, s.economic_group_key, {_cat},
  a.calendar_date AS validity_start_date, b.calendar_date AS validity_end_date
FROM dim_contract c JOIN dim_supplier s ON c.supplier_key = s.supplier_key JOIN dim_category k ON c.category_key = k.category_key
LEFT JOIN dim_calendar a ON c.validity_start_calendar_key = a.calendar_key
LEFT JOIN dim_calendar b ON c.validity_end_calendar_key = b.calendar_key"""
CTES["vw_spending"] = f"""SELECT p.spending_key, p.payment_id, p.payment_value, p.cost_center, d.calendar_date AS payment_date,
  c.contract_key, c.contract_id, c.contract_status, s.supplier_key, s.supplier_legal_name, s.economic_group_key, {_cat}
FROM fact_spending p JOIN dim_contract c ON p.contract_key = c.contract_key JOIN dim_supplier s ON p.supplier_key = s.supplier_key
JOIN dim_category k ON p.category_key = k.category_key LEFT JOIN dim_calendar d ON p.payment_calendar_key = d.calendar_key"""
CTES["vw_renewals"] = f"""SELECT r.renewal_key, r.amendment_id, r.amendment_sequence, r.amendment_type, r.is_renewal, r.amendment_value,
  c.contract_key, c.contract_id, s.supplier_key, s.supplier_legal_name, {_cat},
  a.calendar_date AS validity_start_date, b.calendar_date AS validity_end_date
FROM fact_renewal r JOIN dim_contract c ON r.contract_key = c.contract_key JOIN dim_supplier s ON r.supplier_key = s.supplier_key
JOIN dim_category k ON r.category_key = k.category_key
LEFT JOIN dim_calendar a ON r.validity_start_calendar_key = a.calendar_key
LEFT JOIN dim_calendar b ON r.validity_end_calendar_key = b.calendar_key"""
CTES["vw_rfi"] = """SELECT r.rfi_key, r.risk_assessment_id, a.calendar_date AS assessment_date, l.calendar_date AS last_approval_date,
  e.calendar_date AS expiration_date, r.homologation_result, r.homologation_status, r.financial_risk, r.labor_risk, r.credit_rating,
  r.final_risk, r.interest_to_revenue_ratio, r.revenue_trend, r.net_margin, r.labor_cases_index,
  s.supplier_key, s.supplier_cnpj, s.supplier_legal_name, s.economic_group_key
FROM fact_rfi r JOIN dim_supplier s ON r.supplier_key = s.supplier_key
LEFT JOIN dim_calendar a ON r.assessment_calendar_key = a.calendar_key
LEFT JOIN dim_calendar l ON r.last_approval_calendar_key = l.calendar_key
LEFT JOIN dim_calendar e ON r.expiration_calendar_key = e.calendar_key"""
CTES["annualized"] = """SELECT f.supplier_key, f.financial_year,
  SUM(CAST(c.total_value AS DOUBLE) / CAST(nullif(date_diff('day', a.calendar_date, b.calendar_date) + 1, 0) AS DOUBLE) * 365.25) AS annualized_contract_value
FROM fact_supplier_financial f JOIN dim_calendar p ON f.financial_period_calendar_key = p.calendar_key
JOIN dim_contract c ON f.supplier_key = c.supplier_key
JOIN dim_calendar a ON c.validity_start_calendar_key = a.calendar_key
JOIN dim_calendar b ON c.validity_end_calendar_key = b.calendar_key
WHERE a.calendar_date <= p.calendar_date AND b.calendar_date >= date_trunc('year', p.calendar_date)
GROUP BY f.supplier_key, f.financial_year"""
CTES["vw_supplier_financials"] = """SELECT f.financial_snapshot_key, f.financial_year, p.calendar_date AS financial_period_end_date,
  f.gross_revenue, f.total_cost, f.payroll_cost, f.gross_profit, f.debt_interest, f.net_income,
  f.gross_profit / nullif(f.gross_revenue, 0) AS gross_margin, f.net_income / nullif(f.gross_revenue, 0) AS net_margin,
  coalesce(c.annualized_contract_value, 0) AS annualized_contract_value,
  coalesce(c.annualized_contract_value, 0) / nullif(f.gross_revenue, 0) AS financial_dependency_ratio,
  f.gross_revenue / nullif(c.annualized_contract_value, 0) AS revenue_to_contract_coverage_ratio,
  s.supplier_key, s.supplier_cnpj, s.supplier_legal_name, s.supplier_hierarchy, s.economic_group_key, g.economic_group_legal_name
FROM fact_supplier_financial f JOIN dim_supplier s ON f.supplier_key = s.supplier_key
LEFT JOIN dim_economic_group g ON f.economic_group_key = g.economic_group_key
LEFT JOIN dim_calendar p ON f.financial_period_calendar_key = p.calendar_key
LEFT JOIN annualized c ON f.supplier_key = c.supplier_key AND f.financial_year = c.financial_year"""
CTES["latest_risk"] = """SELECT * EXCLUDE (rank) FROM (SELECT *, row_number() OVER (PARTITION BY supplier_key
  ORDER BY assessment_date DESC, risk_assessment_id DESC) AS rank FROM vw_rfi) WHERE rank = 1"""

_WORD = re.compile(r"\w+")


def show(columns: str) -> str:
    """Select list from `name`, `name:d` (date as text), `name:n` (as DOUBLE), `name:i` (as BIGINT)."""
    types = {"d": "VARCHAR", "n": "DOUBLE", "i": "BIGINT"}
    parts = [c.partition(":") for c in columns.split()]
    return ", ".join(f"CAST({n} AS {types[t]}) AS {n}" if t else n for n, _, t in parts)


def sql(body: str, **extra: str) -> str:
    """`body` preceded by every CTE it needs, in dependency order."""
    pool = {**CTES, **extra}
    done: list[str] = []

    def visit(name: str, path: tuple[str, ...] = ()) -> None:
        if name in done or name in path:
            return
        for other in sorted(set(_WORD.findall(pool[name])).intersection(pool)):
            if other != name:
                visit(other, (*path, name))
        done.append(name)

    for name in sorted(set(_WORD.findall(body)).intersection(pool)):
        visit(name)
    if not done:
        return body
    listed = ",\n".join(f"{n} AS MATERIALIZED ({pool[n]})" for n in done)
    return f"WITH {listed}\n{body}"
