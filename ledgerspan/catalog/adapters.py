"""The test tables seen as the five RAW sources and as the curated tables.

The column expressions are plain SQL that Spark and DuckDB read alike, so each adapter is written
once: the queries select it with `selectExpr`, the oracle puts it in a CTE. Deterministic defects
(bad dates, unknown suppliers, repeated ids, wrong totals) make every rule fire on some rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerspan.catalog.store import stored
from ledgerspan.functions.dates import calendar_attributes

LOAD_DATE = "2024-06-30"
BATCH_ID = "20240630_120000"
AS_OF = "2000-01-01"  # reference date of the portfolio queries
RISK_REFERENCE = "2024-06-30"
YEARS = (2022, 2023, 2024, 2025, 2026)
FISCAL_YEARS = (1997, 1998, 1999, 2000, 2001)  # of the curated financial fact: the years of the orders
CATEGORIES = (
    ("Aquisição de Equipamentos", "aquisicao_de_equipamentos"),
    ("Consultoria", "consultoria"),
    ("Licença de Software", "licenca_de_software"),
    ("Manutenção e Suporte", "manutencao_e_suporte"),
    ("Outsourcing de TI", "outsourcing_de_ti"),
    ("Serviços de Logística", "servicos_de_logistica"),
    ("Treinamento e Capacitação", "treinamento_e_capacitacao"),
    ("Serviços de Infraestrutura", "servicos_de_infraestrutura"),
    ("Limpeza Predial", "limpeza_predial"),
)


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def text(x: str) -> str:
    return f"CAST({x} AS STRING)"


def padded(x: str, n: int) -> str:
    """Digits filled up with zeros to `n` places; longer numbers stay whole (and fail a fixed format visibly)."""
    return f"lpad({text(x)}, CAST(greatest({n}, length({text(x)})) AS INT), '0')"


def div(x: str, n: int) -> str:
    return big(f"floor(({x}) / {n})")


def cents(x: str) -> str:
    return f"CAST({x} AS DECIMAL(18,2))"


def days_after(d: str, n: str) -> str:
    return f"({d} + CAST({n} AS INT))"


def day(x: str) -> str:
    return f"CAST({x} AS DATE)"


def choose(x: str, values) -> str:
    values = list(values)
    cases = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"(CASE ({x}) % {len(values)} {cases} END)"


def unless(condition: str, value: str, otherwise: str) -> str:
    return f"CASE WHEN {condition} THEN {otherwise} ELSE {value} END"


def cnpj(i: str) -> str:
    return f"({padded(f'({i}) % 25', 8)} || {padded(div(i, 25), 6)})"


def root(i: str) -> str:
    return padded(f"({i}) % 25", 8)


def dotted(c: str) -> str:
    parts = [f"substr({c}, {a}, {n})" for a, n in ((1, 2), (3, 3), (6, 3), (9, 4), (13, 2))]
    return f"({parts[0]} || '.' || {parts[1]} || '.' || {parts[2]} || '/' || {parts[3]} || '-' || {parts[4]})"


def date_key(d: str) -> str:
    return big(f"year({d}) * 10000 + month({d}) * 100 + day({d})")


# One supplier owns 150 consecutive orders; customers do not matter here.
ORDER_SUPPLIER = div("o_orderkey", 150)
LINE_SUPPLIER = div("l_orderkey", 150)
EVENT_SUPPLIER = div("user_id * 2", 3)
CODES = [c for _, c in CATEGORIES]
LABELS = [n for n, _ in CATEGORIES]

_start = day("o_orderdate")
_end = days_after(_start, "30 + o_orderkey % 1500")
_total = cents("o_totalprice")
_original = cents(f"{_total} * 0.8")
_balance = cents(f"{_total} * CAST(o_orderkey % 10 AS DECIMAL(2,0)) * 0.1")
_ship = day("l_shipdate")
_span = "(CASE WHEN l_returnflag = 'R' THEN 40 ELSE 10 END) * CAST(l_quantity AS INT)"
_assessed = f"({day('ts')} - CAST((event_id % 4) * 365 AS INT))"
_passed = "event_type <> 'error'"
_expires = days_after(_assessed, "1460")
_fin = "(CASE WHEN event_type = 'error' THEN 'Alto' WHEN value > 60 THEN 'Médio' ELSE 'Baixo' END)"
_lab = choose("event_id", ["Baixo", "Médio", "Baixo"])
_final = f"(CASE WHEN event_type = 'error' THEN 'Alto' WHEN {_fin} = 'Médio' OR {_lab} = 'Médio' THEN 'Médio' ELSE 'Baixo' END)"

# Yearly figures of a supplier: revenue by a factor per year, the rest as shares of it.
_head = "s_suppkey < 25"
_base = (
    f"(CASE WHEN {_head} OR s_suppkey % 53 = 30 THEN 9000000 ELSE 0 END"
    f" + {cents('abs(s_acctbal) * 100')} + 1000)"
)
FACTOR = {2022: "1.00", 2023: "1.10", 2024: "0.90", 2025: "1.20", 2026: "1.05"}
SHARE = {
    "Faturamento": "1.00", "Custo": "0.70", "Custo_Folha": "0.20", "Lucro_Bruto": "0.30",
    "Juros_Divida": "0.03", "Lucro_Liquido": "0.10",
}


def figure(measure: str, year: int) -> str:
    value = cents(f"{cents(_base)} * {FACTOR[year]} * {SHARE[measure]}")
    if measure == "Juros_Divida":
        value = cents(f"{value} * CAST(s_suppkey % 3 AS DECIMAL(2,0))")
    if measure == "Lucro_Liquido":
        value = f"(CASE WHEN s_suppkey % 29 = 7 THEN 0 - {value} ELSE {value} END)"
    return value


_i = "s_suppkey"
RAW: dict[str, dict] = {
    "companies": {
        "table": "supplier",
        "columns": {
            "CNPJ": unless("s_suppkey % 67 = 60", dotted(cnpj(_i)), dotted(cnpj(f"{_i} - 25"))),
            "CNPJ8": unless("s_suppkey % 37 = 26", root(_i), "'99999999'"),
            "CNPJ_Matriz": unless("s_suppkey % 47 = 40", dotted(cnpj(f"{_i} % 25")), "''"),
            "Razao_Social": "'  ' || s_name || ' '",
            "Atividade_Economica": choose(_i, ["Tecnologia", "Consultoria", "Logística"]),
            "Ano_Fundacao": text("1960 + s_suppkey % 60"),
            "Idade_Empresa": text("2026 - (1960 + s_suppkey % 60)"),
            "Estagio_Empresa": choose(_i, ["Jovem", "Madura"]),
            "Cenario_Financeiro": choose(_i, ["Estável", "Em decadência", "Em crescimento"]),
            "Hierarquia": f"CASE WHEN {_head} THEN 'Matriz' WHEN s_suppkey % 59 = 40 THEN 'Agência' ELSE 'Filial' END",
            "Capital_Social": text(cents(f"{cents(_base)} * 0.10")),
            "Porte_Empresa": unless("s_suppkey % 61 = 50", f"CASE WHEN {_head} THEN 'Médio' ELSE 'Pequeno' END", "'Enorme'"),
            "Receita_Por_Funcionario": text(cents(f"{cents(_base)} * 0.01")),
            "Num_Func_CLT": text(f"s_suppkey % 40 + 1 + (CASE WHEN {_head} THEN 500 ELSE 0 END)"),
            "Num_Func_PJ": text("s_suppkey % 7"),
            "Num_Total_Func": text(
                f"s_suppkey % 40 + 1 + (CASE WHEN {_head} THEN 500 ELSE 0 END) + s_suppkey % 7"
                " + (CASE WHEN s_suppkey % 41 = 38 THEN 1 ELSE 0 END)"
            ),
            "Processos_Trabalhistas": unless("s_suppkey % 43 = 41", text("s_suppkey % 9"), "'muitos'"),
            **{
                f"{m}_{y}": unless("s_suppkey % 31 = 28", text(figure(m, y)), "NULL")
                if (m, y) == ("Faturamento", 2024)
                else text(figure(m, y))
                for m in SHARE
                for y in YEARS
            },
        },
    },
    "contracts": {
        "table": "orders",
        "shared": (cnpj(ORDER_SUPPLIER),),
        "columns": {
            "Cód_Contrato": (
                f"CASE WHEN o_orderkey % 101 = 7 THEN 'X' || {text('o_orderkey')}"
                f" WHEN o_orderkey % 97 = 1 THEN 'CS' || {padded('o_orderkey - 1', 8)}"
                f" WHEN o_orderkey % 11 = 0 THEN ' cs' || {padded('o_orderkey', 8)} || ' '"
                f" WHEN o_orderkey % 113 = 4 THEN NULL ELSE 'CS' || {padded('o_orderkey', 8)} END"
            ),
            "Nome_Contrato": unless("o_orderkey % 89 = 3", f"'Contrato ' || {text('o_orderkey')}", "' '"),
            "CNPJ": unless("o_orderkey % 83 = 9", dotted(cnpj(ORDER_SUPPLIER)), "'99.999.999/0001-99'"),
            "Fornecedor": f"'Supplier#' || {padded(ORDER_SUPPLIER, 9)}",
            "Escopo": choose("o_orderkey", LABELS),
            "Vigência Inicio": unless("o_orderkey % 79 = 2", text(_start), "'data-inválida'"),
            "Vigência Fim": unless("o_orderkey % 71 = 5", text(_end), text(f"({_start} - CAST(10 AS INT))")),
            "Valor_Original": unless("o_orderkey % 73 = 6", text(_original), text(f"{_total} + 1")),
            "Valor_Total": unless("o_orderkey % 103 = 8", text(_total), "'n/d'"),
            "Saldo": f"CASE WHEN o_orderkey % 67 = 4 THEN '-1.00' WHEN o_orderkey % 61 = 6 THEN {text(f'{_total} + 2')} ELSE {text(_balance)} END",
            "Tipo_Contrato": unless("o_orderkey % 59 = 8", choose("o_orderkey", ["Novo Contrato", "Contrato Renovado"]), "'Outro'"),
            "Status": "CASE o_orderstatus WHEN 'O' THEN 'Ativo' WHEN 'F' THEN ' VENCIDO ' ELSE 'Encerrado' END",
            "Data_Avaliacao_Risco": f"CASE WHEN o_orderstatus = 'P' AND o_orderkey % 53 <> 2 THEN {text(_start)} || ' 00:00:00' ELSE '' END",
            "Risco_Final": choose("o_orderkey", ["Baixo", "Médio", "Alto"]),
            "Motivo_Encerramento": (
                "CASE WHEN o_orderstatus = 'P' AND o_orderkey % 43 <> 1 THEN 'Homologação negada por risco final alto'"
                " WHEN o_orderstatus <> 'P' AND o_orderkey % 47 = 2 THEN 'indevido' ELSE '' END"
            ),
        },
    },
    "amendments": {
        "table": "lineitem",
        "columns": {
            "Cód_Contrato": f"'CS' || {padded('l_orderkey', 8)}",
            "Tipo_Aditamento": "CASE WHEN l_partkey % 83 = 5 THEN 'Outro' WHEN l_returnflag = 'R' THEN 'Renovação' ELSE 'Aporte' END",
            "Vigência_Inicio": unless("l_partkey % 79 = 3", text(_ship), "'2026-13-40'"),
            "Vigência_Fim": unless("l_partkey % 71 = 5", text(days_after(_ship, _span)), text(f"({_ship} - CAST(1 AS INT))")),
            "Valor": unless("l_partkey % 91 = 5", text(cents("l_extendedprice")), "'0'"),
            "Sequencia_Aditamento": f"CASE WHEN l_partkey % 77 = 3 THEN '1.5' WHEN l_partkey % 107 = 4 THEN NULL ELSE {text('l_linenumber')} END",
        },
    },
    "payments": {
        "table": "lineitem",
        "shared": (cnpj(LINE_SUPPLIER), cnpj(f"{LINE_SUPPLIER} + 1")),
        "columns": {
            "Cód_Pagamento": unless("l_partkey % 89 = 2", f"'pag' || {padded('l_orderkey * 10 + l_linenumber', 8)}", "'P1'"),
            "Cód_Contrato": f"'CS' || {padded('l_orderkey', 8)}",
            "CNPJ": unless("l_linenumber = 7", dotted(cnpj(LINE_SUPPLIER)), dotted(cnpj(f"{LINE_SUPPLIER} + 1"))),
            "Fornecedor": f"'Supplier#' || {padded(LINE_SUPPLIER, 9)}",
            "Data_Pagamento": unless("l_partkey % 83 = 6", text(_ship), "'data-inválida'"),
            "Valor_Pago": unless("l_partkey % 91 = 4", text(cents("l_extendedprice")), "'0.00'"),
            "Centro_Custo": unless("l_partkey % 73 = 1", f"'cc-' || {text('(l_orderkey % 9 + 1) * 100')}", "'CC-1'"),
            "Categoria": choose("l_orderkey + (CASE WHEN l_linenumber = 6 THEN 1 ELSE 0 END)", LABELS),
        },
    },
    "risk": {
        "table": "events",
        "shared": (cnpj(EVENT_SUPPLIER),),
        "columns": {
            "Id_Avaliacao_Risco": f"'RSK' || {padded('CASE WHEN event_id % 97 = 1 THEN event_id - 1 ELSE event_id END', 9)}",
            "CNPJ": unless("event_id % 89 = 2", dotted(cnpj(EVENT_SUPPLIER)), "'invalido'"),
            "Data_Avaliacao": unless("event_id % 83 = 3", text(_assessed), "''"),
            "Data_Ultima_Homologacao": f"CASE WHEN {_passed} THEN {text(days_after(_assessed, 'CASE WHEN event_id % 59 = 3 THEN 5 ELSE 0 END'))} ELSE '' END",
            "Data_Expiracao": f"CASE WHEN {_passed} AND event_id % 61 <> 4 THEN {text(_expires)} ELSE '' END",
            "Resultado_Homologacao": unless("event_id % 101 = 5", f"CASE WHEN {_passed} THEN 'Aprovada' ELSE 'Reprovada' END", "'Talvez'"),
            "Status_Homologacao": f"CASE WHEN NOT ({_passed}) THEN 'Negada' WHEN {_expires} < DATE '2024-12-31' THEN 'Expirada' ELSE 'Ativa' END",
            "Risco_Financeiro": _fin,
            "Risco_Trabalhista": _lab,
            "Rating_Credito": choose("event_id", ["aaa", "AA", "bbb", "D", "E"]),
            "Risco_Final": unless("event_id % 71 = 6", _final, "'Médio'"),
            "Indice_Juros_Sobre_Receita": text("CAST(value AS DECIMAL(18,2))"),
            "Tendencia_Faturamento": text("CAST(value AS DECIMAL(18,2)) - 50"),
            "Margem_Liquida": unless("event_id % 103 = 7", "'0.10'", "'x'"),
            "Indice_Processos_Trabalhistas": unless("event_id % 107 = 8", "'1.2'", "'-1'"),
        },
    },
}

CONTRACT_ID = f"('CS' || {padded('o_orderkey', 8)})"
LINE_CONTRACT_ID = f"('CS' || {padded('l_orderkey', 8)})"
PAYMENT_ID = f"('PAG' || {padded('l_orderkey * 10 + l_linenumber', 8)})"
AMENDMENT_ID = f"('AMD-' || {LINE_CONTRACT_ID} || '-' || {padded('l_linenumber', 4)})"


def _keys(i: str) -> dict[str, str]:
    return {"supplier_key": f"'SUP-' || {cnpj(i)}", "economic_group_key": f"'GRP-' || {root(i)}"}


CURATED: dict[str, dict] = {
    "dim_supplier": {
        "table": "supplier",
        "columns": {
            **_keys("s_suppkey"),
            "supplier_cnpj": cnpj("s_suppkey"),
            "supplier_cnpj8": root("s_suppkey"),
            "parent_supplier_key": f"CASE WHEN s_suppkey >= 25 THEN 'SUP-' || {cnpj('s_suppkey % 25')} END",
            "parent_supplier_cnpj": cnpj("s_suppkey % 25"),
            "supplier_legal_name": "s_name",
            "supplier_hierarchy": f"CASE WHEN {_head} THEN 'Matriz' ELSE 'Filial' END",
            "company_size": f"CASE WHEN {_head} THEN 'Médio' ELSE 'Pequeno' END",
            "economic_activity": choose("s_suppkey", ["Tecnologia", "Consultoria", "Logística"]),
            "financial_scenario": choose("s_suppkey", ["Estável", "Em decadência", "Em crescimento"]),
        },
    },
    "dim_economic_group": {
        "table": "supplier",
        "where": _head,
        "columns": {
            "economic_group_key": f"'GRP-' || {root('s_suppkey')}",
            "matrix_supplier_key": f"'SUP-' || {cnpj('s_suppkey')}",
            "economic_group_legal_name": "s_name",
        },
    },
    "dim_contract": {
        "table": "orders",
        "columns": {
            "contract_key": f"'CON-' || {CONTRACT_ID}",
            "contract_id": CONTRACT_ID,
            **_keys(ORDER_SUPPLIER),
            "category_key": f"'CAT-' || {choose('o_orderkey', CODES)}",
            "validity_start_calendar_key": date_key(_start),
            "validity_end_calendar_key": date_key(_end),
            "contract_name": f"'Contrato ' || {text('o_orderkey')}",
            "contract_type": choose("o_orderkey", ["novo_contrato", "contrato_renovado"]),
            "contract_status": "CASE o_orderstatus WHEN 'O' THEN 'ativo' WHEN 'F' THEN 'vencido' ELSE 'encerrado' END",
            "final_risk": choose("o_orderkey", ["baixo", "medio", "alto"]),
            "original_value": _original,
            "total_value": _total,
            "balance_value": _balance,
        },
    },
    "fact_spending": {
        "table": "lineitem",
        "columns": {
            "spending_key": f"'SPN-' || {PAYMENT_ID}",
            "payment_id": PAYMENT_ID,
            "contract_key": f"'CON-' || {LINE_CONTRACT_ID}",
            **_keys(LINE_SUPPLIER),
            "category_key": f"'CAT-' || {choose('l_orderkey', CODES)}",
            "payment_calendar_key": date_key(_ship),
            "cost_center": f"'CC-' || {text('(l_orderkey % 9 + 1) * 100')}",
            "payment_value": cents("l_extendedprice"),
        },
    },
    "fact_renewal": {
        "table": "lineitem",
        "columns": {
            "renewal_key": f"'RNL-' || {AMENDMENT_ID}",
            "amendment_id": AMENDMENT_ID,
            "amendment_sequence": big("l_linenumber"),
            "amendment_type": "CASE WHEN l_returnflag = 'R' THEN 'renovacao' ELSE 'aporte' END",
            "is_renewal": "l_returnflag = 'R'",
            "contract_key": f"'CON-' || {LINE_CONTRACT_ID}",
            **_keys(LINE_SUPPLIER),
            "category_key": f"'CAT-' || {choose('l_orderkey', CODES)}",
            "validity_start_calendar_key": date_key(_ship),
            "validity_end_calendar_key": date_key(days_after(_ship, _span)),
            "amendment_value": cents("l_extendedprice"),
        },
    },
    "fact_rfi": {
        "table": "events",
        "columns": {
            "rfi_key": f"'RFI-RSK' || {padded('event_id', 9)}",
            "risk_assessment_id": f"'RSK' || {padded('event_id', 9)}",
            **_keys(EVENT_SUPPLIER),
            "assessment_calendar_key": date_key(_assessed),
            "last_approval_calendar_key": f"CASE WHEN {_passed} THEN {date_key(_assessed)} END",
            "expiration_calendar_key": f"CASE WHEN {_passed} THEN {date_key(_expires)} END",
            "homologation_result": f"CASE WHEN {_passed} THEN 'aprovada' ELSE 'reprovada' END",
            "homologation_status": f"CASE WHEN NOT ({_passed}) THEN 'negada' WHEN {_expires} < DATE '{RISK_REFERENCE}' THEN 'expirada' ELSE 'ativa' END",
            "financial_risk": "(CASE WHEN event_type = 'error' THEN 'alto' WHEN value > 60 THEN 'medio' ELSE 'baixo' END)",
            "labor_risk": choose("event_id", ["baixo", "medio", "baixo"]),
            "credit_rating": choose("event_id", ["AAA", "AA", "BBB", "D"]),
            "final_risk": f"(CASE WHEN event_type = 'error' THEN 'alto' WHEN value > 60 OR {_lab} = 'Médio' THEN 'medio' ELSE 'baixo' END)",
            "interest_to_revenue_ratio": "value",
            "revenue_trend": "value - 50",
            "net_margin": "value / 100",
            "labor_cases_index": "value * 2",
        },
    },
}

FINANCIAL_SHARES = {
    "gross_revenue": "1.00", "total_cost": "0.70", "payroll_cost": "0.20", "gross_profit": "0.30",
    "debt_interest": "0.03", "net_income": "0.10",
}
_factor_of_year = "(CASE y " + " ".join(f"WHEN {y} THEN {f}" for y, f in zip(FISCAL_YEARS, FACTOR.values())) + " END)"
FINANCIAL_COLUMNS = {
    "financial_snapshot_key": f"'FIN-' || {cnpj('s_suppkey')} || '-' || {text('y')}",
    **_keys("s_suppkey"),
    "financial_period_calendar_key": big("y * 10000 + 1231"),
    "financial_year": big("y"),
    # One supplier in thirty has no revenue, so ratios meet a zero denominator.
    **{
        m: f"CASE WHEN s_suppkey % 30 = 29 THEN CAST(0 AS DOUBLE) ELSE CAST({cents(f'{cents(_base)} * {_factor_of_year} * {s}')} AS DOUBLE) END"
        for m, s in FINANCIAL_SHARES.items()
    },
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shifted(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """A whole table in which every ninth key is changed, so that lookups have misses."""
    other = F.when(F.col(key) % 9 == 4, -1 - F.col(key)).otherwise(F.col(key))
    return table(spark, sf_dir, name).withColumn(key, other)


def _project(df: DataFrame, spec: dict, *extra) -> DataFrame:
    """The columns of a spec. What they use many times (`shared`) is worked out once a row, in a projection of its own."""
    if "where" in spec:
        df = df.where(spec["where"])
    names = {e: f"__shared{i}" for i, e in enumerate(spec.get("shared", ()))}
    if names:
        df = df.withColumns({n: F.expr(e) for e, n in names.items()})

    def short(expression: str) -> str:
        for e, n in names.items():
            expression = expression.replace(e, n)
        return expression

    return df.select(*[F.expr(short(e)).alias(c) for c, e in spec["columns"].items()], *extra)


def raw_rows(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """A RAW source with lineage; Parquet knows the row number inside its file."""
    spec = RAW[source]
    lineage = [
        F.col("_metadata.file_name").alias("source_file"),
        (F.col("_metadata.row_index") + 2).alias("source_row_number"),
        F.lit(LOAD_DATE).cast("date").alias("load_date"),
        F.lit(BATCH_ID).alias("batch_id"),
    ]
    return _project(table(spark, sf_dir, spec["table"]), spec, *lineage)


def raw(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """The RAW source. Its readers take the columns they use from the table; a copy of all of them would be written and read back."""
    return raw_rows(spark, sf_dir, source)


# Every date that some table has a calendar key for.
KEYED_DATES = {
    "orders": (_start, _end),
    "lineitem": (_ship, days_after(_ship, _span)),
    "events": (_assessed, _expires),
    "supplier": tuple(f"DATE '{y}-12-31'" for y in FISCAL_YEARS),
}


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days from the first to the last date in the tables."""

    def days() -> DataFrame:
        bounds = None
        for name, dates in KEYED_DATES.items():
            each = [F.expr(d) for d in dates]
            one = table(spark, sf_dir, name).agg(F.min(F.least(*each)).alias("a"), F.max(F.greatest(*each)).alias("b"))
            bounds = one if bounds is None else bounds.unionByName(one)
        whole = bounds.agg(F.min("a").alias("a"), F.max("b").alias("b"))
        spine = whole.select(F.explode(F.sequence("a", "b")).alias("calendar_date"))
        return spine.select(calendar_attributes("calendar_date")["calendar_key"].alias("calendar_key"), "calendar_date")

    return stored(spark, sf_dir, "keyed_calendar", days)


class Curated(dict):
    """Curated tables of a data folder, built when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.spark, self.sf_dir = spark, sf_dir

    def __missing__(self, name: str) -> DataFrame:
        self[name] = frame = self._build(name)
        return frame

    def _build(self, name: str) -> DataFrame:
        from ledgerspan.plans.curated.categories import classify

        if name == "dim_calendar":
            return calendar(self.spark, self.sf_dir)
        if name == "dim_category":
            # stored, as a run publishes it: its file size tells the planner that it is small
            orders = table(self.spark, self.sf_dir, "orders")
            codes = orders.select(F.expr(choose("o_orderkey", CODES)).alias("category_code")).distinct()
            return stored(self.spark, self.sf_dir, "keyed_category", lambda: classify(codes))
        if name == "fact_supplier_financial":
            years = F.explode(F.array(*[F.lit(y) for y in FISCAL_YEARS])).alias("y")
            rows = table(self.spark, self.sf_dir, "supplier").select("*", years)
            return rows.select(*[F.expr(e).alias(c) for c, e in FINANCIAL_COLUMNS.items()])
        return _project(table(self.spark, self.sf_dir, CURATED[name]["table"]), CURATED[name])


def context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run context; its reference date is the fixed AS_OF."""
    return spark.range(1).select(F.lit(AS_OF).cast("date").alias("as_of_date"))
