"""Companies: legal entities, their head office and yearly figures (grain: cnpj)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerspan.functions.numbers import lenient_bigint, lenient_double
from ledgerspan.functions.text import CNPJ_FORMAT, CNPJ_ROOT_FORMAT, digits_only, group_root, strip
from ledgerspan.operators.rules import Rule, annotate, formatted, not_negative, one_of, parsed, required
from ledgerspan.operators.skew import join_unique
from ledgerspan.operators.uniqueness import drop_ambiguous, flag_repeated
from ledgerspan.sources.raw import conform

YEARS = range(2022, 2027)
# Hierarchy, size bands and validated yearly measures.
HEAD_OFFICE, BRANCH = "Matriz", "Filial"
SIZES = ("Microempresa", "Pequeno", "Médio", "Grande")
VALIDATED_MEASURES = ("faturamento", "custo", "lucro_bruto", "juros_divida", "lucro_liquido")
FINANCIAL_COLUMNS = ("capital_social", *[f"{m}_{y}" for m in VALIDATED_MEASURES for y in YEARS])
COUNT_COLUMNS = ("num_func_clt", "num_func_pj", "num_total_func", "processos_trabalhistas")
COMPARED_WITH_HEAD = (*FINANCIAL_COLUMNS, "num_total_func")
PAYROLL_COLUMNS = tuple(f"custo_folha_{y}" for y in YEARS)
AGE_COLUMNS = ("ano_fundacao", "idade_empresa")


def normalize_companies(raw: DataFrame) -> DataFrame:
    rows = conform(raw, "companies")
    present = set(rows.columns)
    numbers = [*FINANCIAL_COLUMNS, *PAYROLL_COLUMNS, "receita_por_funcionario"]
    return rows.withColumns(
        {
            **{c: digits_only(c) for c in ("cnpj", "cnpj8", "cnpj_matriz")},
            **{c: strip(c) for c in ("razao_social", "hierarquia", "porte_empresa")},
            **{c: lenient_double(c) for c in numbers if c in present},
            **{c: lenient_bigint(c) for c in (*COUNT_COLUMNS, *AGE_COLUMNS) if c in present},
        }
    )


def identity_rules() -> list[Rule]:
    return [
        required("cnpj"),
        formatted("cnpj", CNPJ_FORMAT, "cnpj deve conter 14 dígitos"),
        Rule(F.col("__repeated"), "cnpj duplicado"),
        required("cnpj8"),
        formatted("cnpj8", CNPJ_ROOT_FORMAT, "cnpj8 deve conter 8 dígitos"),
        Rule(F.col("cnpj8") != group_root("cnpj"), "cnpj8 divergente do cnpj"),
        required("razao_social"),
        one_of("hierarquia", (HEAD_OFFICE, BRANCH), "inválida"),
        one_of("porte_empresa", SIZES),
    ]


def figure_rules() -> list[Rule]:
    rules = [r for c in (*FINANCIAL_COLUMNS, *COUNT_COLUMNS) for r in (parsed(c), not_negative(c))]
    headcount = F.col("num_func_clt") + F.col("num_func_pj")
    return [*rules, Rule(headcount != F.col("num_total_func"), "total de funcionários divergente de clt + pj")]


def hierarchy_rules() -> list[Rule]:
    head, branch = F.col("hierarquia") == HEAD_OFFICE, F.col("hierarquia") == BRANCH
    return [
        Rule(head & (F.col("cnpj_matriz") != F.col("cnpj")), "matriz deve referenciar o próprio cnpj"),
        Rule(branch & (F.col("cnpj_matriz") == ""), "filial sem cnpj_matriz"),
        Rule(branch & F.col("__head").isNull(), "cnpj_matriz não encontrado ou não é matriz"),
        *[
            Rule(branch & (F.col(c) > F.col(f"__head.{c}")), f"{c} maior que o valor da matriz")
            for c in COMPARED_WITH_HEAD
        ],
    ]


def with_head_office(rows: DataFrame) -> DataFrame:
    """Attach to each branch its head office (`__head`); head offices with a repeated CNPJ are left out."""
    heads = rows.where(F.col("hierarquia") == HEAD_OFFICE)
    heads = drop_ambiguous(heads, "cnpj", COMPARED_WITH_HEAD)
    side = heads.select(F.col("cnpj").alias("__head_cnpj"), F.struct(*COMPARED_WITH_HEAD).alias("__head"))
    parent = F.when(F.col("hierarquia") == BRANCH, F.col("cnpj_matriz"))
    return join_unique(rows, side, [parent], ["__head_cnpj"])


def stage_companies(raw: DataFrame) -> DataFrame:
    rows = flag_repeated(normalize_companies(raw), ["cnpj"], "__repeated", exempt=F.col("cnpj") == "")
    rows = with_head_office(rows)
    rules = [*identity_rules(), *figure_rules(), *hierarchy_rules()]
    return annotate(rows, rules).drop("__repeated", "__head")
