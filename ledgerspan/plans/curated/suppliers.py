"""`dim_supplier` (legal entity) and `dim_economic_group` (CNPJ root)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerspan.functions.text import CNPJ_FORMAT, CNPJ_ROOT_FORMAT, group_root, matches, prefixed_key, strip
from ledgerspan.operators.lookup import flag_member
from ledgerspan.operators.rules import Rule, annotate, formatted, one_of
from ledgerspan.operators.skew import join_unique
from ledgerspan.operators.uniqueness import flag_repeated
from ledgerspan.plans.curated.resolution import ERRORS
from ledgerspan.plans.staging.companies import BRANCH, HEAD_OFFICE
from ledgerspan.sources.raw import LINEAGE, SourceContractError

TEXTS = (
    "cnpj", "cnpj8", "cnpj_matriz", "razao_social", "hierarquia", "porte_empresa",
    "atividade_economica", "estagio_empresa", "cenario_financeiro",
)
# Staging name -> published name.
PUBLISHED_NAMES = {
    "cnpj": "supplier_cnpj",
    "cnpj8": "supplier_cnpj8",
    "cnpj_matriz": "parent_supplier_cnpj",
    "razao_social": "supplier_legal_name",
    "hierarquia": "supplier_hierarchy",
    "porte_empresa": "company_size",
    "atividade_economica": "economic_activity",
    "ano_fundacao": "foundation_year",
    "idade_empresa": "company_age_years",
    "estagio_empresa": "company_stage",
    "cenario_financeiro": "financial_scenario",
}
SUPPLIER_COLUMNS = (
    "supplier_key", "supplier_cnpj", "supplier_cnpj8", "economic_group_key", "parent_supplier_key",
    "parent_supplier_cnpj", "supplier_legal_name", "supplier_hierarchy", "company_size",
    "economic_activity", "foundation_year", "company_age_years", "company_stage", "financial_scenario",
    *LINEAGE,
)


def with_head_office_count(df: DataFrame) -> DataFrame:
    """Number of head offices in the row's group (0 when it has none), by aggregate and join."""
    counts = (
        df.where(F.col("hierarquia") == HEAD_OFFICE)
        .groupBy(F.col("cnpj8").alias("__root"))
        .agg(F.count("*").alias("__offices"))
    )
    return join_unique(df, counts, ["cnpj8"], ["__root"]).withColumn("__offices", F.coalesce("__offices", F.lit(0)))


def resolve_suppliers(companies: DataFrame) -> DataFrame:
    """Staged companies with keys and `curated_validation_errors`."""
    missing = sorted({*PUBLISHED_NAMES, *LINEAGE}.difference(companies.columns))
    if missing:
        raise SourceContractError(
            f"stg_empresas sem colunas obrigatórias para publicação curated: {', '.join(missing)}."
        )
    rows = companies.withColumns({c: strip(c) for c in TEXTS})
    rows = flag_repeated(rows, ["cnpj"], "__repeated")
    heads = rows.where(F.col("hierarquia") == HEAD_OFFICE)
    rows = flag_member(rows, "cnpj_matriz", heads, "cnpj", "__has_head")
    rows = with_head_office_count(rows)
    head, branch = F.col("hierarquia") == HEAD_OFFICE, F.col("hierarquia") == BRANCH
    rules = [
        formatted("cnpj", CNPJ_FORMAT, "cnpj inválido"),
        formatted("cnpj8", CNPJ_ROOT_FORMAT, "cnpj8 inválido"),
        Rule(F.col("cnpj8") != group_root("cnpj"), "cnpj8 divergente do cnpj"),
        Rule(F.col("__repeated"), "cnpj duplicado na fonte curated"),
        Rule(F.col("razao_social") == "", "razao_social ausente"),
        one_of("hierarquia", (HEAD_OFFICE, BRANCH), "inválida"),
        Rule(head & (F.col("cnpj_matriz") != F.col("cnpj")), "matriz deve referenciar o próprio cnpj"),
        Rule(branch & ~F.col("__has_head"), "cnpj_matriz não encontrado como matriz"),
        Rule(
            matches("cnpj8", CNPJ_ROOT_FORMAT) & (F.col("__offices") != 1),
            "grupo econômico sem matriz única",
        ),
    ]
    keyed = annotate(rows, rules, ERRORS).drop("__repeated", "__has_head", "__offices")
    return keyed.withColumns(
        {
            "supplier_key": prefixed_key("SUP-", "cnpj"),
            "economic_group_key": prefixed_key("GRP-", "cnpj8"),
            "parent_supplier_key": F.when(branch, prefixed_key("SUP-", "cnpj_matriz")),
        }
    )


def publish_names(resolved: DataFrame) -> DataFrame:
    return resolved.withColumnsRenamed(PUBLISHED_NAMES)


def economic_groups(suppliers: DataFrame) -> DataFrame:
    """One row per group: its head office, renamed. A filter of `dim_supplier`, no shuffle."""
    return suppliers.where(F.col("supplier_hierarchy") == HEAD_OFFICE).select(
        "economic_group_key",
        F.col("supplier_cnpj8").alias("economic_group_cnpj8"),
        F.col("supplier_key").alias("matrix_supplier_key"),
        F.col("supplier_legal_name").alias("economic_group_legal_name"),
        *LINEAGE,
    )
