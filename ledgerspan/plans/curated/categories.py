"""`dim_category`: one row per category code seen in contracts or payments, with its taxonomy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerspan.functions.text import category_label, prefixed_key, strip

UNMAPPED = "nao_classificada"
# Category code -> (name, macro group, group, family).
TAXONOMY = {
    "aquisicao_de_equipamentos": (
        "Aquisição de equipamentos", "capex_focused", "operacoes_e_suprimentos", "equipamentos",
    ),
    "consultoria": ("Consultoria", "opex_focused", "servicos_profissionais", "consultoria"),
    "licenca_de_software": ("Licença de software", "opex_focused", "tecnologia", "software_e_licencas"),
    "manutencao_e_suporte": ("Manutenção e suporte", "opex_focused", "tecnologia", "suporte_tecnologico"),
    "outsourcing_de_ti": ("Outsourcing de TI", "opex_focused", "tecnologia", "servicos_de_ti"),
    "servicos_de_infraestrutura": (
        "Serviços de infraestrutura", "opex_focused", "tecnologia", "infraestrutura_tecnologica",
    ),
    "servicos_de_logistica": ("Serviços de logística", "opex_focused", "operacoes_e_suprimentos", "logistica"),
    "treinamento_e_capacitacao": (
        "Treinamento e capacitação", "opex_focused", "servicos_profissionais", "treinamento_e_capacitacao",
    ),
}
TAXONOMY_FIELDS = ("category_name", "category_macro_group", "category_group", "category_family")
# Cost centre of each category label.
COST_CENTERS = {
    "Aquisição de Equipamentos": "CC-100",
    "Consultoria": "CC-200",
    "Licença de Software": "CC-300",
    "Manutenção e Suporte": "CC-400",
    "Outsourcing de TI": "CC-500",
    "Serviços de Logística": "CC-600",
    "Treinamento e Capacitação": "CC-700",
    "Serviços de Infraestrutura": "CC-800",
}


def constant_map(values: dict[str, Column]) -> Column:
    return F.create_map(*[x for key, value in values.items() for x in (F.lit(key), value)])


def taxonomy_of(code: Column) -> Column:
    """Struct of the four levels, NULL for a code outside the taxonomy.

    The taxonomy is a constant of eight entries, so it is a map literal in the projection: no join.
    """
    entries = {
        key: F.struct(*[F.lit(v).alias(f) for f, v in zip(TAXONOMY_FIELDS, levels)])
        for key, levels in TAXONOMY.items()
    }
    return F.try_element_at(constant_map(entries), code)


def cost_center_of(label: Column) -> Column:
    return F.try_element_at(constant_map({k: F.lit(v) for k, v in COST_CENTERS.items()}), label)


def category_codes(contracts: DataFrame, payments: DataFrame) -> DataFrame:
    """Distinct codes. Each side is made distinct before the union, so few rows are shuffled."""
    sides = [
        df.select(strip(column).alias("category_code")).distinct()
        for df, column in ((contracts, "contract_category"), (payments, "payment_category"))
    ]
    codes = sides[0].unionByName(sides[1]).distinct()
    return codes.where(F.col("category_code").isNotNull() & (F.col("category_code") != ""))


def classify(codes: DataFrame) -> DataFrame:
    known = codes.withColumn("__t", taxonomy_of(F.col("category_code")))
    mapped = F.col("__t").isNotNull()
    levels = [F.coalesce(F.col(f"__t.{f}"), F.lit(UNMAPPED)).alias(f) for f in TAXONOMY_FIELDS[1:]]
    return known.select(
        prefixed_key("CAT-", "category_code").alias("category_key"),
        "category_code",
        F.coalesce(F.col("__t.category_name"), category_label("category_code")).alias("category_name"),
        *levels,
        mapped.alias("is_taxonomy_mapped"),
    )


def build_categories(contracts: DataFrame, payments: DataFrame) -> DataFrame:
    return classify(category_codes(contracts, payments)).orderBy("category_code")
