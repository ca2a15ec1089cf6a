"""RAW contracts of the five sources: column names, required columns, scan and lineage."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

LINEAGE = ("source_file", "source_row_number", "load_date", "batch_id")
BATCH_PATTERN = r"_(\d{8}_\d{6})\.(csv|parquet)$"

# RAW column name -> technical name.
SOURCE_COLUMNS: dict[str, dict[str, str]] = {
    "companies": {
        "CNPJ": "cnpj",
        "CNPJ8": "cnpj8",
        "CNPJ_Matriz": "cnpj_matriz",
        "Razao_Social": "razao_social",
        "Hierarquia": "hierarquia",
        "Capital_Social": "capital_social",
        "Porte_Empresa": "porte_empresa",
        "Num_Func_CLT": "num_func_clt",
        "Num_Func_PJ": "num_func_pj",
        "Num_Total_Func": "num_total_func",
        "Processos_Trabalhistas": "processos_trabalhistas",
    },
    "contracts": {
        "Cód_Contrato": "contract_id",
        "Nome_Contrato": "contract_name",
        "CNPJ": "supplier_cnpj",
        "Fornecedor": "supplier_name",
        "Escopo": "contract_category",
        "Vigência Inicio": "validity_start_date",
        "Vigência Fim": "validity_end_date",
        "Valor_Original": "original_value",
        "Valor_Total": "total_value",
        "Saldo": "balance_value",
        "Tipo_Contrato": "contract_type",
        "Status": "contract_status",
        "Data_Avaliacao_Risco": "risk_evaluation_date",
        "Risco_Final": "final_risk",
        "Motivo_Encerramento": "closure_reason",
    },
    "amendments": {
        "Cód_Contrato": "contract_id",
        "Tipo_Aditamento": "amendment_type",
        "Vigência_Inicio": "validity_start_date",
        "Vigência_Fim": "validity_end_date",
        "Valor": "amendment_value",
        "Sequencia_Aditamento": "amendment_sequence",
    },
    "payments": {
        "Cód_Pagamento": "payment_id",
        "Cód_Contrato": "contract_id",
        "CNPJ": "supplier_cnpj",
        "Fornecedor": "supplier_name",
        "Data_Pagamento": "payment_date",
        "Valor_Pago": "payment_value",
        "Centro_Custo": "cost_center",
        "Categoria": "payment_category",
    },
    "risk": {
        "Id_Avaliacao_Risco": "risk_assessment_id",
        "CNPJ": "supplier_cnpj",
        "Data_Avaliacao": "assessment_date",
        "Data_Ultima_Homologacao": "last_approval_date",
        "Data_Expiracao": "expiration_date",
        "Resultado_Homologacao": "homologation_result",
        "Status_Homologacao": "homologation_status",
        "Risco_Financeiro": "financial_risk",
        "Risco_Trabalhista": "labor_risk",
        "Rating_Credito": "credit_rating",
        "Risco_Final": "final_risk",
        "Indice_Juros_Sobre_Receita": "interest_to_revenue_ratio",
        "Tendencia_Faturamento": "revenue_trend",
        "Margem_Liquida": "net_margin",
        "Indice_Processos_Trabalhistas": "labor_cases_index",
    },
}
# How each source is called in messages and in RAW file names.
SOURCE_LABELS = {
    "companies": "empresas",
    "contracts": "contratos",
    "amendments": "aditamentos",
    "payments": "pagamentos",
    "risk": "homologações e risco",
}
FILE_STEMS = {
    "companies": "empresas",
    "risk": "homologacoes_risco",
    "contracts": "contratos_ficticios",
    "amendments": "aditamentos",
    "payments": "spending_ficticio",
}


class SourceContractError(ValueError):
    """A source does not meet its minimum structural contract."""


def require_columns(df: DataFrame, source: str) -> None:
    missing = sorted(set(SOURCE_COLUMNS[source]).difference(df.columns))
    if missing:
        raise SourceContractError(
            f"Fonte {SOURCE_LABELS[source]} sem colunas obrigatórias: {', '.join(missing)}."
        )


def conform(df: DataFrame, source: str) -> DataFrame:
    """Check the required columns and give them technical names; other names are lower-cased.

    Amendments keep only their declared columns and the lineage.
    """
    require_columns(df, source)
    names = SOURCE_COLUMNS[source]
    renamed = df.withColumnsRenamed(names)
    if source == "companies":
        return renamed.toDF(*[c.lower() for c in renamed.columns])
    if source == "amendments":
        return renamed.select(*names.values(), *[c for c in LINEAGE if c in df.columns])
    return renamed


# RFC 4180: fields may be quoted, a quote inside them is doubled, blanks belong to the value.
CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def scan_csv(spark: SparkSession, path: str | list[str], *, multi_line: bool = False) -> DataFrame:
    """CSV with a header, every column as text: leading zeros survive and nothing is inferred.

    Only the header of one file is read to learn the column names. This is for files whose values hold no line
    breaks; `records.read_source` reads any file in parallel. With `multi_line` such a file is read by one task.
    """
    return spark.read.options(**CSV_OPTIONS).option("inferSchema", False).option("multiLine", multi_line).csv(path)


def batch_of(file_name: Column | str) -> Column:
    """Batch id in a file name, NULL when it has none."""
    name = F.col(file_name) if isinstance(file_name, str) else file_name
    found = F.regexp_extract(name, BATCH_PATTERN, 1)
    return F.nullif(found, F.lit(""))


def require_batch(df: DataFrame) -> DataFrame:
    """Fail at run time on the first row that comes from a file without a batch id."""
    message = F.concat(F.lit("Não foi possível extrair o identificador de lote de "), F.col("source_file"), F.lit("."))
    return df.withColumn("batch_id", F.coalesce("batch_id", F.raise_error(message).cast("string")))


def loaded_on(day: date | None) -> Column:
    """The given load date, or today where the sources are loaded."""
    return F.lit(day) if day else F.to_date(F.from_utc_timestamp(F.current_timestamp(), "America/Sao_Paulo"))


def add_lineage(
    df: DataFrame, *, load_date: date | None = None, batch_id: str | None = None
) -> DataFrame:
    """Lineage of a CSV scan: file, row number (the header is row 1), load date, batch.

    `df` must be the scan itself (`scan_csv`). A row number needs the row's position in its file,
    and the file is read in blocks by different tasks. Within a block positions are consecutive, so
    two narrow passes suffice: count the rows of each (file, block), sum the blocks before it, add
    the position inside the block. No sort and no shuffle of the data; the table of blocks is small
    (one row per block) and is broadcast, so the data stays where it is.
    """
    placed = df.select(
        "*",
        F.col("_metadata.file_path").alias("__path"),
        F.col("_metadata.file_name").alias("source_file"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__id"),
    )
    blocks = placed.groupBy("__path", "__block").agg(F.count("*").alias("__n"), F.min("__id").alias("__first"))
    earlier = Window.partitionBy("__path").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(
        F.col("__path").alias("__opath"),
        F.col("__block").alias("__oblock"),
        (F.coalesce(F.sum("__n").over(earlier), F.lit(0)) - F.col("__first") + 2).alias("__shift"),
    )
    joined = placed.join(
        F.broadcast(offsets), (F.col("__path") == F.col("__opath")) & (F.col("__block") == F.col("__oblock"))
    )
    batch = F.lit(batch_id) if batch_id else batch_of("source_file")
    result = joined.withColumns(
        {"source_row_number": F.col("__id") + F.col("__shift"), "load_date": loaded_on(load_date), "batch_id": batch}
    ).drop("__path", "__block", "__id", "__opath", "__oblock", "__shift")
    result = result if batch_id else require_batch(result)
    return result.select(*df.columns, *LINEAGE)


def latest_batch(df: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Rows of the highest batch id: a one-value scalar subquery and a filter, no join."""
    return df.where(F.col(batch) == df.agg(F.max(batch)).scalar())
