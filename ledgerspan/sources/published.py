"""Parquet tables: projected scans, schema-checked sinks, valid/invalid split and stage metrics."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager, suppress
from datetime import date
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from ledgerspan.operators.rules import SEPARATOR, rule_counts
from ledgerspan.operators.storage import shuffles_freed

CONTRACT_VERSION = "1.0"
# Rows per file cap: keeps part files in the hundreds of MB whatever the size of a partition.
MAX_RECORDS_PER_FILE = 5_000_000

_LINEAGE_SCHEMA = (
    ("source_file", "string", False), ("source_row_number", "bigint", False), ("load_date", "date", False),
    ("batch_id", "string", False),
)
# Staging contracts as (name, type, nullable).
STAGING_SCHEMAS: dict[str, tuple[tuple[str, str, bool], ...]] = {
    "stg_contratos": (
        ("contract_id", "string", False), ("contract_name", "string", False), ("supplier_cnpj", "string", False),
        ("supplier_name", "string", False), ("contract_category", "string", False),
        ("validity_start_date", "date", False), ("validity_end_date", "date", False),
        ("original_value", "decimal(18,2)", False), ("total_value", "decimal(18,2)", False),
        ("balance_value", "decimal(18,2)", False), ("contract_type", "string", False),
        ("contract_status", "string", False), ("risk_evaluation_date", "date", True),
        ("final_risk", "string", False), ("closure_reason", "string", True), *_LINEAGE_SCHEMA,
    ),
    "stg_aditamentos": (
        ("amendment_id", "string", False), ("contract_id", "string", False), ("amendment_type", "string", False),
        ("validity_start_date", "date", False), ("validity_end_date", "date", False),
        ("amendment_value", "decimal(18,2)", False), ("amendment_sequence", "bigint", False), *_LINEAGE_SCHEMA,
    ),
    "stg_pagamentos": (
        ("payment_id", "string", False), ("contract_id", "string", False), ("supplier_cnpj", "string", False),
        ("supplier_cnpj8", "string", False), ("supplier_name", "string", False), ("payment_date", "date", False),
        ("payment_value", "decimal(18,2)", False), ("cost_center", "string", False),
        ("payment_category", "string", False), *_LINEAGE_SCHEMA,
    ),
    "stg_homologacoes_risco": (
        ("risk_assessment_id", "string", False), ("supplier_cnpj", "string", False),
        ("supplier_cnpj8", "string", False), ("assessment_date", "date", False),
        ("last_approval_date", "date", True), ("expiration_date", "date", True),
        ("homologation_result", "string", False), ("homologation_status", "string", False),
        ("financial_risk", "string", False), ("labor_risk", "string", False), ("credit_rating", "string", False),
        ("final_risk", "string", False), ("interest_to_revenue_ratio", "double", False),
        ("revenue_trend", "double", False), ("net_margin", "double", False),
        ("labor_cases_index", "double", False), *_LINEAGE_SCHEMA,
    ),
}


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet scan; only `columns` are read when given."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def guarded(df: DataFrame, table: str, when: Column) -> DataFrame:
    """A NULL in a required column of a row for which `when` holds fails the write."""
    def checked(name: str) -> Column:
        message = F.lit(f"{table}.{name} não pode ser nulo")
        return F.when(when & F.col(name).isNull(), F.raise_error(message).cast(df.schema[name].dataType)).otherwise(F.col(name))

    return df.withColumns({name: checked(name) for name, _, nullable in STAGING_SCHEMAS[table] if not nullable})


def typed(df: DataFrame, table: str) -> DataFrame:
    """The columns of the staging contract in its types."""
    return df.select(*[F.col(name).cast(kind).alias(name) for name, kind, _ in STAGING_SCHEMAS[table]])


def conform_to_schema(df: DataFrame, table: str) -> DataFrame:
    """Project and cast to the staging contract. A NULL in a required column fails the write, also one that the cast makes."""
    return guarded(typed(df, table), table, F.lit(True))


def physical_schema(schema: T.StructType) -> list[dict[str, object]]:
    return [{"name": f.name, "type": f.dataType.simpleString(), "nullable": f.nullable} for f in schema.fields]


def write_table(
    df: DataFrame, path: str, *, mode: str = "errorifexists", partition_by: Sequence[str] = ()
) -> list[dict[str, object]]:
    """Write Parquet and return its schema. The default refuses to touch an existing table."""
    writer = df.write.mode(mode).option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
    with shuffles_freed(df.sparkSession):
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return physical_schema(df.schema)


def stage_counts(annotated: DataFrame, column: str = "validation_errors") -> DataFrame:
    """Source, valid and invalid rows: one aggregate, one row."""
    return annotated.agg(
        F.count("*").alias("source"),
        F.count_if(F.col(column) == "").alias("valid"),
        F.count_if(F.col(column) != "").alias("invalid"),
    )


VALID = "is_valid"


def write_split(df: DataFrame, path: str, valid: Column, metrics: dict[str, Column] | None = None) -> dict[str, object]:
    """Write rows once, parted by `valid`, and return what `metrics` count on the way, with the rows of both sides.

    Readers of one side read its folder alone (`read_split`).
    """
    observation = Observation()
    split = df.withColumn(VALID, valid)
    counted = {"valid": F.count_if(F.col(VALID)), "invalid": F.count_if(~F.col(VALID))} | (metrics or {})
    observed = split.observe(observation, *[c.alias(f"m{i}") for i, c in enumerate(counted.values())])
    write_table(observed, path, partition_by=[VALID])
    return dict(zip(counted, (observation.get[f"m{i}"] for i in range(len(counted)))))


def read_split(spark: SparkSession, path: str, schema: T.StructType, valid: bool | None = None) -> DataFrame:
    """One side of a table that `write_split` wrote from rows of `schema`, or both with the column `is_valid`."""
    whole = T.StructType([f for f in schema.fields if f.name != VALID]).add(VALID, "boolean")
    rows = spark.read.schema(whole).parquet(path)
    return rows if valid is None else rows.where(F.col(VALID) == F.lit(valid)).drop(VALID)


def rule_metrics(annotated: DataFrame, column: str = "validation_errors") -> dict[str, Column] | None:
    """A count per rule that `annotate` evaluated, or None for rows that were annotated elsewhere."""
    messages = (annotated.schema[column].metadata or {}).get("rules")
    if messages is None:
        return None
    listed = F.concat(F.lit(SEPARATOR), F.col(column), F.lit(SEPARATOR))
    return {m: F.count_if((F.col(column) != "") & F.contains(listed, F.lit(f"{SEPARATOR}{m}{SEPARATOR}"))) for m in messages}


def publish_stage(
    annotated: DataFrame, table: str, path: str, *, source_file: str, batch_id: str, totals: dict[str, Column] | None = None
) -> dict[str, object]:
    """Write the rows of one staged source, valid and rejected ones parted; return its manifest.

    The rules are evaluated once, in the one write there is; rows, violations per rule and `totals` of the
    valid rows are observed on the way.
    """
    valid = F.col("validation_errors") == ""
    rows = guarded(annotated, table, valid) if table in STAGING_SCHEMAS else annotated
    per_rule, totals = rule_metrics(annotated), totals or {}
    seen = write_split(rows, path, valid, (per_rule or {}) | {f"total {k}": v for k, v in totals.items()})
    side = annotated.drop("validation_errors")
    if per_rule is None:
        rejected = read_split(annotated.sparkSession, path, rows.schema, False)
        violations = {r["message"]: r["violations"] for r in rule_counts(rejected).collect()}
    else:
        violations = {m: seen[m] for m in sorted(per_rule) if seen[m]}
    return {
        "table": table,
        "contract_version": CONTRACT_VERSION,
        "source_file": source_file,
        "batch_id": batch_id,
        "row_counts": {"source": seen["valid"] + seen["invalid"], "valid": seen["valid"], "invalid": seen["invalid"]},
        "totals": {k: str(seen[f"total {k}"]) for k in totals},
        "schema": physical_schema((typed(side, table) if table in STAGING_SCHEMAS else side).schema),
        "stored_schema": json.loads(rows.schema.json()),
        "validation_error_counts": violations,
    }


def write_batches(df: DataFrame, path: str, batch: str = "batch_id", *, mode: str = "append") -> None:
    """A table laid out by batch: a batch is a folder, and a later one is added without touching the others."""
    write_table(df, path, mode=mode, partition_by=[batch])


def read_latest_batch(spark: SparkSession, path: str, batch: str = "batch_id") -> DataFrame:
    """Rows of the highest batch id of such a table, found in the list of its folders; no other batch is listed or read."""
    system, at = _located(spark, path)
    prefix = f"{batch}="
    names = [f.getPath().getName() for f in system.listStatus(at) if f.isDirectory()]
    known = [unquote(n[len(prefix) :]) for n in names if n.startswith(prefix) and n != f"{prefix}__HIVE_DEFAULT_PARTITION__"]
    if not known:
        raise FileNotFoundError(f"Nenhum lote em {path}.")
    latest = max(known)
    folder = next(n for n in names if unquote(n) == f"{prefix}{latest}")
    schema = spark.read.parquet(f"{path}/{folder}").schema.add(batch, "string")
    rows = spark.read.schema(schema).option("basePath", path).parquet(f"{path}/{folder}")
    return rows.where(F.col(batch) == latest)


class AlreadyPublishedError(ValueError):
    """What is published stays as it is."""


def _located(spark: SparkSession, path: str):
    """Hadoop's file system and path."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    system, at = _located(spark, path)
    return system.exists(at)


def publish_json(spark: SparkSession, content: dict[str, object], path: str) -> None:
    """Write one small JSON file that appears whole or not at all: written beside its place, then renamed."""
    system, at = _located(spark, path)
    draft = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    out = system.create(draft, False)
    try:
        out.write(bytearray(json.dumps(content, ensure_ascii=False, default=str).encode("utf-8")))
    finally:
        out.close()
    if system.exists(at) or not system.rename(draft, at):
        system.delete(draft, False)
        raise AlreadyPublishedError(f"Publicação já existe (exists): {path}.")


@contextmanager
def attempt(spark: SparkSession, base: str, pointer: str) -> Iterator[str]:
    """A folder of its own below `base` for one try at a publication, visible to readers only by what `pointer` names.

    The last thing a try does is to publish `base`/`pointer`; where that exists, nothing is begun. A try that fails
    takes its folder along, and one that is killed leaves a folder that nothing points to.
    """
    if exists(spark, f"{base}/{pointer}"):
        raise AlreadyPublishedError(f"Publicação já existe (exists): {base}/{pointer}.")
    folder = f"{base}/attempt-{uuid.uuid4().hex}"
    try:
        yield folder
    except BaseException:
        with suppress(Exception):
            system, at = _located(spark, folder)
            system.delete(at, True)
        raise


def write_json(spark: SparkSession, content: dict[str, object], path: str) -> None:
    """Write one small JSON document through Spark, so any file system Spark knows will do."""
    text = json.dumps(content, ensure_ascii=False, default=str)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("errorifexists").text(path)


def read_json(spark: SparkSession, path: str) -> dict[str, object]:
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def run_context(
    spark: SparkSession,
    *,
    pipeline_run_id: str,
    source_snapshot_id: str,
    scenario_id: str,
    as_of_date: date,
    etl_manifest_path: str = "",
    curated_dir: str = "",
) -> DataFrame:
    """One-row context of an analytic run; queries take its reference date as a scalar subquery."""
    schema = (
        "pipeline_run_id string, source_snapshot_id string, scenario_id string, as_of_date date, "
        "etl_manifest_path string, curated_dir string"
    )
    row = (pipeline_run_id, source_snapshot_id, scenario_id, as_of_date, etl_manifest_path, curated_dir)
    return spark.createDataFrame([row], schema)
