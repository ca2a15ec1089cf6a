"""Immutable RAW snapshots: publish five tables with counts and digests, and audit them later.

A snapshot source is a folder of CSV part files written by Spark. Counts come with the write
(`observe`), digests are hash trees over the lines, and the audit compares them as a join; neither the rows nor
the digests pass through the driver. All is written below a folder of its own first; the manifest, written last, is what
makes it a snapshot, so a failed try leaves nothing that a reader or a repeat would meet.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ledgerspan.operators.reshape import union_all
from ledgerspan.operators.storage import keep
from ledgerspan.plans.quality import snapshot_integrity
from ledgerspan.sources.digests import file_digests
from ledgerspan.sources.published import attempt, exists, publish_json, read_json, write_table
from ledgerspan.sources.raw import CSV_OPTIONS, FILE_STEMS

MANIFEST_VERSION = "2.0"
POINTER = "raw_manifest.json"
# Part files that many tasks can read and write.
ROWS_PER_PART = 500_000
# Foreign manifests hold hashes of whole files, which take a file as one value.
MOST_BYTES = 2_000_000_000
# Name of each source in a manifest.
MANIFEST_NAMES = {
    "companies": "empresas",
    "risk": "homologacoes_risco",
    "contracts": "contratos",
    "amendments": "aditamentos",
    "payments": "pagamentos",
}


class SnapshotError(ValueError):
    """A snapshot is incomplete, changed, or would be overwritten."""


def snapshot_path(raw_dir: str, scenario_id: str, snapshot_id: str) -> str:
    return f"{raw_dir.rstrip('/')}/{scenario_id}/{snapshot_id}"


def _relative(path: str, base: str):
    return F.substring_index(path, base.rstrip("/").rsplit("/", 1)[-1] + "/", -1)


def file_hashes(spark: SparkSession, paths: list[str], base: str) -> DataFrame:
    """(file, sha256, bytes, lines) of every data file below `paths`, named relative to `base`; `sha256` is the root of its hash tree."""
    return file_digests(spark, paths).select(_relative("path", base).alias("file"), "sha256", "bytes", "lines")


def kept_hashes(spark: SparkSession, paths: list[str], base: str) -> DataFrame:
    """`file_hashes`, source by source, so that the disk holds the line digests of one source at a time; a row per file is kept."""
    return union_all([keep(file_hashes(spark, [path], base), "file-hashes") for path in paths])


def byte_hashes(spark: SparkSession, paths: list[str], base: str, most_bytes: int = MOST_BYTES) -> DataFrame:
    """(file, sha256) of the bytes of whole files, as foreign manifests declare them. A file beyond `most_bytes` is refused."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").load(paths)
    large = files.where(F.col("length") > most_bytes).select("path", "length").take(1)
    if large:
        raise SnapshotError(f"Arquivo grande demais para um hash de bytes ({large[0]['length']} > {most_bytes}): {large[0]['path']}; republique o snapshot.")
    return files.select(_relative("path", base).alias("file"), F.sha2("content", 256).alias("sha256"))


def require_integrity(sources: dict[str, DataFrame]) -> None:
    """Raise when a check on the whole snapshot fails; six rows reach the driver."""
    report = snapshot_integrity(*(sources[s] for s in ("companies", "contracts", "amendments", "payments")))
    failed = [f"{r['check_name']}: {r['violations']}" for r in report.where("NOT passed").collect()]
    if failed:
        raise SnapshotError(f"Snapshot sem integridade: {'; '.join(failed)}.")


def write_snapshot(
    sources: dict[str, DataFrame],
    *,
    raw_dir: str,
    scenario_id: str,
    snapshot_id: str,
    as_of_date: date,
    parent_snapshot_id: str | None = None,
    parameters: dict[str, object] | None = None,
    kind: str = "initial",
    check: bool = True,
) -> str:
    """Write the five sources and the manifest of a new snapshot; never over an existing one.

    Values are stored as they are, blanks and line breaks included; CSV tells an empty text from NULL no more than the
    readers of such files do. `check` refuses sources with broken references or repeated ids before
    anything is written.
    """
    missing = [name for name in FILE_STEMS if name not in sources]
    if missing:
        raise SnapshotError(f"Fonte obrigatória ausente no snapshot: {', '.join(missing)}.")
    if check:
        require_integrity(sources)
    spark = next(iter(sources.values())).sparkSession
    snapshot = snapshot_path(raw_dir, scenario_id, snapshot_id)
    with attempt(spark, snapshot, POINTER) as folder:
        counts, paths = {}, {n: f"{folder}/{stem}_{snapshot_id}.csv" for n, stem in FILE_STEMS.items()}
        for name, path in paths.items():
            observation = Observation()
            observed = sources[name].observe(observation, F.count(F.lit(1)).alias("rows"))
            writer = observed.write.mode("errorifexists").options(**CSV_OPTIONS)
            writer.option("maxRecordsPerFile", ROWS_PER_PART).csv(path)
            counts[name] = observation.get["rows"]
        write_table(kept_hashes(spark, list(paths.values()), snapshot), f"{folder}/hashes")
        inside = lambda path: path[len(snapshot) + 1 :]
        manifest = {
            "manifest_version": MANIFEST_VERSION,
            "scenario_id": scenario_id,
            "snapshot_id": snapshot_id,
            "parent_snapshot_id": parent_snapshot_id,
            "snapshot_type": kind,
            "as_of_date": as_of_date.isoformat(),
            "created_at": datetime.now().astimezone().isoformat(),
            "parameters": parameters or {},
            "hashes": inside(f"{folder}/hashes"),
            "sources": {MANIFEST_NAMES[n]: {"path": inside(p), "row_count": counts[n]} for n, p in paths.items()},
        }
        publish_json(spark, manifest, f"{snapshot}/{POINTER}")
    return snapshot


def compare_hashes(declared: DataFrame, actual: DataFrame) -> DataFrame:
    """Files that are missing, changed or undeclared; empty when the snapshot is intact."""
    old = declared.select("file", F.col("sha256").alias("declared"))
    new = actual.select("file", F.col("sha256").alias("found"))
    status = (
        F.when(F.col("found").isNull(), "missing")
        .when(F.col("declared").isNull(), "undeclared")
        .when(F.col("found") != F.col("declared"), "changed")
    )
    return old.join(new, "file", "full_outer").select("file", status.alias("problem")).where("problem IS NOT NULL")


def declared_hashes(spark: SparkSession, snapshot: str, manifest: dict) -> DataFrame:
    """Digests stored with a snapshot of this library."""
    return spark.read.parquet(f"{snapshot}/{manifest['hashes']}")


def audit_snapshot(spark: SparkSession, snapshot: str, found: DataFrame | None = None) -> DataFrame:
    """Problems of a stored snapshot against the digests written with it, or the hashes in a foreign manifest.

    `found` are the digests of its files (`kept_hashes`) where they have just been taken.
    """
    manifest = load_manifest(spark, snapshot)
    paths = list(source_paths(snapshot, manifest).values())
    if "hashes" in manifest:
        return compare_hashes(declared_hashes(spark, snapshot, manifest), kept_hashes(spark, paths, snapshot) if found is None else found)
    entries = [(e["path"], e.get("sha256")) for e in manifest["sources"].values()]
    if not all(digest for _, digest in entries):
        raise SnapshotError("Manifesto sem hashes das fontes.")
    declared = spark.createDataFrame(entries, "file string, sha256 string")
    return compare_hashes(declared, byte_hashes(spark, paths, snapshot))


def source_paths(snapshot: str, manifest: dict) -> dict[str, str]:
    return {n: f"{snapshot}/{manifest['sources'][k]['path']}" for n, k in MANIFEST_NAMES.items()}


def load_manifest(spark: SparkSession, snapshot: str) -> dict:
    if not exists(spark, f"{snapshot}/{POINTER}"):
        raise SnapshotError(f"Snapshot sem manifesto: {snapshot}.")
    manifest = read_json(spark, f"{snapshot}/{POINTER}")
    missing = {"scenario_id", "snapshot_id", "as_of_date", "sources"}.difference(manifest)
    if missing:
        raise SnapshotError(f"Manifesto sem campos obrigatórios: {', '.join(sorted(missing))}.")
    absent = [name for name in MANIFEST_NAMES.values() if name not in manifest["sources"]]
    if absent:
        raise SnapshotError(f"Manifesto sem a fonte obrigatória: {', '.join(absent)}.")
    return manifest


def open_snapshot(spark: SparkSession, snapshot: str, *, verify: bool = True) -> dict:
    """Manifest of a snapshot whose files are all present and unchanged."""
    if verify:
        problems = audit_snapshot(spark, snapshot).take(5)
        if problems:
            listed = "; ".join(f"{r['file']}: {r['problem']}" for r in problems)
            raise SnapshotError(f"Checksum divergente no snapshot: {listed}.")
    return load_manifest(spark, snapshot)
