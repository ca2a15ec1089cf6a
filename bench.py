"""Headline queries at BENCH_SF_DIR on local[BENCH_CPUS]; prints one JSON line.

`value` is the whole run: making the tables that queries read (`setup`) and the queries themselves.
`batch` is a snapshot taken from RAW files to judged tables, end to end, and not part of `value`.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from datetime import date

from pyspark.sql import SparkSession

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = (
    "t02_stg_contracts",
    "t04_stg_payments",
    "t03_stg_amendments",
    "t11_fact_spending",
    "q01_direct_controls",
    "vw8_supplier_financials",
    "k01_consumption",
    "k02_contract_expiry",
    "k03_spend_concentration",
    "k04_latest_risk",
    "k05_financial_dependency",
    "k06_data_quality",
    "d03_contract_table",
    "d08_supplier_profile",
    "r07_risk_at_contract_start",
    "r10_allocation",
    "v22_top_up_in_renewal",
    "w01_repeated_keys",
    "w04_dense_rank",
)


def batch(spark: SparkSession) -> float:
    """Seconds from a written snapshot to judged tables; the gate's verdict doesn't matter here."""
    from ledgerspan.catalog import adapters as A
    from ledgerspan.operators.storage import shared_folder
    from ledgerspan.plans.quality import QualityGateError
    from ledgerspan.plans.refresh import run_batch
    from ledgerspan.sources.snapshots import write_snapshot

    base = f"{shared_folder(spark)}/bench-{uuid.uuid4().hex}"
    sources = {s: A.raw(spark, SF_DIR, s).select(*A.RAW[s]["columns"]) for s in A.RAW}
    snapshot = write_snapshot(
        sources, raw_dir=base, scenario_id="bench", snapshot_id=A.BATCH_ID, as_of_date=date.fromisoformat(A.LOAD_DATE), check=False
    )
    start = time.perf_counter()
    try:
        run_batch(spark, snapshot, out_dir=f"{base}/runs", run_id="bench")
    except QualityGateError as error:  # raised last, when all is written: the adapters' defects are meant to fail it
        if "reprovado" not in str(error):
            raise
    return time.perf_counter() - start


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("ledgerspan-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        # small tables, but as many files as there are cores
        .config("spark.sql.files.maxRecordsPerFile", "25000")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from ledgerspan.catalog.adapters import RAW, raw
    from ledgerspan.catalog.all import QUERIES
    from ledgerspan.catalog.batch import Batch

    start = time.perf_counter()
    for source in RAW:
        raw(spark, SF_DIR, source)
    setup = {"raw_files": round(time.perf_counter() - start, 3)}
    start = time.perf_counter()
    Batch(spark, SF_DIR).resolved()
    setup["staging_and_curated_tables"] = round(time.perf_counter() - start, 3)
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    try:
        whole = round(batch(spark), 3)
    except Exception as error:  # the queries' times stand without it
        whole = f"failed: {type(error).__name__}: {str(error)[:200]}"
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_with_setup",
                "value": round(sum(seconds.values()) + sum(setup.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "setup": setup,
                "batch": whole,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
