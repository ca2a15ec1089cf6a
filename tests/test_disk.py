"""What the batch leaves on disk: shuffle files of one step at a time, and only rows that somebody reads."""

import os
import shutil

from ledgerspan.catalog import adapters as A
from ledgerspan.catalog.all import QUERIES
from ledgerspan.catalog.batch import REFERENCE, Batch
from ledgerspan.catalog.store import base_path, is_stored
from ledgerspan.operators.rules import accepted
from ledgerspan.operators.storage import FREED, keep
from ledgerspan.plans import staging as S

SF = "/root/testdata/sf0.001"


def fresh(tmp_path):
    """A copy of the tables, which no other test has staged."""
    return shutil.copytree(SF, tmp_path / "tables").as_posix()


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_a_kept_step_leaves_no_shuffle_files(spark):
    before, setting = shuffle_files(spark), spark.conf.get(FREED)
    kept = keep(A.table(spark, SF, "lineitem").groupBy("l_orderkey").count(), "counts")
    assert kept.count() > 0
    spark.sparkContext._jvm.java.lang.Thread.sleep(500)
    left = {n for n in shuffle_files(spark) - before if os.path.basename(n).endswith(".data")}
    # the count above is the only shuffle since then
    assert len({n.split("_")[1] for n in left}) <= 1
    assert spark.conf.get(FREED) == setting


def test_valid_rows_are_those_that_staging_accepts(spark, tmp_path):
    sf = fresh(tmp_path)
    contracts = accepted(S.stage_contracts(A.raw(spark, sf, "contracts"))).localCheckpoint()
    pairs = {
        "contracts": (S.stage_contracts, S.valid_contracts, ()),
        "amendments": (S.stage_amendments, S.valid_amendments, (contracts,)),
        "payments": (S.stage_payments, S.valid_payments, (contracts,)),
        "risk": (S.stage_risk, S.valid_risk, (REFERENCE,)),
    }
    for source, (stage, valid, more) in pairs.items():
        raw = A.raw(spark, sf, source)
        old, new = accepted(stage(raw, *more)), valid(raw, *more)
        assert new.columns == old.columns
        assert new.count() > 0 and new.exceptAll(old).isEmpty() and old.exceptAll(new).isEmpty()


def test_the_calendar_stores_no_rows_that_only_it_reads(spark, tmp_path):
    sf = fresh(tmp_path)
    whole = Batch(spark, SF)
    for query, kept in (("t14_fact_supplier_financial", ()), ("t08_dim_calendar", ()), ("v27_risk_resolution", ("risk",)), ("t13_fact_renewal", ("risk", "amendments"))):
        QUERIES[query](spark, sf).collect()
        assert not is_stored(spark, sf, "stg_payments")
        for source in ("amendments", "risk"):
            assert is_stored(spark, sf, f"stg_{source}") == (source in kept)
    seen = Batch(spark, sf, ()).dim_calendar()
    assert sorted(seen.collect()) == sorted(whole.dim_calendar().collect())
    # two rows a category, whatever the number of payments
    assert Batch(spark, sf, ()).seen("payments").count() <= 2 * len(A.CATEGORIES)
    assert os.path.isdir(f"{base_path(spark, sf)}/seen_payments".removeprefix("file:"))


def test_the_split_stages_payments_once_and_narrow(spark, tmp_path):
    sf = fresh(tmp_path)
    rows = QUERIES["s04_valid_invalid_split"](spark, sf)
    assert {f.rsplit("/", 2)[1] for f in rows.inputFiles()} == {"val_payment_ids"}
    assert not is_stored(spark, sf, "stg_payments")


def test_filters_are_not_worked_out_below_the_columns_they_read(spark):
    raw = A.raw(spark, SF, "amendments")
    plan = accepted(S.stage_amendments(raw, spark.range(1).selectExpr("cast(id AS string) contract_id")))._jdf.queryExecution().optimizedPlan()
    filters = [line for line in plan.toString().split("\n") if "Filter" in line and "l_shipdate" in line]
    assert not filters


def test_files_of_a_snapshot_are_hashed_one_source_at_a_time_and_once(spark, tmp_path, monkeypatch):
    from ledgerspan.sources import snapshots as N

    sf, hashed, plain = fresh(tmp_path), [], N.file_hashes
    monkeypatch.setattr(N, "file_hashes", lambda spark, paths, base: hashed.append(paths) or plain(spark, paths, base))
    rows = QUERIES["s09_snapshot_audit"](spark, sf).collect()
    assert len(rows) >= 5 and not any(r["problem"] for r in rows)
    # when written and when audited
    assert [len(paths) for paths in hashed] == [1] * 10 and hashed[0] != hashed[1]
