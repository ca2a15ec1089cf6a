"""Snapshot to judged tables to SQL, on files."""

from datetime import date
from pathlib import Path

from pyspark.sql import functions as F
from pytest import raises
from test_staging import CONTRACT, PAYMENT, RISK, company

from ledgerspan.plans.quality import QualityGateError
from ledgerspan.plans.refresh import open_analytics, open_run, run_batch
from ledgerspan.sources.digests import file_digests
from ledgerspan.sources.raw import SOURCE_COLUMNS, SourceContractError, add_lineage, latest_batch, scan_csv
from ledgerspan.sources.snapshots import SnapshotError, audit_snapshot, byte_hashes, load_manifest, open_snapshot, source_paths, write_snapshot

AS_OF = date(2026, 7, 30)
HEAD, BRANCH = "11222333000199", "11222333000299"


def frame(spark, *rows):
    schema = ", ".join(f"`{c}` string" for c in rows[0])
    return spark.createDataFrame([tuple(r.values()) for r in rows], schema)


def sources(spark, **changes):
    extra = {"Atividade_Economica": "TI", "Ano_Fundacao": "2000", "Idade_Empresa": "26", "Estagio_Empresa": "Madura", "Cenario_Financeiro": "Estável"}
    figures = {"Faturamento": "1000.0", "Custo": "700.0", "Custo_Folha": "200.0", "Lucro_Bruto": "300.0", "Juros_Divida": "50.0", "Lucro_Liquido": "200.0"}
    yearly = {f"{m}_{y}": v for m, v in figures.items() for y in range(2022, 2027)}

    def firm(cnpj, kind):
        base = {k: v for k, v in company(cnpj, kind, HEAD).items() if not k[-4:].isdigit()}
        return {**base, **extra, **yearly}

    contract = {**CONTRACT, "CNPJ": HEAD}
    amendment = dict(zip(SOURCE_COLUMNS["amendments"], ("CS00000001", "Renovação", "2026-02-01", "2026-12-31", "200.00", "1")))
    payments = [{**PAYMENT, "CNPJ": HEAD, "Categoria": contract["Escopo"], "Cód_Pagamento": f"PAG0000000{i}"} for i in (1, 2)]
    risk = {**RISK, "CNPJ": HEAD, "Data_Avaliacao": "2022-01-01", "Data_Ultima_Homologacao": "2022-01-01"}
    frames = {
        "companies": frame(spark, firm(HEAD, "Matriz"), firm(BRANCH, "Filial")),
        "contracts": frame(spark, contract),
        "amendments": frame(spark, amendment),
        "payments": frame(spark, *payments),
        "risk": frame(spark, risk),
    }
    return {**frames, **changes}


def store(spark, folder, snapshot_id="20260730_120000", **changes):
    return write_snapshot(
        sources(spark, **changes), raw_dir=str(folder / "raw"), scenario_id="cenario", snapshot_id=snapshot_id, as_of_date=AS_OF
    )


def test_snapshot_to_kpis(spark, tmp_path, monkeypatch):
    from ledgerspan.plans import refresh

    snapshot = store(spark, tmp_path)

    def stop(*args, **kwargs):
        raise InterruptedError

    # a try that fails leaves nothing, and the next one is not disturbed
    for owner, name in ((refresh, "publish_stage"), (refresh.C, "build_categories")):
        with monkeypatch.context() as m:
            m.setattr(owner, name, stop)
            with raises(InterruptedError):
                run_batch(spark, snapshot, out_dir=str(tmp_path / "runs"), run_id="run1")
        assert not list((tmp_path / "runs/run1").glob("*"))
        with raises(FileNotFoundError):
            open_run(spark, str(tmp_path / "runs/run1"))
    manifest = run_batch(spark, snapshot, out_dir=str(tmp_path / "runs"), run_id="run1")
    assert manifest["staging"]["pagamentos"]["row_counts"] == {"source": 2, "valid": 2, "invalid": 0}
    assert manifest["curated"]["quality"] == {"quality_passed": True, "failed_entities": []}
    views = open_analytics(spark, str(tmp_path / "runs" / "run1"))
    assert len(views) == 9 and all(not spark.table(v).isEmpty() for v in views if v != "vw_quality_exceptions")
    row = spark.sql(
        "SELECT supplier_legal_name, sum(payment_value) AS v FROM vw_spending GROUP BY 1"
    ).first()
    assert (row.supplier_legal_name, str(row.v)) == ("Empresa", "900.00")
    with raises(Exception, match="(?i)exist"):
        run_batch(spark, snapshot, out_dir=str(tmp_path / "runs"), run_id="run1")


def test_failed_gate_raises_after_writing(spark, tmp_path):
    stranger = frame(spark, *[{**PAYMENT, "CNPJ": "99999999000199", "Cód_Pagamento": "PAG00000009"}])
    snapshot = store(spark, tmp_path, payments=stranger)
    with raises(QualityGateError, match="fact_spending"):
        run_batch(spark, snapshot, out_dir=str(tmp_path / "runs"), run_id="bad")
    run, manifest = open_run(spark, str(tmp_path / "runs/bad"))
    assert run.curated("reconciliation_report").count() == 9
    assert run.rejected("fact_spending").count() == 1 and run.curated("fact_spending").count() == 0
    assert manifest["curated"]["source_totals"]["fact_spending"] == [1, "450.00"]
    index = run.curated("exception_index")
    assert {r.business_key for r in index.where("entity = 'fact_spending'").collect()} == {"PAG00000009"}
    with raises(QualityGateError):
        open_analytics(spark, str(tmp_path / "runs/bad"))


def test_snapshots_are_immutable_and_audited(spark, tmp_path):
    snapshot = store(spark, tmp_path)
    assert open_snapshot(spark, snapshot)["sources"]["pagamentos"]["row_count"] == 2
    with raises(Exception, match="(?i)exist"):
        store(spark, tmp_path)
    folder = next(Path(snapshot).glob("attempt-*/spending_ficticio_*"))
    (folder / "part-99999.csv").write_text("extra\n")
    assert [r.problem for r in audit_snapshot(spark, snapshot).collect()] == ["undeclared"]
    with raises(SnapshotError, match="undeclared"):
        open_snapshot(spark, snapshot)
    (folder / "part-99999.csv").unlink()
    assert audit_snapshot(spark, snapshot).isEmpty()
    part = next(p for p in folder.glob("part-*.csv") if "PAG00000001" in p.read_text())
    part.write_text(part.read_text().replace("PAG00000001", "PAG00000003"))
    part.with_name(f".{part.name}.crc").unlink()
    assert [r.problem for r in audit_snapshot(spark, snapshot).collect()] == ["changed"]
    part.unlink()
    assert [r.problem for r in audit_snapshot(spark, snapshot).collect()] == ["missing"]


def tree(data):
    """The digest of a file by its definition."""
    import hashlib

    sha = lambda text: hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()
    lines = data.split(b"\n")
    hashes = [sha(x) for x in (lines[:-1] if lines[-1] == b"" else lines)]
    for fan in (1_000, 1_000):
        hashes = [sha("".join(hashes[i : i + fan])) for i in range(0, len(hashes), fan)]
    return sha(f"{sha(''.join(hashes)) if hashes else ''}:{len(data)}")


def test_digests_do_not_depend_on_blocks(spark, tmp_path):
    files = {"a.csv": b"id,x\n" + b"".join(b"%d,caf\xc3\xa9\n" % i for i in range(25_000)), "b.csv": b"id\n1\r\n2", "c.csv": b"", "d.csv": b"\n\n"}
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    for size in ("128m", "7000b"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            got = {r["path"].rsplit("/", 1)[-1]: (r["sha256"], r["bytes"]) for r in file_digests(spark, [str(tmp_path)]).collect()}
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert got == {n: (tree(d), len(d)) for n, d in files.items() if d}


def test_a_failed_write_leaves_no_snapshot(spark, tmp_path, monkeypatch):
    from pyspark.sql import DataFrameWriter

    from ledgerspan.sources import published, snapshots

    frames = sources(spark)

    class Stop(Exception):
        pass

    def failing(n, whole):
        calls = iter(range(100))

        def write(*args, **kwargs):
            if next(calls) == n:
                raise Stop
            return whole(*args, **kwargs)

        return write

    store_it = lambda: write_snapshot(frames, raw_dir=str(tmp_path), scenario_id="c", snapshot_id="s", as_of_date=AS_OF, check=False)
    steps = [(DataFrameWriter, "csv", n) for n in range(5)] + [(snapshots, "write_table", 0), (snapshots, "publish_json", 0)]
    for owner, name, n in steps:
        with monkeypatch.context() as m:
            m.setattr(owner, name, failing(n, getattr(owner, name)))
            with raises(Stop):
                store_it()
        assert not list((tmp_path / "c/s").glob("*"))
        with raises(SnapshotError, match="sem manifesto"):
            load_manifest(spark, str(tmp_path / "c/s"))
    assert not open_snapshot(spark, store_it()) is None
    with raises(published.AlreadyPublishedError):
        store_it()


def test_staged_rows_are_one_write_with_counts(spark, tmp_path, monkeypatch):
    from ledgerspan.operators.rules import rule_counts
    from ledgerspan.plans import staging as S
    from ledgerspan.sources import published

    rows = [{**PAYMENT, "Cód_Pagamento": f"PAG0000000{i % 7}", "Centro_Custo": ("x", PAYMENT["Centro_Custo"])[i % 2], "Fornecedor": ("", "A")[i % 3 > 0]} for i in range(9)]
    raw = add_columns(frame(spark, *rows))
    staged = S.stage_payments(raw, spark.createDataFrame([("CS00000001",)], "contract_id string"))
    writes, whole = [], published.write_table
    monkeypatch.setattr(published, "write_table", lambda *a, **k: writes.append(a[1]) or whole(*a, **k))
    path = str(tmp_path / "payments")
    result = published.publish_stage(staged, "stg_pagamentos", path, source_file="f", batch_id="b")
    assert writes == [path]
    assert result["validation_error_counts"] == {r["message"]: r["violations"] for r in rule_counts(staged).collect()}
    counts = published.stage_counts(staged).first().asDict()
    assert result["row_counts"] == counts and counts["invalid"] and counts["valid"]
    valid = published.read_split(spark, path, staged.schema, True)
    assert valid.count() == counts["valid"] and published.read_split(spark, path, staged.schema, False).count() == counts["invalid"]
    assert "PartitionFilters: [isnotnull(is_valid" in valid._jdf.queryExecution().toString()
    none = published.write_split(staged.limit(0), str(tmp_path / "none"), F.lit(True))
    assert none == {"valid": 0, "invalid": 0} and published.read_split(spark, str(tmp_path / "none"), staged.schema, True).count() == 0


def test_latest_batch_is_the_only_one_read(spark, tmp_path):
    from ledgerspan.sources import published

    path = str(tmp_path / "table")
    rows = [("a", "20260731_120000"), ("b", "20260801_000000"), ("c", "20260801_000000"), ("d", None), ("e", "0012")]
    published.write_batches(spark.createDataFrame(rows, "x string, batch_id string"), path)
    got = published.read_latest_batch(spark, path)
    assert {tuple(r) for r in got.collect()} == {("b", "20260801_000000"), ("c", "20260801_000000")}
    plan = got._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(batch_id" in plan and all("batch_id=20260801_000000" in f for f in got.inputFiles())
    published.write_batches(spark.createDataFrame([("f", "20260801_000001")], "x string, batch_id string"), path)
    assert [r.x for r in published.read_latest_batch(spark, path).collect()] == ["f"]


def add_columns(df):
    from raw_rows import LINEAGE

    values = dict(zip(("source_file", "source_row_number", "load_date", "batch_id"), LINEAGE))
    return df.withColumns({n: F.lit(v) for n, v in values.items()}).withColumn("source_row_number", F.monotonically_increasing_id())


def test_missing_source_is_refused(spark, tmp_path):
    with raises(SnapshotError, match="payments"):
        frames = {k: v for k, v in sources(spark).items() if k != "payments"}
        write_snapshot(frames, raw_dir=str(tmp_path), scenario_id="c", snapshot_id="s", as_of_date=AS_OF)


def test_row_numbers_across_blocks_and_files(spark, tmp_path):
    for batch, rows in (("20260730_120000", 5000), ("20260731_120000", 7)):
        lines = "\n".join(f"{i:06d},valor {i}" for i in range(rows))
        (tmp_path / f"contratos_{batch}.csv").write_text(f"﻿id,texto\n{lines}\n", encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        out = add_lineage(scan_csv(spark, str(tmp_path)), load_date=AS_OF)
        assert out.rdd.getNumPartitions() > 1
        wrong = out.where(F.col("source_row_number") != F.col("id").cast("int") + 2)
        assert (out.count(), wrong.count()) == (5007, 0)
        assert latest_batch(out).count() == 7
        assert out.where("batch_id = '20260730_120000'").agg(F.max("source_row_number")).first()[0] == 5001
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_file_without_batch_id_fails(spark, tmp_path):
    (tmp_path / "contratos.csv").write_text("id\n001\n")
    with raises(Exception, match="identificador de lote de contratos.csv"):
        add_lineage(scan_csv(spark, str(tmp_path)), load_date=AS_OF).collect()
    assert issubclass(SourceContractError, ValueError)


def test_single_file_snapshot_with_hashes_in_the_manifest(spark, tmp_path):
    import hashlib
    import json

    names = {"empresas": "empresas", "homologacoes_risco": "homologacoes_risco", "contratos": "contratos_ficticios", "aditamentos": "aditamentos", "pagamentos": "spending_ficticio"}
    folder = tmp_path / "c" / "20260730_120000"
    folder.mkdir(parents=True)
    entries = {}
    for key, stem in names.items():
        path = folder / f"{stem}_20260730_120000.csv"
        path.write_text("a,b\n1,2\n", encoding="utf-8")
        entries[key] = {"path": path.name, "row_count": 1, "sha256": hashlib.sha256(path.read_bytes()).hexdigest()}
    content = {"scenario_id": "c", "snapshot_id": "20260730_120000", "as_of_date": "2026-07-30", "sources": entries}
    (folder / "raw_manifest.json").write_text(json.dumps(content, indent=2), encoding="utf-8")
    assert open_snapshot(spark, str(folder))["scenario_id"] == "c"
    (folder / "aditamentos_20260730_120000.csv").write_text("a,b\n1,3\n")
    with raises(SnapshotError, match="aditamentos"):
        open_snapshot(spark, str(folder))
    with raises(SnapshotError, match="grande demais"):
        byte_hashes(spark, [str(folder)], str(folder), most_bytes=5)


def test_csv_dialect_is_that_of_the_csv_module(spark, tmp_path):
    import csv

    rows = [
        ["1", 'ACME ""X"" Ltda'.replace('""', '"'), "plain"],
        ["2", 'a, b "q", c', " blanks at both ends "],
        ["3", "two\nlines", "after"],
        ["4", "", 'ends with "'],
    ]
    path = tmp_path / "empresas_20260730_120000.csv"
    with path.open("w", newline="", encoding="utf-8") as out:
        csv.writer(out).writerows([["id", "name", "note"], *rows])
    got = [[v or "" for v in r] for r in scan_csv(spark, str(path), multi_line=True).collect()]
    assert got == rows
    numbered = add_lineage(scan_csv(spark, str(path), multi_line=True), load_date=AS_OF).collect()
    assert sorted((r["id"], r["source_row_number"]) for r in numbered) == [("1", 2), ("2", 3), ("3", 4), ("4", 5)]
    single = [r for r in rows if r[0] != "3"]
    with path.open("w", newline="", encoding="utf-8") as out:
        csv.writer(out).writerows([["id", "name", "note"], *single])
    assert [[v or "" for v in r] for r in scan_csv(spark, str(path)).collect()] == single


def test_snapshot_keeps_blanks(spark, tmp_path):
    changed = sources(spark)["companies"].withColumn("Razao_Social", F.lit('  "A", b  '))
    snapshot = store(spark, tmp_path, companies=changed)
    back = scan_csv(spark, source_paths(snapshot, load_manifest(spark, snapshot))["companies"])
    assert {r["Razao_Social"] for r in back.collect()} == {'  "A", b  '}


def test_snapshot_without_integrity_is_refused(spark, tmp_path):
    orphan = sources(spark)["payments"].withColumn("Cód_Contrato", F.lit("CS00000009"))
    with raises(SnapshotError, match="pagamentos sem contrato: 2"):
        store(spark, tmp_path, payments=orphan)
    assert not (tmp_path / "raw").exists()


def test_a_lost_row_stops_the_publication(spark, tmp_path, monkeypatch):
    from ledgerspan.plans import refresh

    snapshot = store(spark, tmp_path)
    whole = refresh.C.resolve_spending
    monkeypatch.setattr(refresh.C, "resolve_spending", lambda *a: whole(*a).limit(1))
    with raises(QualityGateError, match="Publicação recusada"):
        run_batch(spark, snapshot, out_dir=str(tmp_path / "runs"), run_id="lost")
    assert not list((tmp_path / "runs/lost").glob("*"))
    monkeypatch.setattr(refresh.C, "resolve_spending", whole)
    other = refresh.C.resolve_renewals
    monkeypatch.setattr(refresh.C, "resolve_renewals", lambda *a: other(*a).limit(0))
    with raises(QualityGateError, match="fact_renewal"):
        run_batch(spark, snapshot, out_dir=str(tmp_path / "runs"), run_id="lost2")
