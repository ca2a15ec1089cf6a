"""CSV records with line breaks against Python's csv module, over many blocks."""

import csv
import io
import random
from datetime import date

from pytest import fixture, mark, raises
from test_batch import PAYMENT, frame, store

from ledgerspan.plans.refresh import Run, stage_all
from ledgerspan.sources.raw import latest_batch
from ledgerspan.sources.records import _lines, read_source, scan_records
from ledgerspan.sources.snapshots import load_manifest

VALUES = ["plain", "two\nlines", "a, b", 'say "hi"', "", " blanks ", '"q"\n\n"r",\n', "x\r\ny", "é中\n", "\n" * 40, '""', "5,\n5"]


@fixture
def small_blocks(spark):
    names = {"spark.sql.files.maxPartitionBytes": "400b", "spark.sql.files.openCostInBytes": "1b"}
    before = {n: spark.conf.get(n) for n in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def write(folder, name, rng, rows, values, end="\n"):
    """A file with blank lines and literal quotes among its records, and what the csv module reads from it."""
    out = io.StringIO(newline="")
    writer = csv.writer(out, lineterminator=end)
    writer.writerow(["id", "na\nme", "note"])
    for i in range(rows):
        writer.writerow([str(i), rng.choice(values), rng.choice(values)])
        if rng.random() < 0.1:
            out.write(rng.choice([end, f'{i},5" disk,x "y" z{end}', f'{i},"a"b"c,"d\n"{end}', f"   {end}"]))
    (folder / name).write_text(out.getvalue(), newline="", encoding="utf-8")
    read = [r for r in csv.reader(io.StringIO(out.getvalue(), newline="")) if len(r) > 1]
    return [(*[v or None for v in r], name, i) for i, r in enumerate(read[1:], 2)]


@mark.parametrize("seed, values, end", [(1, VALUES, "\n"), (2, VALUES, "\r\n"), (3, ["v", 'w "x"', "y, z"], "\n"), (4, ["\n\n\n", 'a"\n"b'], "\n")])
def test_rows_and_numbers_are_those_of_the_csv_module(spark, tmp_path, small_blocks, seed, values, end):
    rng = random.Random(seed)
    expected = [r for f, n in (("a", 250), ("b", 0), ("c", 9)) for r in write(tmp_path, f"empresas_2026073{f}.csv", rng, n, values, end)]
    assert _lines(spark, str(tmp_path)).rdd.getNumPartitions() > 5
    got = scan_records(spark, str(tmp_path))
    assert got.columns == ["id", "na\nme", "note", "source_file", "source_row_number"]
    broken = {'a"b"c'}  # after a closing quote readers differ on the rest of the value, not on where it ends
    plain = lambda rows: sorted([tuple("?" if c == 1 and v and (v in broken or 'b"c' in v or v == "ab\"c\"") else v for c, v in enumerate(r)) for r in rows], key=str)
    assert plain(got.collect()) == plain(expected)


def test_lineage_of_records(spark, tmp_path, small_blocks):
    rng = random.Random(5)
    for name, rows in (("contratos_20260730_120000.csv", 60), ("contratos_20260731_120000.csv", 5)):
        write(tmp_path, name, rng, rows, ["v", "w\nx"])
    out = read_source(spark, str(tmp_path), load_date=date(2026, 7, 30))
    assert out.columns == ["id", "na\nme", "note", "source_file", "source_row_number", "load_date", "batch_id"]
    assert {r["source_file"] for r in latest_batch(out).collect()} == {"contratos_20260731_120000.csv"}
    (tmp_path / "contratos.csv").write_text("id,name,note\n1,2,3\n")
    with raises(Exception, match="identificador de lote de contratos.csv"):
        read_source(spark, str(tmp_path)).collect()


def test_unclosed_quote_is_refused(spark, tmp_path, small_blocks):
    (tmp_path / "a.csv").write_text("id,name\n1,x\n2,\"open\n" + "3,y\n" * 300)
    with raises(ValueError, match="sem fechamento em .*a.csv"):
        scan_records(spark, str(tmp_path))


def test_empty_file_and_header_alone(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,source_file\n")
    got = scan_records(spark, str(tmp_path / "a.csv"))
    assert got.columns == ["id", "source_file", "source_row_number"] and got.count() == 0


def test_batch_reads_line_breaks(spark, tmp_path):
    names = ["Empresa\nfilial 2", 'Em"presa,\r\n\n']
    payments = frame(spark, *[{**PAYMENT, "CNPJ": "11222333000199", "Fornecedor": n, "Cód_Pagamento": f"PAG0000000{i}"} for i, n in enumerate(names)])
    snapshot = store(spark, tmp_path, payments=payments)
    run = Run(spark, str(tmp_path / "runs" / "try"), "run")
    counts = stage_all(run, snapshot, load_manifest(spark, snapshot))["pagamentos"]["row_counts"]
    assert counts == {"source": 2, "valid": 2, "invalid": 0}
    assert {r["supplier_name"] for r in run.staged("payments").collect()} == {n.strip() for n in names}


def test_blocks_have_bounded_lines_and_lines_without_breaks_are_not_shuffled(spark, tmp_path, monkeypatch):
    from ledgerspan.sources import records

    monkeypatch.setattr(records, "LINE_BITS", 4)
    rng = random.Random(6)
    expected = write(tmp_path, "empresas_20260730.csv", rng, 300, ["v", "two\nlines", "\n" * 40, 'say "hi"'], "\n")
    lines = _lines(spark, str(tmp_path))
    assert lines.groupBy("path", "block", "chunk").count().agg({"count": "max"}).first()[0] == 16
    assert records.block_table(lines).count() > lines.rdd.getNumPartitions()
    read = {tuple(r)[3:] for r in scan_records(spark, str(tmp_path)).collect()}
    assert read == {r[3:] for r in expected}
    plain = tmp_path / "plain.csv"
    plain.write_text("id,name\n" + "1,x\n" * 100)
    rows = scan_records(spark, str(plain))
    assert rows.count() == 100
    assert "hashpartitioning" not in rows._jdf.queryExecution().executedPlan().toString()


def test_digests_shuffle_lines_once_and_are_hash_trees(spark, tmp_path, monkeypatch):
    import hashlib

    from ledgerspan.sources import digests

    monkeypatch.setattr(digests, "ROWS", 7)
    lines = [f"row {i}" for i in range(40)]
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n")
    rows = digests.row_digests(spark, [str(tmp_path)])
    # the small table of blocks goes to the lines at any size
    assert "strategy=broadcast" in rows._jdf.queryExecution().optimizedPlan().toString()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    expected = {n: (sha("".join(sha(x) for x in lines[7 * n : 7 * n + 7])), len(lines[7 * n : 7 * n + 7])) for n in range(6)}
    assert {r["number"]: (r["digest"], r["lines"]) for r in digests.block_digests(rows).collect()} == expected
