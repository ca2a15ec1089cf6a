"""Nulls, empty and very long texts, repeats, empty tables and clashing columns, for every operator and stage."""

import importlib.util
from collections import Counter
from pathlib import Path

import pytest

from llm_frames import EDGES, clashing, frame
from ledgerspan.llm import contamination, hmm, mixing, paragraphs, periods, quality_model, rules, secrets, sharding, simhash, tokens


def items(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "item_id long, text string")


def labels(spark, *rows):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


REPORTS = {
    "op1": lambda s, d: mixing.mixture(d),
    "op2": lambda s, d: quality_model.report(d, labels(s, (1, 1, 0), (2, 0, 0), (None, 1, 0), (3, None, 0))),
    "op4": lambda s, d: contamination.report(d, items(s, "quick brown fox", None, "")),
    "op6": lambda s, d: tokens.token_counts(d),
    "op7": lambda s, d: simhash.groups(d),
    "op8": lambda s, d: rules.report(d),
    "op9": lambda s, d: sharding.report(d, 1_000),
    "op10": lambda s, d: hmm.report(d, states=2, rounds=1),
    "op12": lambda s, d: periods.report(d),
}
FINDINGS = {"op3": lambda s, d: paragraphs.repeats(d), "op5": lambda s, d: secrets.scan(d)}
KEEPING = {
    "quality": rules.keep,
    "near duplicates": simhash.keep_one,
    "decontamination": lambda d: contamination.drop_contaminated(d, items(d.sparkSession, "quick brown fox")),
    "mixing": mixing.emit,
    "substring dedup": paragraphs.without_repeats,
    "masking": secrets.masked,
}


@pytest.mark.parametrize("name", REPORTS)
def test_a_row_for_every_row(spark, edges, name):
    got = REPORTS[name](spark, edges).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in EDGES)
    assert len({tuple(str(v) for v in r) for r in got if r["doc_id"] == 6}) <= (3 if name in ("op9",) else 2)


@pytest.mark.parametrize("name", [*REPORTS, *FINDINGS])
def test_empty_table(spark, nothing, name):
    assert (REPORTS | FINDINGS)[name](spark, nothing).count() == 0


@pytest.mark.parametrize("name", [*REPORTS, *FINDINGS])
def test_table_without_words(spark, name):
    got = (REPORTS | FINDINGS)[name](spark, frame(spark, [(1, None), (2, ""), (3, " \n "), (4, "", "de", "src1")])).collect()
    assert [r["doc_id"] for r in sorted(got, key=lambda r: r["doc_id"])] == ([1, 2, 3, 4] if name in REPORTS else [])


def test_nothing_to_mix(spark):
    assert mixing.emit(frame(spark, [(1, None), (2, ""), (3, " ", "en", None)])).count() == 0


HARD = {
    "marks": "password=" + ")" * 1_000_000 + "x", "names": "key" * 400_000 + " = Zq81kLm0", "ampersands": "token=" + "&" * 1_000_000, "quotes": "secret='" * 120_000,
    "one word": "é" * 300_000, "other letters": "中文\u2019 \u0416 \U0001f600 " * 30_000,
}


@pytest.mark.parametrize("name", [*REPORTS, *FINDINGS])
def test_hard_texts(spark, name):
    rows = list(enumerate(HARD.values()))
    got = (REPORTS | FINDINGS)[name](spark, frame(spark, rows)).collect()
    if name in REPORTS:
        assert sorted(r["doc_id"] for r in got) == list(range(len(HARD)))


@pytest.mark.parametrize("name", FINDINGS)
def test_findings_survive_edges(spark, edges, name):
    FINDINGS[name](spark, edges).collect()


@pytest.mark.parametrize("name", KEEPING)
def test_columns_stay(spark, edges, nothing, name):
    docs = clashing(edges)
    got = KEEPING[name](docs)
    assert got.columns == docs.columns
    rows = got.collect()
    assert all(r["row"] == "own row" and r["class"] == "own class" for r in rows)
    assert KEEPING[name](nothing).count() == 0


def test_shards_replace_clashing_columns(spark, edges):
    got = sharding.assign(clashing(edges), 1_000)
    assert got.count() == len(EDGES)
    assert got.where("shard like 'own%'").count() == 0 and got.columns.count("shard") == 1


def test_pipeline_of_edges(spark, edges, tmp_path):
    path = Path(__file__).resolve().parents[2] / "corpus_pipeline.py"
    spec = importlib.util.spec_from_file_location("corpus_pipeline", path)
    pipeline = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(pipeline)
    edges.write.parquet(f"{tmp_path}/documents.parquet")
    items(spark, "quick brown fox").write.parquet(f"{tmp_path}/benchmark.parquet")
    # the long text alone has enough words
    assert {r["doc_id"] for r in pipeline.run(spark, str(tmp_path)).collect()} <= {5}
    frame(spark, EDGES[:1]).limit(0).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0
