from __future__ import annotations

import ast
from pathlib import Path

import frames
import pytest
from test_jaccard import shingles

import __spark_entry__ as contract
import corpus_pipeline
from salesloom.plans.session import work_dir

ROOT = Path(__file__).resolve().parents[2]


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """The documents before the first stage and after each."""
    folder = work_dir(spark, "pipeline-test")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = f"{folder}/{name.replace(' ', '-')}"
        stage(spark, out[-1], sf_dir).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_stages_return_the_columns_of_documents(stages):
    assert len(corpus_pipeline.STAGES) == 5
    assert all(stage.columns == stages[0].columns for stage in stages[:-1])


def test_low_quality_goes_and_the_rest_stays(spark, sf_dir, stages):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    kept = {r["doc_id"] for r in stages[1].select("doc_id").collect()}
    rows = labels.collect()
    bad = [r["doc_id"] for r in rows if r["quality"] == 0]
    good = [r["doc_id"] for r in rows if r["quality"] == 1]
    assert sum(i in kept for i in bad) <= 0.05 * len(bad) and sum(i in kept for i in good) >= 0.97 * len(good)


def test_one_document_of_each_group_stays(stages):
    before = {r["doc_id"]: shingles(r["text"]) for r in stages[1].collect()}
    after = {r["doc_id"] for r in stages[2].collect()}
    alike = lambda a, b: a and b and 100 * len(a & b) >= 80 * len(a | b)
    ids = sorted(after)
    assert not [(i, j) for n, i in enumerate(ids) for j in ids[:n] if alike(before[i], before[j])]
    for gone in before.keys() - after:
        assert any(alike(before[gone], before[i]) for i in before if i != gone)


def test_no_passage_repeats_that_did(stages):
    texts = [(r["text"] or "").split() for r in stages[2].collect()]
    seen: dict[tuple, int] = {}
    for w in texts:
        for k in range(len(w) - 34):
            seen[tuple(w[k : k + 35])] = seen.get(tuple(w[k : k + 35]), 0) + 1
    after = {r["doc_id"]: r for r in stages[3].collect()}
    for row in stages[2].collect():
        w, gone = (row["text"] or "").split(), set()
        for k in range(len(w) - 34):
            if seen[tuple(w[k : k + 35])] > 1:
                gone.update(range(k, k + 35))
        assert after[row["doc_id"]]["text"].split() == [x for k, x in enumerate(w) if k not in gone]


def test_no_benchmark_item_is_left(spark, sf_dir, stages):
    flat = lambda t: " ".join((t or "").split())
    items = [flat(r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    before = {r["doc_id"]: flat(r["text"]) for r in stages[3].collect()}
    after = {r["doc_id"] for r in stages[4].collect()}
    assert before.keys() - after == {i for i, t in before.items() if any(x in t for x in items)}


def test_all_that_is_left_is_packed(stages):
    packed = stages[5].groupBy("doc_id").sum("length").count()
    assert packed == stages[4].count()


def test_run_gives_the_last_stage(spark, sf_dir, stages):
    assert corpus_pipeline.run(spark, sf_dir).count() == stages[5].count()
    assert contract.queries()["pipeline"] is corpus_pipeline.run and "pipeline" not in contract.oracle_sql()


def test_stages_take_empty_tables(shipped, sf_dir):
    docs = frames.none(shipped)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(shipped, docs, sf_dir).count() == 0, name


def test_nothing_else_imports_the_folder():
    for path in [*(ROOT / "salesloom").rglob("*.py"), ROOT / "bench.py"]:
        if "llm" in path.parts:
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            names = [node.module or ""] if isinstance(node, ast.ImportFrom) else [a.name for a in getattr(node, "names", [])]
            assert not any("llm" in name.split(".") for name in names if isinstance(node, ast.Import | ast.ImportFrom)), path


def test_the_packed_stage_returns_its_ids(shipped, sf_dir):
    rows = corpus_pipeline.packed(shipped, frames.documents(shipped), sf_dir).collect()
    assert rows and all(len(r["ids"]) == r["length"] for r in rows)
