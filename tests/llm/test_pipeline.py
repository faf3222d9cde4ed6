"""The pipeline's stages, each against its own input."""

import re
import shutil

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from spendloom.llm import fmindex, jaccard, packing, sanitise
from spendloom.llm.common import table, written


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of each stage; a few odd rows go in with the documents."""
    sf_dir = "/root/testdata/sf0.001"
    docs = table(spark, sf_dir, "documents")
    odd = [(-1, None), (-2, ""), (-3, "12 34 !!"), (-4, "Nobody told them anything"), (-4, "Nobody told them anything"), (None, "Ein Wort")]
    more = spark.createDataFrame([(k, t, None, "odd", None) for k, t in odd], docs.schema)
    docs, out = docs.unionByName(more), {}
    for name, stage in pipeline.STAGES:
        result = written(stage(spark, docs, sf_dir), "stage")
        out[name] = (docs, result)
        docs = result
    return out


def test_names_and_columns(stages):
    assert [n for n, _ in pipeline.STAGES] == list(stages)
    for before, after in list(stages.values())[:-1]:
        assert after.dtypes == before.dtypes


def test_language_rejects_texts_without_letters(stages):
    before, after = stages["language"]
    letters = [r.text for r in before.collect() if r.text and re.search(r"[^\W\d_]", r.text)]
    assert sorted(r.text for r in after.collect()) == sorted(letters)


def test_one_document_of_each_group_stays(stages):
    before, after = stages["jaccard"]
    groups = jaccard.groups(before)
    some = groups.where("n_shingles > 0")
    # The null id is a group of its own here.
    assert after.count() == some.select("component_id").distinct().count()
    assert {r.doc_id for r in after.collect()} == {r.component_id for r in some.collect()}
    assert jaccard.groups(after).where("component_id != doc_id").count() == 0


def test_no_benchmark_passage_is_left(spark, stages):
    before, after = stages["decontamination"]
    items = table(spark, "/root/testdata/sf0.001", "benchmark")
    assert fmindex.leaks(before, items).where("n_hit > 0").count() > 0
    assert fmindex.leaks(after, items).where("n_hit > 0").count() == 0
    hit = {r.doc_id for r in fmindex.leaks(before, items).where("n_hit > 0").collect()}
    texts = {r.doc_id: r.text for r in before.collect()}
    assert all(r.text == texts[r.doc_id] for r in after.collect() if r.doc_id not in hit)


def test_no_personal_data_is_left(stages):
    before, after = stages["personal data"]
    spans = F.size(sanitise.base_spans(F.col("text")))
    assert before.where(spans > 0).count() > 0 and after.where(spans > 0).count() == 0
    assert before.count() == after.count()
    assert all(r.n_chars == len(r.text) for r in after.where("n_chars IS NOT NULL").collect())


def test_everything_left_is_packed(stages):
    before, after = stages["packing"]
    assert {r.doc_id for r in before.collect()} == {r.doc_id for r in after.collect()}
    full = after.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert full.where(f"n != end OR n > {packing.SEQUENCE}").count() == 0


def test_run_is_registered(spark):
    assert entry.queries()["pipeline"] is pipeline.run and "pipeline" not in entry.oracle_sql()
    assert {f"op{n}" for n in range(1, 11)} <= {q.split("_")[0] for q in entry.queries()}


def test_the_rest_stands_alone(tmp_path):
    """Without the two folders and the pipeline the entry point gives the other queries."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.abspath(entry.__file__))
    copy = tmp_path / "repo"
    shutil.copytree(root, copy, ignore=shutil.ignore_patterns("llm", ".git", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; assert len(e.queries()) > 100 and not any(q.startswith('op1') for q in e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, env=os.environ | {"PYTHONPATH": str(copy)})
