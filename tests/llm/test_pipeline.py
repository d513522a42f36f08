"""The pipeline's stages, each on its own input, and its run."""

import pytest
from compare import difference
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import corpus_pipeline
from landfall.llm.common import table, written

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = table(spark, SF_DIR, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, written(stage(spark, docs, SF_DIR), name)
        out.append((name, before, docs))
    return {name: (before, after) for name, before, after in out}


def test_all_but_the_last_keep_the_columns(steps):
    for name, (before, after) in steps.items():
        if name != "encoding":
            assert after.columns == before.columns
            assert [f.dataType for f in after.schema] == [f.dataType for f in before.schema]


def test_decisions_take_effect(spark, steps):
    queries = entry_points.queries()
    before, after = steps["quality"]
    kept = queries["op4_quality_rules"](spark, SF_DIR).where("kept").select("doc_id")
    assert after.select("doc_id").exceptAll(kept).count() == kept.exceptAll(after.select("doc_id")).count() == 0
    assert after.exceptAll(before).count() == 0
    before, after = steps["repeats"]
    assert before.count() == after.count()
    assert after.where(F.length("text") != F.col("n_chars")).count() == 0
    before, after = steps["near_duplicates"]
    assert after.select("text").distinct().count() == after.count() < before.count()


def test_run_is_the_stages(spark, steps):
    got = corpus_pipeline.run(spark, SF_DIR)
    assert got.exceptAll(steps["encoding"][1]).count() == 0
    assert got.count() == steps["decontamination"][1].count()


@pytest.mark.parametrize("name", ["op3_suffix_dedup", "op10_near_dedup", "op12_centroid_clusters", "op13_collocations"])
def test_query_matches_sql(spark, name):
    assert difference(spark, SF_DIR, entry_points.queries()[name], entry_points.oracle_sql()[name]) is None


def test_every_operator_is_registered():
    names = [n for n in entry_points.queries() if n.startswith("op") or n == "pipeline"]
    assert {n.split("_")[0] for n in names} == {f"op{k}" for k in range(1, 14)} | {"pipeline"}
