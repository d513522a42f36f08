"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from landfall.llm import bpe
from landfall.llm.decontaminate import drop_contaminated, find_passages
from landfall.llm.html_extract import html_extract
from landfall.llm.language_id import language_id
from landfall.llm.near_dedup import keep_one, near_dedup
from landfall.llm.quality_classifier import quality_classifier
from landfall.llm.quality_rules import fit_quality, keep_good, quality_rules
from landfall.llm.suffix_dedup import remove_repeats, suffix_dedup
from landfall.llm.toxicity import toxicity
from landfall.llm.url_filter import url_filter

PATH = public_tokenizers.path("word_bpe_49k.json")

PER_ROW = {
    "language": lambda df, labels: language_id(df, F.crc32(F.col("doc_id").cast("string")) % 4 == 2),
    "suffix": lambda df, labels: suffix_dedup(df),
    "rules": lambda df, labels: quality_rules(df, fit_quality(df, labels)),
    "rules without labels": lambda df, labels: quality_rules(df, fit_quality(df, labels.limit(0))),
    "bpe": lambda df, labels: bpe.encode(df, PATH, with_ids=True),
    "classifier": lambda df, labels: quality_classifier(df, labels),
    "classifier without labels": lambda df, labels: quality_classifier(df, labels.limit(0)),
    "toxicity": lambda df, labels: toxicity(df, labels),
    "near": lambda df, labels: near_dedup(df),
    "urls": lambda df, labels: url_filter(df, "doc_id", "text"),
    "pages": lambda df, labels: html_extract(df, "doc_id", "source", "text"),
}


def plain(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("name", PER_ROW)
def test_one_row_per_row_and_no_clash(odd, crowded, none, labels, name):
    apply = PER_ROW[name]
    got = plain(apply(odd, labels))
    assert len(got) == odd.count()
    assert plain(apply(crowded, labels)) == got
    empty = apply(none, labels)
    assert empty.count() == 0 and empty.columns == apply(odd, labels).columns


@pytest.fixture(scope="module")
def benchmark(spark, odd_rows):
    return spark.createDataFrame(
        [(1, odd_rows[0][1][:200]), (2, None), (3, ""), (4, "1234"), (5, "1234"), (None, odd_rows[6][1] or "")],
        "item_id long, text string")


def test_passages_of_odd_rows(odd, crowded, none, benchmark):
    got = plain(find_passages(odd, benchmark))
    assert plain(find_passages(crowded, benchmark)) == got
    found = {(r.doc_id, r.item_id) for r in find_passages(odd, benchmark).collect()}
    assert {(1, 1), (None, 1), (7, 4), (7, 5)} <= found
    assert not {i for i, _ in found} & {2, 3, 4, 5, 8}
    assert find_passages(none, benchmark).count() == find_passages(odd, benchmark.limit(0)).count() == 0


@pytest.mark.parametrize("stage", ["good", "one", "cut", "clean"])
def test_stages_keep_the_columns(odd, crowded, none, labels, benchmark, stage):
    apply = {
        "good": lambda df: keep_good(df, fit_quality(df, labels)), "one": keep_one,
        "cut": remove_repeats, "clean": lambda df: drop_contaminated(df, benchmark),
    }[stage]
    for table in (odd, crowded, none):
        out = apply(table)
        assert [f.simpleString() for f in out.schema] == [f.simpleString() for f in table.schema]
        assert out.count() <= table.count()
    assert apply(crowded).select(odd.columns).exceptAll(apply(odd)).count() == 0


def test_defined_results(odd, labels):
    near = {(r.doc_id, r.n_shingles): r for r in near_dedup(odd).collect()}
    assert near[2, 0].component_id == 2 and near[2, 0].kept
    assert near[3, 0].component_id == 3 and near[4, 0].component_id == 4
    assert near[None, 77].component_id == 1 and not near[None, 77].kept
    assert near[5, 1].kept
    languages = {r.doc_id: r for r in language_id(odd, F.lit(False)).collect() if r.doc_id}
    assert all(languages[i].lang_pred == "und" and languages[i].score == 0 for i in (2, 3, 4, 7))
    rules = {r.doc_id: r for r in quality_rules(odd, None).collect() if r.doc_id}
    assert rules[2].base_failed and rules[3].n_words == 0 and not rules[5].kept and rules[8].kept
    cut = {(r.doc_id, r.n_bytes): r for r in suffix_dedup(odd).collect()}
    assert cut[2, 0].n_spans == 0
    whole = [r for r in suffix_dedup(odd).collect() if r.doc_id == 1]
    assert all(r.n_removed == r.n_bytes and r.n_spans == 1 for r in whole)
